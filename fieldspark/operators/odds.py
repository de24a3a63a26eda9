"""Odds: name keys, crosswalks by mode, consensus over books, de-vigging, spread backfill."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldspark.functions.exprs import american_prob, clip_null
from fieldspark.operators.summaries import exact_percentiles

# The default line that marks a game without a real one, and the widest spread taken as real.
DEFAULT_SPREAD, DEFAULT_TOTAL = 2.5, 55.5
MAX_SPREAD = 60.0


def name_key(c: Column, aliases: dict[str, str] | None = None) -> Column:
    """Team-name key: '&' spelled out, dots out, ' st ' and a final ' st' spelled out, then other punctuation, then aliases."""
    s = F.regexp_replace(F.replace(F.lower(F.trim(c)), F.lit("&"), F.lit(" and ")), r"\.", "")
    s = F.regexp_replace(F.replace(s, F.lit(" st "), F.lit(" state ")), r" st$", " state")
    s = F.trim(F.regexp_replace(F.regexp_replace(s, r"[^a-z0-9 ]+", " "), r"\s+", " "))
    if not aliases:
        return s
    table = F.create_map(*[F.lit(x) for kv in sorted(aliases.items()) for x in kv])
    return F.coalesce(F.try_element_at(table, s), s)


def modal(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Most frequent value per key; ties go to the smaller value."""
    n = rows.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(*keys).orderBy(F.desc("n"), F.asc(value))
    return n.withColumn("r", F.row_number().over(w)).where("r = 1").select(*keys, value, "n")


def consensus(lines: DataFrame, keys: list[str], line: str, low: float | None = None, high: float | None = None) -> DataFrame:
    """Exact median over the books, clipped."""
    return lines.groupBy(*keys).agg(F.median(line).alias("__m"), F.count(line).alias("books")).select(*keys, clip_null("__m", low, high).alias(line), "books")


def missing_spread(spread: Column, total: Column, available: Column) -> Column:
    """No real line: NULL, marked unavailable, or the default pair without a mark that it is available.

    NULL parts never make the test NULL.
    """
    marked = F.coalesce(~available, F.lit(False))
    default = F.coalesce((spread == DEFAULT_SPREAD) & (total == DEFAULT_TOTAL), F.lit(False)) & ~F.coalesce(available, F.lit(False))
    return spread.isNull() | marked | default


def spread_time(spread: Column, is_home: Column, elapsed_share: Column, decay: float = -4.0) -> Column:
    """Possession team's spread, fading with the share of the game played."""
    return F.when(is_home, spread).otherwise(-spread) * F.exp(F.lit(decay) * elapsed_share)


def team_total(home_spread: Column, total: Column, is_home: Column) -> Column:
    """Points expected of the team with the ball; a side that is not known to be at home counts as away."""
    return (total + F.when(F.coalesce(is_home, F.lit(False)), home_spread).otherwise(-home_spread)) / 2.0


def backfill(games: DataFrame, lines: DataFrame, key: str) -> DataFrame:
    """Fill spreads that are no real line from the consensus; a filled game says so."""
    gap = missing_spread(F.col("spread"), F.col("total"), F.col("available"))
    got = lines.select(key, F.col("spread").alias("__s"), F.col("total").alias("__t"))
    out = games.withColumn("__gap", gap).join(got, key, "left")
    use = F.col("__gap") & F.col("__s").isNotNull()
    return out.withColumns({"spread": F.when(use, F.col("__s")).otherwise(F.col("spread")), "total": F.when(use, F.coalesce("__t", F.lit(DEFAULT_TOTAL))).otherwise(F.col("total")), "filled": use}).drop("__gap", "__s", "__t")


def devig(quotes: DataFrame, key: str, side: str, odds: str, sides: tuple[str, str] = ("home", "away")) -> DataFrame:
    """Median implied probability per side, scaled so both sum to 1."""
    a, b = sides
    mid = exact_percentiles(quotes.where(F.col(side).isin(a, b) & F.col(key).isNotNull()).select(key, side, american_prob(odds).alias("__p")), [key, side], "__p", [0.5])
    med = lambda s: F.max(F.when(F.col(side) == s, F.col("q")))
    m = mid.groupBy(key).agg(med(a).alias("a"), med(b).alias("b"))
    return m.select(key, F.try_divide(F.col("a"), F.col("a") + F.col("b")).alias(f"{a}_prob"), F.try_divide(F.col("b"), F.col("a") + F.col("b")).alias(f"{b}_prob"))


def override(cons: DataFrame) -> DataFrame:
    """Consensus as an absolute spread, a sign flag and a total with its default."""
    return cons.select("game_id", F.abs("spread").alias("game_spread"), (F.col("spread") > 0).alias("home_favorite"), F.coalesce("total", F.lit(DEFAULT_TOTAL)).alias("over_under"))


def archive_report(archive: DataFrame, season: str = "season") -> DataFrame:
    """Null counts of all columns and rows per season in one pass."""
    return archive.groupBy(season).agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"null_{c}") for c in archive.columns if c != season])

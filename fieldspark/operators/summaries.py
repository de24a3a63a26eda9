"""Season summaries: two-sided, phase-split aggregates with ranks, margins and percentiles.

Both sides of a play (offense, defense) and all phases (all, pass, rush) come from one scan: each
play is expanded to its sides and aggregated with filters per phase, which is one shuffle where
separate passes would be six.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldspark.functions.exprs import avg_rank, n_unique_null, safe_div, sum0
from fieldspark.operators.prefix import running
from fieldspark.session import broadcast_if_small, cut

PHASES = {"all": F.lit, "pass": None, "rush": None}
# Measures whose low values are good for the offense, and those ranked high-to-low for both sides.
LOW_IS_GOOD = ["play_stuffed", "third_down_distance", "start_position", "havoc"]
ALWAYS_DESC = ["passrate", "rushrate"]
MARGINS = ["tepa", "epa_play", "epa_drive", "epa_game", "success", "yards_play"]


def _measures(on: Column) -> list[Column]:
    v = lambda c: F.when(on, F.col(c).cast("double"))
    return [
        F.count_if(on).alias("plays"),
        F.count_distinct(F.when(on, F.col("game_id"))).alias("n_games"),
        (F.count_distinct(F.when(on, F.col("drive_id"))) + F.max(F.when(on & F.col("drive_id").isNull(), 1).otherwise(0))).alias("drives"),
        F.avg(v("pass")).alias("passrate"), F.avg(v("rush")).alias("rushrate"), F.avg(v("havoc")).alias("havoc"), F.avg(v("explosive")).alias("explosive"),
        sum0(v("epa")).alias("tepa"), F.avg(v("epa")).alias("epa_play"), sum0(v("stat_yardage")).alias("yards"), F.avg(v("stat_yardage")).alias("yards_play"),
        F.avg(v("play_stuffed")).alias("play_stuffed"), F.avg(v("epa_success")).alias("success"), F.avg(v("red_zone_success")).alias("red_zone_success"),
        F.avg(v("third_down_success")).alias("third_down_success"), F.avg(v("third_down_distance")).alias("third_down_distance"), F.avg(v("late_down_success")).alias("late_down_success"),
        F.avg(v("early_down_epa")).alias("early_down_epa"), F.avg(v("non_explosive_epa")).alias("non_explosive_epa"), F.avg(v("line_yards")).alias("line_yards"), F.avg(v("opportunity_run")).alias("opportunity_rate"),
    ]


def side_summaries(plays: DataFrame, keys: tuple[str, ...] = ("season",)) -> DataFrame:
    """keys..., side, team_id, phase and measures: one shuffle for all sides and phases.

    Phases are expanded next to the sides, so that one group-by serves them all.
    """
    sides = F.array(F.struct(F.lit("off").alias("side"), F.col("pos_team_id").alias("team_id")), F.struct(F.lit("def").alias("side"), F.col("def_pos_team_id").alias("team_id")))
    phases = F.array(F.lit("all"), F.when(F.col("pass"), F.lit("pass")), F.when(F.col("rush"), F.lit("rush")))
    long = plays.withColumn("s", F.explode(sides)).withColumn("phase", F.explode(F.filter(phases, lambda p: p.isNotNull()))).where("s.team_id is not null")
    g = long.groupBy(*keys, F.col("s.side").alias("side"), F.col("s.team_id").alias("team_id"), "phase").agg(*_measures(F.lit(True)))
    per = {"plays_game": ("plays", "n_games"), "epa_drive": ("tepa", "drives"), "epa_game": ("tepa", "n_games"), "yards_game": ("yards", "n_games"), "drives_game": ("drives", "n_games"), "yards_drive": ("yards", "drives"), "plays_drive": ("plays", "drives")}
    return g.withColumns({k: safe_div(a, b) for k, (a, b) in per.items()})


def with_ranks(summary: DataFrame, measures: list[str], partition: list[str]) -> DataFrame:
    """Average-tie ranks with NULL last; the good direction depends on the measure and the side."""
    out = {}
    for m in measures:
        down = avg_rank(m, [], ["team_id"], ascending=False, partition=partition)
        up = avg_rank(m, [], ["team_id"], ascending=True, partition=partition)
        if m in ALWAYS_DESC:
            out[f"{m}_rank"] = down
        else:
            good_high = F.col("side") == ("def" if m in LOW_IS_GOOD else "off")
            out[f"{m}_rank"] = F.when(good_high, down).otherwise(up)
    return summary.withColumns(out)


def two_sided(summary: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """One row per team: ``<measure>_off`` and ``<measure>_def``; teams without offense are left out."""
    pick = lambda m, s: F.max(F.when(F.col("side") == s, F.col(m))).alias(f"{m}_{s}")
    wide = summary.groupBy(*keys, "team_id").agg(F.max((F.col("side") == "off").cast("int")).alias("__off"), *[pick(m, s) for m in measures for s in ("off", "def")])
    return wide.where("__off = 1").drop("__off")


def with_margins(wide: DataFrame, partition: list[str], bases: list[str] = MARGINS) -> DataFrame:
    """Offense minus defense, ranked high to low."""
    m = wide.withColumns({f"{b}_margin": F.col(f"{b}_off") - F.col(f"{b}_def") for b in bases})
    return m.withColumns({f"{b}_margin_rank": avg_rank(f"{b}_margin", [], ["team_id"], ascending=False, partition=partition) for b in bases})


def drive_yards(plays: DataFrame, side: str, keys: tuple[str, ...] = ("season",)) -> DataFrame:
    """Available and gained yards per drive (first and last play by number), summed per team."""
    d = plays.where(F.col("drive_id").isNotNull() & F.col(side).isNotNull())
    per = d.groupBy(*keys, F.col(side).alias("team_id"), "drive_id").agg(
        F.min_by("yards_to_goal", F.when(F.col("yards_to_goal").isNotNull(), F.struct(F.coalesce("game_play_number", F.lit(-1)), "play_id"))).alias("available"), F.sum(F.coalesce("stat_yardage", F.lit(0))).alias("gained")
    )
    t = per.groupBy(*keys, "team_id").agg(sum0("available").alias("available_yards"), sum0("gained").alias("gained_yards"))
    return t.withColumn("available_yards_pct", safe_div("gained_yards", "available_yards"))


def exact_percentiles(rows: DataFrame, keys: list[str], value: str, fractions: list[float]) -> DataFrame:
    """keys..., i, q: exact linear percentiles (the i-th of ``fractions``) of a DOUBLE column per key (at least one); NULL and NaN are left out.

    Values are counted first; running totals over ranges of values (never one task for a key) tell which value stands at
    which place.
    """
    x = F.col(value).cast("double")
    counts = rows.where(x.isNotNull() & ~F.isnan(x)).groupBy(*keys, x.alias("__x")).agg(F.count(F.lit(1)).alias("__n"))
    counts = cut(counts)
    upto = running(counts, keys, ["__x"], sums={"__upto": "__n"})
    total = broadcast_if_small(counts.groupBy(*keys).agg(F.sum("__n").alias("__all")))
    wanted = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(f)).alias("f")) for i, f in enumerate(fractions)])
    placed = upto.join(total, keys).withColumn("__from", F.col("__upto") - F.col("__n"))
    place = lambda w: w["f"] * (F.col("__all") - 1)
    here = lambda p: (p >= F.col("__from")) & (p < F.col("__upto"))
    hits = F.filter(F.transform(wanted, lambda w: F.struct(w["i"].alias("i"), place(w).alias("p"))), lambda w: here(F.floor(w["p"])) | here(F.ceil(w["p"])))
    each = placed.where(F.size(hits) > 0).select(*keys, "__x", "__from", "__upto", F.inline(hits))
    low, high = here(F.floor("p")), here(F.ceil("p"))
    found = each.groupBy(*keys, "i", "p").agg(F.max(F.when(low, F.col("__x"))).alias("a"), F.max(F.when(high, F.col("__x"))).alias("b"))
    return found.select(*keys, "i", (F.col("a") + (F.col("b") - F.col("a")) * (F.col("p") - F.floor("p"))).alias("q"))


def percentile_table(rows: DataFrame, measures: list[str], partition: list[str] | None = None) -> DataFrame:
    """Exact linear percentiles 1..99 of each measure; NaN and NULL are left out."""
    part = partition or []
    long = rows.select(*part, F.inline(F.array(*[F.struct(F.lit(m).alias("__m"), F.col(m).cast("double").alias("__v")) for m in measures])))
    q = exact_percentiles(long, [*part, "__m"], "__v", [i / 100 for i in range(1, 100)])
    return q.groupBy(*part, (F.col("i") + 1).alias("pctile")).agg(*[F.max(F.when(F.col("__m") == m, F.col("q"))).alias(m) for m in measures])


def game_excitement(plays: DataFrame, norm: float) -> DataFrame:
    """Sum of absolute win-probability moves per game, scaled by the number of plays."""
    w = Window.partitionBy("game_id").orderBy("game_play_number", "play_id")
    moved = plays.withColumn("wpa", F.col("wp_before") - F.lag("wp_before").over(w))
    return moved.groupBy("game_id").agg((sum0(F.abs("wpa")) * norm / F.count(F.lit(1))).alias("gei"), F.count(F.lit(1)).alias("plays"))


def implausible_games(plays: DataFrame, limit: float = 0.5) -> DataFrame:
    """Games whose mean EPA is too far from 0."""
    return plays.groupBy("game_id").agg(F.avg("epa").alias("mean_epa"), F.count(F.lit(1)).alias("plays")).where(F.abs("mean_epa") > limit)


def latest_per_key(rows: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The last row of every key by a total order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


def distinct_over(rows: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    """Distinct count of ``value`` over each key on every row (pre-aggregated, then joined back)."""
    n = rows.groupBy(*keys).agg(n_unique_null(value).alias(out))
    return rows.join(n, keys, "left")

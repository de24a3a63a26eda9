"""Game logs, season resumes, player seasons and snapshot flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldspark.functions.exprs import clip_null, logistic, safe_div

# Floor of a rush's EPA in player seasons; logistic scale of a margin's residual.
EPA_FLOOR = -4.5
LOGISTIC_SHARE = 0.5513


def game_log(games: DataFrame) -> DataFrame:
    """Two rows per game with the opponent, points, margin and result (a tie is neither won nor lost)."""
    each = F.array(
        F.struct(F.col("home_id").alias("team_id"), F.col("away_id").alias("opponent_id"), F.lit(True).alias("is_home"), F.col("home_score").alias("points_for"), F.col("away_score").alias("points_against")),
        F.struct(F.col("away_id").alias("team_id"), F.col("home_id").alias("opponent_id"), F.lit(False).alias("is_home"), F.col("away_score").alias("points_for"), F.col("home_score").alias("points_against")),
    )
    log = games.select("game_id", "season", "week", "kickoff", "neutral_site", F.inline(each)).where("team_id is not null")
    m = F.col("points_for") - F.col("points_against")
    return log.withColumn("margin", m).withColumn("win", F.when(m > 0, True).when(m < 0, False))


def week_cutoffs(games: DataFrame) -> DataFrame:
    """Last kickoff of every regular-season week."""
    return games.where("season_type = 2 and week is not null and kickoff is not null").groupBy("season", "week").agg(F.max("kickoff").cast("date").alias("cutoff"))


def season_resume(log: DataFrame, strength: DataFrame, resid_sd: float, home_edge: float) -> DataFrame:
    """Record, expected wins, luck, strength of schedule and of record per team and season.

    strength: season, team_id, strength (points). The schedule is measured by the opponents' own
    strength, never by the team's expected margin.
    """
    s = strength.select("season", F.col("team_id").alias("opponent_id"), F.col("strength").alias("theirs"))
    own = strength.select("season", "team_id", F.col("strength").alias("ours"))
    j = log.where("margin is not null").join(own, ["season", "team_id"], "left").join(s, ["season", "opponent_id"], "left")
    edge = F.when(F.coalesce("neutral_site", F.lit(False)), 0.0).when(F.col("is_home"), home_edge).otherwise(-home_edge)
    scale = resid_sd * LOGISTIC_SHARE
    j = j.withColumn("expected", F.coalesce("ours", F.lit(0.0)) - F.coalesce("theirs", F.lit(0.0)) + edge)
    j = j.withColumn("exp_win", logistic(F.col("expected") / scale)).withColumn("won", (F.col("margin") > 0).cast("double"))
    g = j.groupBy("season", "team_id").agg(F.count(F.lit(1)).alias("games"), F.sum("won").alias("wins"), F.sum("exp_win").alias("exp_wins"), F.avg("margin").alias("margin_pg"), F.avg("theirs").alias("sos_points"))
    rate = clip_null(safe_div("wins", "games"), 0.01, 0.99)
    return g.withColumns({"luck_wins": F.col("wins") - F.col("exp_wins"), "win_pct": safe_div("wins", "games"), "sor_points": (F.ln(rate) - F.ln(1 - rate)) * scale + F.col("sos_points")})


def rusher_seasons(rushes: DataFrame, player: str, least: int = 100) -> DataFrame:
    """Seasons of players with more than ``least`` rushes: clamped and plain EPA, success, highlight yards per opportunity."""
    g = rushes.where(F.col(player).isNotNull()).groupBy(player, "season").agg(
        F.count(F.lit(1)).alias("n_plays"), F.count_if("opportunity_run").alias("n_opps"), F.sum("epa").alias("e"), F.sum(F.greatest("epa", F.lit(EPA_FLOOR))).alias("c"),
        F.avg("success").alias("success"), F.sum("highlight_yards").alias("h"),
    ).where(F.col("n_plays") > least)
    return g.select(player, "season", "n_plays", "n_opps", safe_div("e", "n_plays").alias("unadjusted_epa"), safe_div("c", "n_plays").alias("epa"), "success", F.coalesce(safe_div("h", "n_opps"), F.lit(0.0)).alias("highlight_yards"))


def with_season_lag(seasons: DataFrame, player: str, columns: list[str]) -> DataFrame:
    """The player's adjacent earlier season, and a weight from both seasons' plays."""
    w = Window.partitionBy(player).orderBy("season")
    out = seasons.withColumns({f"l_{c}": F.lag(c).over(w) for c in columns})
    n = F.col("n_plays").cast("double")
    return out.withColumn("weight", F.sqrt(n * n + F.col("l_n_plays") * F.col("l_n_plays"))) if "n_plays" in columns else out


def carry_prior(weekly: DataFrame, columns: list[str]) -> DataFrame:
    """Each team's last snapshot of the season before, as ``prior_<column>``."""
    last = weekly.groupBy("team_id", "season").agg(F.max_by(F.struct(*columns), "through_week").alias("p"))
    prior = last.select("team_id", (F.col("season") + 1).alias("season"), *[F.col(f"p.{c}").alias(f"prior_{c}") for c in columns])
    return weekly.join(prior, ["team_id", "season"], "left")


def blend(now: Column, prior: Column, n: Column, k: float, compat: bool = False) -> Column:
    """Shrink this season's value towards the last one's by n / (n + k).

    A missing current value leaves the prior; with ``compat`` it counts as 0, as in the published tables.
    """
    w = n.cast("double") / (n.cast("double") + F.lit(k))
    if compat:
        return w * F.coalesce(now, F.lit(0.0)) + (1 - w) * F.coalesce(prior, now, F.lit(0.0))
    return F.coalesce(w * now + (1 - w) * prior, now, prior)


def snapshot_flags(snaps: DataFrame, keys: list[str], order: list[str], stamp: str, season: str) -> DataFrame:
    """A snapshot computed after one of a later week is out of sequence; one computed outside August to
    February of its season is no contemporary of it."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(1, Window.unboundedFollowing)
    y, m = F.year(stamp), F.month(stamp)
    inside = ((y == F.col(season)) & (m >= 8)) | ((y == F.col(season) + 1) & (m <= 2))
    return snaps.withColumn("out_of_sequence", F.coalesce(F.col(stamp) > F.min(stamp).over(w), F.lit(False))).withColumn("contemporaneous", F.coalesce(inside, F.lit(False)))


def returning_production(rows: DataFrame, team: str, value: str, weight: str) -> DataFrame:
    """Weighted mean per team; NULL where the weights sum to 0."""
    return rows.groupBy(team).agg(safe_div(F.sum(F.col(value) * F.col(weight)), F.sum(weight)).alias("returning_production"))

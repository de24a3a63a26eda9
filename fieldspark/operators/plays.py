"""Plays: conforming the delivered rows and deriving the per-play measures.

All derivations are expressions on one row, so a whole season is one projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Thresholds of the play measures.
EXPLOSIVE_PASS_EPA = 2.4
EXPLOSIVE_RUSH_EPA = 1.8
RUSH_CAP = 10
OPPORTUNITY_YARDS = 4
SUCCESS_SHARE = {1: 0.5, 2: 0.7, 3: 1.0, 4: 1.0}
GEI_NORM = 179.01777401608126
KNEEL = r"(?i)kneel|takes a knee"
TEAM_RUN = r"(?i)^team run for a loss of (?:1 yard|2 yards)"


def latest_delivery(plays: DataFrame, key: str = "play_id", version: str = "load_no") -> DataFrame:
    """One row per play: the delivery with the highest version, then the later load time; what still ties goes by content."""
    content = [F.asc_nulls_last(c) for c in ("game_play_number", "stat_yardage", "down", "distance", "play_text", "epa")]
    w = Window.partitionBy(key).orderBy(F.desc_nulls_last(version), F.desc_nulls_last("loaded_at"), *content)
    return plays.where(F.col(key).isNotNull()).withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


def rule_success(down: Column, distance: Column, gain: Column) -> Column:
    """A play succeeds if it gains its down's share of the distance; other downs never do."""
    out = F.lit(False)
    for d, share in SUCCESS_SHARE.items():
        out = F.when(down == d, F.coalesce(gain >= F.lit(share) * distance, F.lit(False))).otherwise(out)
    return out


def is_kneel(text: Column, seconds_left_in_half: Column | None = None) -> Column:
    """Kneel-downs by text, and near a half's end also losses charged to the team; NULL text is none."""
    knee = F.coalesce(text.rlike(KNEEL), F.lit(False))
    if seconds_left_in_half is None:
        return knee
    return knee | F.coalesce(seconds_left_in_half.between(0, 60) & text.rlike(TEAM_RUN), F.lit(False))


def scrimmage(plays: DataFrame) -> DataFrame:
    """Passes and rushes with a known result; kneel-downs that are no passes left out."""
    p = plays.where((F.col("pass") | F.col("rush")) & F.col("epa").isNotNull() & F.col("pos_team_id").isNotNull())
    return p.where(F.coalesce("pass", F.lit(False)) | ~is_kneel(F.col("play_text")))


def with_measures(plays: DataFrame) -> DataFrame:
    """Adds the measures of a play: success, explosiveness, havoc, line and highlight yards, splits by down."""
    gain, rush = F.col("stat_yardage"), F.coalesce("rush", F.lit(False))
    down, dist = F.col("start_down"), F.col("start_distance")
    capped = F.when(rush, F.least(gain, F.lit(RUSH_CAP)).cast("double"))
    p = plays.withColumns(
        {
            "success": rule_success(down, dist, gain).cast("double"),
            "epa_success": (F.col("epa") > 0).cast("double"),
            "explosive": F.when(F.col("pass"), F.col("epa") >= EXPLOSIVE_PASS_EPA).when(rush, F.col("epa") >= EXPLOSIVE_RUSH_EPA).otherwise(F.lit(False)),
            "play_stuffed": gain <= 0,
            "red_zone": F.col("yards_to_goal") <= 20,
            "havoc": F.coalesce(F.lower("play_type").rlike("sack|interception|fumble"), F.lit(False)) | F.coalesce(gain < 0, F.lit(False)),
            "opportunity_run": rush & (gain >= OPPORTUNITY_YARDS),
            "adj_rush_yardage": F.when(gain.isNotNull(), capped),
        }
    )
    adj = F.col("adj_rush_yardage")
    line = F.when(gain < 0, 1.2 * adj).when(gain <= 4, adj).when(gain <= RUSH_CAP, 0.5 * adj).otherwise(F.lit(0.0))
    known_rush = rush & gain.isNotNull()
    p = p.withColumns(
        {
            "line_yards": F.when(known_rush, line),
            "second_level_yards": F.when(known_rush, F.when(gain >= 5, 0.5 * (adj - 5)).otherwise(F.lit(0.0))),
            "open_field_yards": F.when(known_rush, F.when(gain > RUSH_CAP, gain - adj).otherwise(F.lit(0.0))),
            "red_zone_success": F.when(F.col("red_zone"), F.col("epa_success")),
            "third_down_success": F.when(down == 3, F.col("epa_success")),
            "third_down_distance": F.when(down == 3, dist),
            "late_down_success": F.when(down >= 3, F.col("epa_success")),
            "early_down_epa": F.when(down <= 2, F.col("epa")),
            "early_down_success": F.when(down <= 2, F.col("epa_success")),
            "non_explosive_epa": F.when(~F.col("explosive"), F.col("epa")),
        }
    )
    highlight = F.col("second_level_yards") + F.col("open_field_yards")
    return p.withColumn("highlight_yards", highlight).withColumn("opp_highlight_yards", F.when(rush, F.when(F.col("opportunity_run"), highlight).otherwise(F.lit(0.0))))


def model_rows(plays: DataFrame, deny: list[str], required: list[str]) -> DataFrame:
    """Plays a model is fitted on: downs 1 to 4, a known type that is not on the deny list, the required columns known."""
    return plays.where(F.col("start_down").between(1, 4) & ~F.col("play_type").isin(deny)).dropna(subset=required)


def competitive(plays: DataFrame, low: float = 0.1, high: float = 0.9, wp: str = "wp_before") -> DataFrame:
    """Plays of undecided games: win probability within the range; NULL is not."""
    return plays.where(F.col(wp).between(low, high))


def passes(plays: DataFrame, allow: list[str]) -> DataFrame:
    """Passes of the allowed types only."""
    return plays.where(F.coalesce("pass", F.lit(False)) & F.col("play_type").isin(allow))


def drives(plays: DataFrame) -> DataFrame:
    """One row per game and drive: plays, team, periods, start, yards and how it ended (in the order of the play numbers)."""
    turn = F.struct(F.coalesce("game_play_number", F.lit(-1)), "play_id")
    known = lambda c: F.when(F.col(c).isNotNull(), turn)
    return plays.where("game_id is not null and drive_id is not null").groupBy("game_id", "drive_id").agg(
        F.count(F.lit(1)).alias("n_plays"), F.min_by("pos_team_id", known("pos_team_id")).alias("team_id"), F.min("period").alias("first_period"), F.max("period").alias("last_period"),
        F.min_by("yards_to_goal", known("yards_to_goal")).alias("start_yards_to_goal"), F.coalesce(F.sum("stat_yardage"), F.lit(0)).alias("yards"), F.max_by("play_type", known("play_type")).alias("result"),
    )


def seeded_share(rows: DataFrame, key: str, share: float, seed: int = 42) -> DataFrame:
    """The same rows for the same seed, whatever the partitioning: those whose hash falls into the share."""
    u = F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return rows.where(u < F.lit(share))


def whole_group_filter(rows: DataFrame, key: str, bad: Column, keep: bool = False) -> DataFrame:
    """Rows of the groups in which no row is ``bad`` (or, with ``keep``, some row is)."""
    marked = rows.where(bad).select(key).distinct()
    return rows.join(marked, key, "left_semi" if keep else "left_anti")


def zscore_filter(rows: DataFrame, column: str, limit: float) -> DataFrame:
    """Rows within ``limit`` population standard deviations of the mean; no spread keeps all values, NULL none."""
    s = rows.agg(F.avg(column).alias("m"), F.stddev_pop(column).alias("s")).first()
    if s["s"] is None:
        return rows.limit(0)
    return rows.where(F.abs(F.col(column) - F.lit(s["m"])) < F.lit(limit * s["s"])) if s["s"] > 0 else rows.where(F.col(column).isNotNull())

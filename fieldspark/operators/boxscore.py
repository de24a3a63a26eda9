"""Game box scores of both teams, and the composite rating built on their differences.

Every play counts for its offense; one aggregate per (game, team) serves all games at once, and the
opponent's figures come from a window over the game's two rows instead of a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldspark.functions.exprs import lookup, safe_div, translate

# Weights and ranges of the five factors, thresholds of the box score.
WEIGHTS = {"efficiency": 0.35, "explosiveness": 0.30, "finishing": 0.15, "field_position": 0.10, "turnovers": 0.10}
FIELD_WEIGHTS = {"success": 0.37, "turnovers": 0.21, "kicks": 0.22, "punts": 0.20}
RANGES = {
    "success": (-1.0, 1.0, 0.0, 10.0), "eq_ppp": (-2.0, 2.0, 0.0, 10.0),
    "points_per_drive": (-7.0, 7.0, 0.0, 3.5), "chance_rate": (-1.0, 1.0, 0.0, 4.0), "chance_success": (-1.0, 1.0, 0.0, 2.5),
    "field_position": (-10.0, 10.0, 0.0, 10.0), "luck": (-5.0, 5.0, 0.0, 3.0), "sacks": (-1.0, 1.0, 0.0, 3.0), "havoc": (-1.0, 1.0, 0.0, 4.0),
}
EXPLOSIVE_YARDS = 15
CHANCE_YARD_LINE = 60
EXPECTED_INT, EXPECTED_FUMBLE = 0.22, 0.49
EARLY_SUCCESS = {1: 0.5, 2: 0.7}
TOUCHDOWN, FIELD_GOAL = 7, 3


def play_success(down: Column, distance: Column, gain: Column, third_down: bool = False) -> Column:
    """Box-score success: half of the distance on first down, 70 % on second, all of it on fourth.

    Third downs never count unless ``third_down`` is set (the published boxes leave them out).
    """
    need = F.when(down == 1, EARLY_SUCCESS[1]).when(down == 2, EARLY_SUCCESS[2]).when(down >= (3 if third_down else 4), 1.0)
    return F.coalesce(gain >= need * distance, F.lit(False))


def drive_boxes(plays: DataFrame) -> DataFrame:
    """game_id, team_id and what the team made of its drives; a chance is a drive that gets to CHANCE_YARD_LINE (start plus gained yards)."""
    t = F.lower("play_type")
    scrim = F.coalesce(F.col("pass"), F.lit(False)) | F.coalesce(F.col("rush"), F.lit(False))
    points = F.when(t.contains("touchdown"), TOUCHDOWN).when(t.contains("field goal good"), FIELD_GOAL).otherwise(0)
    start = 100 - F.col("yards_to_goal")
    turn = F.when(start.isNotNull(), F.struct(F.coalesce("game_play_number", F.lit(-1)), "play_id"))
    d = plays.where("game_id is not null and pos_team_id is not null and drive_id is not null")
    per = d.groupBy("game_id", F.col("pos_team_id").alias("team_id"), "drive_id").agg(F.min_by(start, turn).alias("start"), F.sum(F.when(scrim, F.col("stat_yardage"))).alias("gained"), F.max(points).alias("points"))
    chance = F.coalesce(F.col("start") + F.coalesce("gained", F.lit(0)) >= CHANCE_YARD_LINE, F.lit(False))
    return per.groupBy("game_id", "team_id").agg(
        F.count(F.lit(1)).alias("drives"), F.count_if(chance).alias("chances"), F.coalesce(F.avg(F.when(chance, F.col("points"))), F.lit(0.0)).alias("points_per_chance"), F.count_if(chance & (F.col("points") > 0)).alias("scored")
    )


def game_boxes(plays: DataFrame, ep: list[float]) -> DataFrame:
    """game_id, team_id and the play, drive, kicking and turnover figures of each offense.

    ep: expected points by yard line (0 to 100). Points per play are differences on that curve. Kick and punt yards are
    read from the text (none: 0); return yards are not in it, so a return counts as one of 0 yards.
    """
    t, gain = F.lower("play_type"), F.col("stat_yardage")
    scrim = F.coalesce(F.col("pass"), F.lit(False)) | F.coalesce(F.col("rush"), F.lit(False))
    picked, fumbled, sacked = F.coalesce(t.rlike("interception"), F.lit(False)), F.coalesce(t.rlike(r"fumble recovery \(opponent\)"), F.lit(False)), F.coalesce(t.rlike("sack"), F.lit(False))
    broken = F.coalesce(t.rlike("incompletion") & F.col("play_text").rlike("(?i)broken up"), F.lit(False))
    rate = lambda c: F.avg(F.when(scrim, c.cast("double")))
    line = 100 - F.col("yards_to_goal")
    kicked = F.coalesce(F.regexp_extract("play_text", r"(?i) (?:kickoff|punt) for (\d+) y", 1).try_cast("int"), F.lit(0))
    kick, punt = F.coalesce(t == "kickoff", F.lit(False)), F.coalesce(t == "punt", F.lit(False))
    success = play_success(F.col("start_down"), F.col("start_distance"), gain)
    eq = lookup(ep, line + gain) - lookup(ep, line)
    flight = lookup(ep, line + kicked) - lookup(ep, line)
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    rows = plays.where("game_id is not null and pos_team_id is not null")
    box = rows.groupBy("game_id", F.col("pos_team_id").alias("team_id")).agg(
        F.count_if(scrim).alias("plays"), rate(success).alias("success_rate"), rate(F.coalesce(gain >= EXPLOSIVE_YARDS, F.lit(False))).alias("explosive_rate"), F.avg(F.when(scrim, F.col("epa"))).alias("epa_play"),
        F.avg(F.when(scrim, eq)).alias("eq_ppp"), zero(F.avg(F.when(scrim & success, eq))).alias("iso_ppp"),
        zero(F.avg(F.when(kick, flight))).alias("kick_ppp"), F.when(F.count_if(kick) > 0, F.lit(float(ep[0]))).otherwise(F.lit(0.0)).alias("kick_return_ppp"), zero(F.avg(F.when(punt, flight))).alias("punt_ppp"), F.count_if(punt).alias("punts"),
        F.count_if(picked).alias("picks"), F.count_if(fumbled).alias("fumbles"), F.count_if(sacked).alias("sacks"), F.count_if(broken).alias("broken_up"), F.count(F.lit(1)).alias("rows"),
    )
    box = box.join(drive_boxes(plays), ["game_id", "team_id"], "left").fillna(0, ["drives", "chances", "points_per_chance", "scored"])
    return box.withColumns(
        {
            "expected_turnovers": EXPECTED_INT * (F.col("broken_up") + F.col("picks")) + EXPECTED_FUMBLE * F.col("fumbles"),
            "turnovers": F.col("picks") + F.col("fumbles"),
            "havoc_rate": safe_div(F.col("picks") + F.col("fumbles") + F.col("sacks"), "rows"),
            "sack_rate": safe_div("sacks", "rows"),
            "chance_rate": zero(safe_div("chances", "drives")),
            "chance_success": zero(safe_div("scored", "drives")),
        }
    )


def against_opponent(box: DataFrame, measures: list[str]) -> DataFrame:
    """``<measure>_diff``: own minus opponent's value; NULL unless the game has exactly two teams."""
    w = Window.partitionBy("game_id")
    two = F.count(F.lit(1)).over(w) == 2
    return box.withColumns({f"{m}_diff": F.when(two, F.col(m) * 2 - F.sum(m).over(w)) for m in measures})


def five_factors(box: DataFrame) -> DataFrame:
    """The composite rating of each team in each game, with its factors.

    As published, the punt term sets a team's own punting against itself and so is always 0.
    """
    d = against_opponent(box, ["success_rate", "eq_ppp", "points_per_chance", "chance_rate", "chance_success", "sack_rate", "havoc_rate", "turnovers"])
    index = lambda c, name: translate(c, *RANGES[name])
    w = FIELD_WEIGHTS
    kicks, punts = F.col("kick_ppp") - F.col("kick_return_ppp"), F.col("punt_ppp") - F.col("punt_ppp")
    field = w["success"] * F.col("success_rate_diff") - w["turnovers"] * F.col("turnovers_diff") / F.greatest(F.lit(1), F.col("plays")) + w["kicks"] * kicks + w["punts"] * punts
    factors = {
        "efficiency": index("success_rate_diff", "success"),
        "explosiveness": index("eq_ppp_diff", "eq_ppp"),
        "finishing": index("points_per_chance_diff", "points_per_drive") + index("chance_rate_diff", "chance_rate") + index("chance_success_diff", "chance_success"),
        "field_position": index(field, "field_position"),
        "turnovers_index": index(F.col("expected_turnovers") - F.col("turnovers"), "luck") + index("sack_rate_diff", "sacks") + index("havoc_rate_diff", "havoc"),
    }
    d = d.withColumns(factors)
    rating = sum((F.lit(w) * F.col("turnovers_index" if f == "turnovers" else f) for f, w in WEIGHTS.items()), F.lit(0.0))
    return d.withColumn("rating", rating)

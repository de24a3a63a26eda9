"""Player leaderboards: names out of play texts, recovered identities, key unions, qualified ranks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldspark.functions.exprs import avg_rank, safe_div, sum0

RUNNER = r"^(.+?) (?:run|rush) for "
PASSER = r"^(.+?) pass "


def actor(text: Column, pattern: str) -> Column:
    """Player named at the head of a play text, NULL if none (also for plays charged to the team)."""
    who = F.regexp_extract(text, pattern, 1)
    return F.when((who != "") & (F.upper(who) != "TEAM"), who)


def player_summary(plays: DataFrame, player: str, keys: list[str]) -> DataFrame:
    """Counts, sums, means and per-game figures of a player's plays."""
    g = plays.where(F.col(player).isNotNull()).groupBy(*keys, player).agg(
        F.count(F.lit(1)).alias("plays"), F.count_distinct("game_id").alias("games"), sum0("epa").alias("tepa"), F.avg("epa").alias("epa_play"), sum0("stat_yardage").alias("yards"), F.avg("success").alias("success")
    )
    return g.withColumns({"plays_game": safe_div("plays", "games"), "epa_game": safe_div("tepa", "games"), "yards_play": safe_div("yards", "plays"), "yards_game": safe_div("yards", "games")})


#: Heads of play texts: who passed, who was sacked, whose pass was intercepted, who caught or was thrown to.
SACKED = r"^(.+?) sacked "
PICKED = r"^(.+?) pass intercepted"
CATCHER = r" pass (?:complete|incomplete) to (.+?)(?: for | at |[,.(]|$)"


def team_games(plays: DataFrame, keys: list[str]) -> DataFrame:
    """keys..., team_games: games in which the team ran a play."""
    return plays.groupBy(*keys).agg(F.count_distinct("game_id").alias("team_games"))


def passer_board(plays: DataFrame, player: Column, keys: list[str], per_team_game: float = 14.0, partition: list[str] | None = None) -> DataFrame:
    """One row per passer: attempts, sacks and interceptions in one aggregate, so that who only has sacks or interceptions is kept.

    plays: passes with play_type, epa, epa_success, stat_yardage, game_id; player: the passer's name or id of a play.
    Attempts are passes that were neither sacks nor intercepted. EPA counts every dropback; the completion share counts
    interceptions as tries. Ranks are among passers with ``per_team_game`` dropbacks for every game of their team.
    """
    kind = F.lower("play_type")
    sack, pick = F.coalesce(kind.contains("sack"), F.lit(False)), F.coalesce(kind.contains("interception"), F.lit(False))
    gain = F.coalesce(F.col("stat_yardage"), F.lit(0))
    p = plays.withColumns({"passer": player, "__sack": sack, "__pick": pick & ~sack}).withColumn("__try", ~F.col("__sack") & ~F.col("__pick"))
    complete = F.col("__try") & F.coalesce(~kind.contains("incompletion"), F.lit(True))
    on = lambda flag, c: F.when(F.col(flag), c)
    board = p.where("passer is not null").groupBy(*keys, "passer").agg(
        F.count_if("__try").alias("att"), F.count_if(complete).alias("comp"), F.count_if(complete & kind.contains("touchdown")).alias("passing_td"),
        F.coalesce(F.nullif(F.count_distinct(on("__try", F.col("game_id"))), F.lit(0)), F.count_distinct("game_id")).alias("games"),
        F.count_if("__sack").alias("sacked"), F.count_if("__pick").alias("pass_int"), sum0(on("__sack", gain)).alias("sack_yds"), sum0("epa").alias("tepa"),
        sum0(F.when(complete, gain)).alias("yards"), F.avg(on("__try", F.col("epa_success"))).alias("success"),
    )
    g, td, picks = F.col("games"), F.col("passing_td"), F.col("pass_int")
    detmer = lambda yards, t, i: yards / 400 * ((t + i) / (1 + F.abs(t - i)))
    board = board.withColumns({"dropbacks": F.col("att") + F.col("sacked") + picks, "sack_adj_yards": F.col("yards") - F.abs("sack_yds")})
    board = board.withColumns(
        {
            "comppct": safe_div("comp", F.col("att") + picks), "yards_dropback": safe_div("sack_adj_yards", "dropbacks"), "epa_play": safe_div("tepa", "dropbacks"), "epa_game": safe_div("tepa", "games"),
            "yards_play": safe_div("yards", "att"), "yards_game": safe_div("yards", "games"), "detmer": detmer(F.col("yards") / g, td, picks), "detmer_game": detmer(F.col("yards") / g, td / g, picks / g),
        }
    )
    board = board.join(team_games(plays, keys), keys)
    enough = F.col("dropbacks") >= F.lit(per_team_game) * F.col("team_games")
    board = board.withColumns({c: F.round(c, 9) for c in ("epa_play", "comppct", "detmer")})
    return qualified_ranks(board, ["epa_play", "comppct", "detmer"], enough, partition or [], [*keys, "passer"])


def receiver_board(plays: DataFrame, player: Column, keys: list[str], per_team_game: float = 1.875, partition: list[str] | None = None) -> DataFrame:
    """One row per receiver: targets, catches, yards, EPA, shares and ranks among those with ``per_team_game`` plays for every team game."""
    kind = F.lower("play_type")
    caught = F.coalesce(~kind.rlike("incompletion|interception|sack"), F.lit(False))
    p = plays.withColumn("receiver", player).where("receiver is not null")
    board = p.groupBy(*keys, "receiver").agg(
        F.count(F.lit(1)).alias("targets"), F.count_if(caught).alias("comp"), F.count_distinct("game_id").alias("games"), sum0("epa").alias("tepa"), F.avg("epa").alias("epa_play"),
        sum0(F.when(caught, F.col("stat_yardage"))).alias("yards"), F.avg("epa_success").alias("success"), F.count_if(caught & kind.contains("touchdown")).alias("td"), F.count_if(F.coalesce(kind.contains("fumble"), F.lit(False))).alias("fumbles"),
    )
    board = board.withColumns({"catchpct": safe_div("comp", "targets"), "yards_play": safe_div("yards", "targets"), "yards_game": safe_div("yards", "games"), "epa_game": safe_div("tepa", "games")})
    board = board.join(team_games(plays, keys), keys)
    board = board.withColumn("epa_play", F.round("epa_play", 9))
    return qualified_ranks(board, ["epa_play"], F.col("targets") >= F.lit(per_team_game) * F.col("team_games"), partition or [], [*keys, "receiver"])


def unambiguous(names: DataFrame, keys: list[str], ident: str) -> DataFrame:
    """(keys, ident) of the names that belong to one id only; the others are removed by an anti join."""
    pairs = names.select(*keys, ident).dropna().distinct()
    twice = pairs.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*keys)
    return pairs.join(twice, keys, "left_anti")


def recover_ids(rows: DataFrame, known: DataFrame, keys: list[str], ident: str) -> DataFrame:
    """Fill a missing id from the name where the name is unambiguous."""
    m = known.select(*keys, F.col(ident).alias("__id"))
    return rows.join(m, keys, "left").withColumn(ident, F.coalesce(ident, "__id")).drop("__id")


def key_union(parts: list[DataFrame], keys: list[str], zero: list[str]) -> DataFrame:
    """Full outer join of aggregates on their keys; missing counts are 0."""
    out = parts[0]
    for p in parts[1:]:
        out = out.join(p, keys, "full")
    return out.fillna(0, zero)


def qualified_ranks(board: DataFrame, measures: list[str], qualifies: Column, partition: list[str], tie: list[str], ascending: bool = False) -> DataFrame:
    """Ranks among those who qualify; the others keep their row without a rank. One window, no join back."""
    out = {}
    for m in measures:
        among = F.when(qualifies, F.col(m))
        r = avg_rank(among, [], tie, ascending=ascending, partition=partition)
        out[f"{m}_rank"] = F.when(qualifies, r)
    return board.withColumns(out)

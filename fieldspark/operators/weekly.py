"""Cumulative weekly snapshots and the strictly earlier as-of join.

A snapshot of week W holds everything up to and including W, so a game of week W may only see W - 1.
Additive measures are aggregated once per week and then accumulated, instead of once per snapshot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldspark.functions.exprs import safe_div, sum0


def weekly_totals(rows: DataFrame, keys: list[str], week: str, sums: list[str]) -> DataFrame:
    """Additive parts per key and week: n and sum of every measure."""
    return rows.groupBy(*keys, week).agg(F.count(F.lit(1)).alias("n"), *[sum0(s).alias(s) for s in sums])


def cumulative(totals: DataFrame, keys: list[str], week: str, sums: list[str], weeks: DataFrame | None = None) -> DataFrame:
    """keys..., through_week and running totals; with ``weeks`` also for weeks without rows of the key.

    The calendar is joined by range against each key's own weeks after aggregation: at most
    (keys x weeks) rows, never rows of the input.
    """
    w = Window.partitionBy(*keys).orderBy(week).rowsBetween(Window.unboundedPreceding, 0)
    run = totals.select(*keys, F.col(week).alias("through_week"), *[F.sum(c).over(w).alias(c) for c in ["n", *sums]])
    if weeks is None:
        return run
    nxt = F.lead("through_week").over(Window.partitionBy(*keys).orderBy("through_week"))
    last = weeks.agg(F.max(week)).first()[0]
    spans = run.withColumn("until", F.coalesce(nxt - 1, F.lit(last)))
    every = spans.withColumn("through_week", F.explode(F.sequence("through_week", F.greatest("through_week", "until")))).drop("until")
    return every.join(weeks.select(F.col(week).alias("through_week")).distinct(), "through_week", "left_semi").select(*keys, "through_week", "n", *sums)


def as_of_previous(events: DataFrame, snapshots: DataFrame, keys: list[str], week: str) -> DataFrame:
    """Events with the snapshot of the week before: an equi-join on the shifted week."""
    s = snapshots.withColumn(week, F.col("through_week") + 1).drop("through_week")
    return events.join(s, [*keys, week], "left")


def assert_boundary(snapshots: DataFrame, keys: list[str], count: str, least: float = 0.3) -> float:
    """Share of keys whose count grows from one week to the next; too few means snapshots do not move."""
    nxt = snapshots.select(*keys, (F.col("through_week") - 1).alias("through_week"), F.col(count).alias("__n"))
    grew = snapshots.join(nxt, [*keys, "through_week"]).agg(F.avg((F.col("__n") > F.col(count)).cast("double"))).first()[0]
    if grew is not None and grew < least:
        raise ValueError(f"only {grew:.0%} of the snapshots grow: not cumulative as of their week")
    return grew


def prior_blend(now, prior, n, k: float):
    """(n * now + k * prior) / (n + k); a missing side leaves the other."""
    return F.coalesce((n * now + F.lit(k) * prior) / (n + F.lit(k)), now, prior)


def resume(games: DataFrame, strength: DataFrame, team: str, opponent: str) -> DataFrame:
    """Strength of schedule per team: mean strength of the opponents, and wins over expectation."""
    s = strength.select(F.col("team_id").alias(opponent), F.col("strength").alias("opp_strength"))
    j = games.join(s, opponent, "left").withColumn("win", (F.col("margin") > 0).cast("double"))
    return j.groupBy(team).agg(F.count(F.lit(1)).alias("games"), F.sum("win").alias("wins"), F.avg("opp_strength").alias("sos"), F.avg("margin").alias("margin")).withColumn("win_rate", safe_div("wins", "games"))


# What an unknown pass rate or pace counts as in a matchup.
EVEN_RATE, USUAL_PACE = 0.5, 70.0


def matchup_features(games: DataFrame, sides: DataFrame, season: str = "season") -> DataFrame:
    """Games with the features of the pairing: edges (own offense plus what the other defense allows), pass rates, pace, and both combined.

    games: game_id, season, home_id, away_id; sides: season, team_id, side (off, def), pass_epa, rush_epa, pass_rate, pace.
    Unknown values count as 0, half and USUAL_PACE. One row per team and side joins twice, no row multiplies.
    """
    values = ["pass_epa", "rush_epa", "pass_rate", "pace"]
    teams = sides.groupBy(season, "team_id").agg(*[F.max(F.when(F.col("side") == s, F.col(v))).alias(f"{v}_{s}") for s in ("off", "def") for v in values])
    out = games
    for at in ("home", "away"):
        named = teams.select(F.col(season), F.col("team_id").alias(f"{at}_id"), *[F.col(f"{v}_{s}").alias(f"__{at}_{v}_{s}") for s in ("off", "def") for v in values])
        out = out.join(named, [season, f"{at}_id"], "left")
    known = lambda c, default: F.coalesce(F.col(c), F.lit(default))
    f = {}
    for at, other in (("home", "away"), ("away", "home")):
        for phase in ("pass", "rush"):
            f[f"{phase}_edge_{at}"] = known(f"__{at}_{phase}_epa_off", 0.0) + known(f"__{other}_{phase}_epa_def", 0.0)
        f[f"pass_rate_{at}"] = 0.5 * known(f"__{at}_pass_rate_off", EVEN_RATE) + 0.5 * known(f"__{other}_pass_rate_def", EVEN_RATE)
    out = out.withColumns({**f, "pace_expected": 0.5 * known("__home_pace_off", USUAL_PACE) + 0.5 * known("__away_pace_off", USUAL_PACE)})
    out = out.withColumns({f"{p}_edge_net": F.col(f"{p}_edge_home") - F.col(f"{p}_edge_away") for p in ("pass", "rush")})
    rate = F.col("pass_rate_home")
    both = {
        "epa_net": (rate * F.col("pass_edge_net") + (1 - rate) * F.col("rush_edge_net")) * F.col("pace_expected"),
        "epa_total": (F.col("pass_edge_home") + F.col("pass_edge_away") + F.col("rush_edge_home") + F.col("rush_edge_away")) * F.col("pace_expected"),
    }
    return out.withColumns(both).drop(*[c for c in out.columns if c.startswith("__")])

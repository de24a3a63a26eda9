"""Going for it on fourth down: the expectation over all gains, in one row per play.

A play carries the probabilities of its 76 gains (10 yards lost to 65 won) as one array. Each outcome's game state and
win probability are computed inside that array, so nothing is exploded or shuffled; the models behind the
probabilities and the win probability are parameters.

Defined results
- gains beyond the goal line are touchdowns; a loss never goes behind the own 1.
- short of the distance the other team takes over at the spot; after a touchdown (6 points) it starts at its own 25.
- six seconds pass. A leader who keeps the ball (or whose opponent just won it back in the lead) with too little time
  against the timeouts left has won (lost).
- NULL in the probabilities, spot, distance or margin: NULL. Probabilities that do not sum to 1 are taken as they are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The classes of the gain, the runoff of a play, and the seconds a leader can run out by the opponent's timeouts.
GAINS, LOWEST_GAIN = 76, -10
RUNOFF = 6
RUN_OUT = {0: 120, 1: 80, 2: 40}
AFTER_TOUCHDOWN, TOUCHDOWN = 75, 6


def outcome(i: Column, play: dict[str, Column], win: Callable[[dict[str, Column]], Column]) -> tuple[Column, Column]:
    """(kept, win probability of the team that had the ball) after the gain of class ``i``."""
    spot = play["yards_to_goal"]
    gain = F.greatest(F.least(i + LOWEST_GAIN, spot), spot - 99)
    kept = gain >= play["distance"]
    scored = kept & (gain == spot)
    lost = ~kept | scored
    side = F.when(lost, -1).otherwise(1)
    after = {
        "yards_to_goal": F.when(scored, AFTER_TOUCHDOWN).when(~kept, 100 - (spot - gain)).otherwise(spot - gain),
        "margin": side * play["margin"] - F.when(scored, TOUCHDOWN).otherwise(0),
        "seconds": F.greatest(play["seconds"] - RUNOFF, F.lit(0)),
        "other_timeouts": F.when(lost, play["own_timeouts"]).otherwise(play["other_timeouts"]),
    }
    w = win(after)
    w = F.when(lost, 1 - w).otherwise(w)
    over = F.lit(False)
    for left, seconds in RUN_OUT.items():
        over = over | ((after["other_timeouts"] == left) & (after["seconds"] < seconds))
    over = F.coalesce(over, F.lit(False))
    w = F.when(kept & ~scored & (after["margin"] > 0) & over, 1.0).when(~kept & (after["margin"] < 0) & over, 0.0).otherwise(w)
    return kept, w


def decide(plays: DataFrame, probs: str, keep: list[str], win: Callable[[dict[str, Column]], Column]) -> DataFrame:
    """keep..., go_wp, first_down_prob, wp_succeed, wp_fail; plays: probs, yards_to_goal, distance, margin, seconds, own_timeouts, other_timeouts.

    win: win probability of the team with the ball, from the state after the play (yards_to_goal, margin, seconds, other_timeouts).
    """
    play = {c: F.col(c) for c in ("yards_to_goal", "distance", "margin", "seconds", "own_timeouts", "other_timeouts")}

    def one(p: Column, i: Column) -> Column:
        kept, w = outcome(i, play, win)
        return F.struct(p.alias("p"), (p * w).alias("pw"), kept.alias("kept"))

    # the generator keeps the outcomes from being computed anew for every figure
    each = plays.select(*keep, F.explode(F.array(F.transform(probs, one))).alias("o"))
    total = lambda what: F.aggregate("o", F.lit(0.0), lambda a, x: a + what(x))
    yes = lambda x, c: F.when(x["kept"], x[c]).otherwise(0.0)
    sums = {"go_wp": total(lambda x: x["pw"]), "first_down_prob": total(lambda x: yes(x, "p")), "__w": total(lambda x: yes(x, "pw")), "__p": total(lambda x: x["p"])}
    s = each.select(*keep, *[c.alias(k) for k, c in sums.items()])
    return s.select(*keep, "go_wp", "first_down_prob", F.try_divide("__w", "first_down_prob").alias("wp_succeed"), F.try_divide(F.col("go_wp") - F.col("__w"), F.col("__p") - F.col("first_down_prob")).alias("wp_fail"))

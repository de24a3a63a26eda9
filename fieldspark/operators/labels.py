"""Labels and sequence features: next score, winners, lags, rest days, out-of-order values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldspark.functions.exprs import back_fill
from fieldspark.operators.prefix import join_back, running


def next_event(rows: DataFrame, partition: list[str], order: list[str], is_event: Column, label: Column, default=None) -> DataFrame:
    """Label of the next event at or after each row of its partition; none: ``default``."""
    marked = rows.withColumn("__l", F.when(is_event, label))
    filled = marked.withColumn("next_label", back_fill("__l", partition, order)).drop("__l")
    return filled if default is None else filled.withColumn("next_label", F.coalesce("next_label", F.lit(default)))


def group_total(rows: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    """Largest value of the group on every row: an aggregate joined back, so that no group has to fit a task."""
    return join_back(rows, rows.groupBy(*keys).agg(F.max(value).alias(out)), keys)


def lagged(rows: DataFrame, keys: list[str], order: list[str], values: list[str], prefix: str = "prev_") -> DataFrame:
    """Values of the adjacent earlier row; gaps in the order are not filled."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumns({f"{prefix}{v}": F.lag(v).over(w) for v in values})


def rest_days(games: DataFrame, team: str, season: str, date: str, tie: str) -> DataFrame:
    """Days since the team's game before, NULL for its first of the season."""
    w = Window.partitionBy(team, season).orderBy(date, tie)
    return games.withColumn("rest_days", F.datediff(F.col(date).cast("date"), F.lag(F.col(date).cast("date")).over(w)))


def out_of_sequence(rows: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """Rows with a smaller value somewhere after them; groups of any size."""
    later = running(rows, keys, [F.desc(o) for o in order], minima={"later_min": value}, others=True)
    return later.withColumn("late_overwrite", F.coalesce(F.col("later_min") < F.col(value), F.lit(False)))


def last_n_mean(rows: DataFrame, key: str, order: list[Column], value: str, n: int, floor: float | None = None) -> DataFrame:
    """Mean of each key's last n values; with ``floor``, raised to that quantile of all means."""
    w = Window.partitionBy(key).orderBy(*order)
    m = rows.withColumn("r", F.row_number().over(w)).where(F.col("r") <= n).groupBy(key).agg(F.avg(value).alias("mean"), F.count(F.lit(1)).alias("n"))
    if floor is None:
        return m
    low = m.agg(F.percentile("mean", F.lit(floor))).first()[0]
    return m.withColumn("mean", F.greatest("mean", F.lit(low))) if low is not None else m


# The classes of the next score, for and against the team with the ball.
SCORES = {"Touchdown": "Touchdown", "Field Goal Good": "Field_Goal", "Safety": "Safety"}
CLASSES = {"Touchdown": 0, "Opp_Touchdown": 1, "Field_Goal": 2, "Opp_Field_Goal": 3, "Safety": 4, "Opp_Safety": 5, "No_Score": 6}


def next_score_labels(plays: DataFrame, order: list[str], team: str, kind: str, scoring: Column, scorer: Column) -> DataFrame:
    """Class of the next score of the half, seen from the team with the ball; half: 1 for periods 1 and 2, else 2.

    scoring: whether the play scores; scorer: the team that does. A scorer that is NULL counts as the other team.
    """
    half = F.when(F.col("period").isin(1, 2), 1).otherwise(2)
    p = plays.withColumn("half", half).withColumn("__s", F.when(scoring, F.struct(F.col(kind).alias("kind"), scorer.alias("by"))))
    p = p.withColumn("__n", back_fill("__s", ["game_id", "half"], order))
    label = F.lit("No_Score")
    for text, name in reversed(SCORES.items()):
        ours = F.coalesce(F.col(team) == F.col("__n.by"), F.lit(False))
        label = F.when(F.contains(F.col("__n.kind"), F.lit(text)), F.when(ours, name).otherwise(f"Opp_{name}")).otherwise(label)
    codes = F.create_map(*[F.lit(x) for kv in CLASSES.items() for x in kv])
    return p.withColumn("next_score", label).withColumn("label", F.element_at(codes, F.col("next_score"))).drop("__s", "__n")


def half_winner(games: DataFrame) -> DataFrame:
    """home_won is strict: a tie is no home win."""
    return games.withColumn("home_won", F.when(F.col("home_score").isNotNull() & F.col("away_score").isNotNull(), F.col("home_score") > F.col("away_score")))

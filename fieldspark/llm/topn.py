"""The N best items of every group, whatever the groups' sizes.

Exact row counts split the groups: a group is heavy if it has more rows than a task's fair share of the table (rows /
shuffle partitions), so there are fewer heavy groups than partitions and their list can be broadcast. Light groups go
through an ordinary window; each heavy group is cut at score quantiles into ranges, ranges that lie wholly behind N
better rows are left out, and the rows of a range are salted, so that no task holds a heavy group (nor all its ties).
The winners of the salted ranges, at most N each, meet in one last window.

Defined results
- order: score descending, then rank ascending (NULL last), then id ascending: total, so repeated runs agree.
- score NULL or NaN: left out; infinities are ordered as numbers. Group NULL: left out.
- rows of one (group, copy key) are one item under the smallest id, with the values of the smallest
  id that has a score; copy key NULL: every row is its own item.
- fewer than N items: all of them. Empty input: no rows. Only the named columns are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldspark.session import cut

#: A group of no more rows than this is light, however small the table.
LEAST_HEAVY = 1000
RANGES = 64
SALTS = 16


def one_per_copy(df: DataFrame, group: str, copy: str, ident: str, score: str, rank: str) -> DataFrame:
    """g, id, score, rank: one row per item (partial aggregation of plain numbers before the shuffle)."""
    d = df.where(F.col(group).isNotNull()).select(F.col(group).alias("g"), F.col(copy).alias("c"), F.col(ident).alias("id"), F.col(score).cast("double").alias("score"), F.col(rank).alias("rank"))
    scored = F.when(F.col("score").isNotNull() & ~F.isnan("score"), F.col("id"))
    own = F.when(F.col("c").isNull(), F.col("id"))  # without a copy key every row stands alone
    one = d.withColumns({"own": own, "sid": scored}).groupBy("g", "c", "own").agg(F.min("id").alias("id"), F.min("sid").alias("sid"), F.min_by("score", "sid").alias("score"), F.min_by("rank", "sid").alias("rank"))
    return one.where("sid is not null").select("g", "id", "score", "rank")


def heavy_groups(rows: DataFrame, group: str, heavy_rows: int | None = None) -> DataFrame:
    """g of the groups with more than ``heavy_rows`` rows (default: a task's fair share), written down."""
    if heavy_rows is None:
        parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        heavy_rows = max(LEAST_HEAVY, rows.count() // parts)
    sizes = rows.where(F.col(group).isNotNull()).groupBy(F.col(group).alias("g")).agg(F.count(F.lit(1)).alias("n"))
    return cut(sizes.where(F.col("n") > heavy_rows).select("g"))


def _first(items: DataFrame, n: int, out: str, *keys: str) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("rank"), F.asc("id")))
    return items.withColumn(out, place).where(F.col(out) <= n)


def _heavy_top(hot: DataFrame, n: int) -> DataFrame:
    """The n best of heavy groups by salted ranges of the score; hot: written down."""
    steps = F.array(*[F.lit(i / RANGES) for i in range(1, RANGES)])
    cuts = F.broadcast(hot.groupBy("g").agg(F.percentile_approx("score", steps, 10 * RANGES).alias("cuts")))
    ranged = hot.join(cuts, "g").withColumn("range", F.size(F.filter("cuts", lambda c: c > F.col("score")))).drop("cuts")
    sizes = ranged.groupBy("g", "range").agg(F.count(F.lit(1)).alias("k"))
    better = F.sum("k").over(Window.partitionBy("g").orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    needed = sizes.withColumn("better", F.coalesce(better, F.lit(0))).where(F.col("better") < n).select("g", "range")
    salted = ranged.join(F.broadcast(needed), ["g", "range"], "left_semi").withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)))
    return _first(_first(salted, n, "r", "g", "range", "salt"), n, "pos", "g")


def _split(rows: DataFrame, heavy: DataFrame, group: str, make, n: int) -> DataFrame:
    out = ["g", F.col("pos").cast("bigint").alias("pos"), "id"]
    if heavy.isEmpty():
        return _first(make(rows), n, "pos", "g").select(*out)
    known = F.broadcast(heavy.withColumnRenamed("g", group))  # fewer groups than partitions
    light = _first(make(rows.join(known, group, "left_anti")), n, "pos", "g")
    return light.select(*out).unionByName(_heavy_top(cut(make(rows.join(known, group, "left_semi"))), n).select(*out))


def top_items(rows: DataFrame, group: str, copy: str, ident: str, score: str, rank: str, n: int, heavy_rows: int | None = None) -> DataFrame:
    """g, pos (from 1), id of the n best items of every group; every row is made an item once, in its group's branch."""
    rows = rows.select(*dict.fromkeys((group, copy, ident, score, rank)))
    return _split(rows, heavy_groups(rows, group, heavy_rows), group, lambda r: one_per_copy(r, group, copy, ident, score, rank), n)


def top_n(items: DataFrame, n: int, heavy_rows: int | None = None) -> DataFrame:
    """The same over items: g, id, score, rank."""
    return _split(items, heavy_groups(items, "g", heavy_rows), "g", lambda r: r, n)

"""Running totals and maxima that no single task has to hold.

A plain window over a hot key sends all its rows through one task. Here each key is cut into
ordered buckets; bucket totals (few rows, pre-aggregated before the shuffle) give every bucket its
carry-in, and only rows of one (key, bucket) meet in a task. ``ordered_buckets`` cuts by counted rows:
where no key is large there is one bucket and the window is an ordinary one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldspark.session import cut

#: Rows of one key that a task may hold.
BUCKET_ROWS = 500_000


def join_back(rows: DataFrame, agg: DataFrame, keys: list[str]) -> DataFrame:
    """Every row with its group's aggregates; NULL keys are a group too."""
    right = agg.withColumnsRenamed({k: f"__k{i}" for i, k in enumerate(keys)})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)])
    return rows.join(right, same, "left").drop(*[f"__k{i}" for i in range(len(keys))])


def ordered_buckets(df: DataFrame, keys: list[str], order: list, rows: int | None = None) -> tuple[DataFrame, bool]:
    """(df with ``bucket``, whether any key was cut): buckets grow with ``order`` inside a key and hold about ``rows`` rows.

    Large keys are cut by Spark's range partitioner over (keys, order), whose sampled bounds balance rows; equal
    orders stay together. The ranges are written down once, as every later step must see the same ones.
    """
    rows = rows or BUCKET_ROWS
    largest, every = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n"), F.sum("n")).first()
    if (largest or 0) <= rows:
        return df.withColumn("bucket", F.lit(0)), False
    return cut(df.repartitionByRange(-(-every // rows) + 1, *keys, *order).withColumn("bucket", F.spark_partition_id())), True


def running(df: DataFrame, keys: list[str], order: list, sums: dict[str, str] | None = None, maxima: dict[str, str] | None = None, minima: dict[str, str] | None = None, rows: int | None = None, others: bool = False) -> DataFrame:
    """Adds columns: sums, maxima and minima (name -> value column) over this and all earlier rows of the key, whatever the key's size.

    With ``others`` the row itself is left out. ``order`` may hold descending columns. NULL adds nothing to a sum and is
    no maximum. Rows of equal order see each other's values in the order given only if ``order`` is total.
    """
    cutdown, hot = ordered_buckets(df, keys, order, rows)
    inside = Window.partitionBy(*keys, *(["bucket"] if hot else [])).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1 if others else 0)
    aggs = {**{o: (F.sum, v) for o, v in (sums or {}).items()}, **{o: (F.max, v) for o, v in (maxima or {}).items()}, **{o: (F.min, v) for o, v in (minima or {}).items()}}
    own = {o: f(v).over(inside) for o, (f, v) in aggs.items()}
    if not hot:
        return cutdown.withColumns({o: F.coalesce(c, F.lit(0)) if o in (sums or {}) else c for o, c in own.items()}).drop("bucket")
    totals = cutdown.groupBy(*keys, "bucket").agg(*[f(v).alias(f"__t_{o}") for o, (f, v) in aggs.items()])
    before = Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(*keys, "bucket", *[f(f"__t_{o}").over(before).alias(f"__c_{o}") for o, (f, _) in aggs.items()])
    joined = cutdown.join(carry, [*keys, "bucket"], "left")
    full = {o: F.coalesce(F.col(f"__c_{o}"), F.lit(0)) + F.coalesce(c, F.lit(0)) if o in (sums or {}) else (F.least if o in (minima or {}) else F.greatest)(F.col(f"__c_{o}"), c) for o, c in own.items()}
    return joined.withColumns(full).drop("bucket", *[f"__c_{o}" for o in aggs])


def _running(df: DataFrame, keys: list[str], bucket: str, order: list[Column], value: str, out: str, agg) -> DataFrame:
    totals = df.groupBy(*keys, bucket).agg(agg(value).alias("__t"))
    before = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(*keys, bucket, agg("__t").over(before).alias("__carry"))
    joined = df.join(carry, [*keys, bucket], "left")
    inside = Window.partitionBy(*keys, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    own = agg(value).over(inside)
    total = F.greatest(F.col("__carry"), own) if agg is F.max else F.coalesce(F.col("__carry"), F.lit(0)) + F.coalesce(own, F.lit(0))
    return joined.withColumn(out, total).drop("__carry")


def running_max(df: DataFrame, keys: list[str], bucket: str, order: list[Column], value: str, out: str) -> DataFrame:
    """Maximum of ``value`` over this and all earlier rows of the key; NULLs are skipped.

    ``bucket`` must grow with ``order``. Keys and bucket must not be NULL (such rows get no carry).
    """
    return _running(df, keys, bucket, order, value, out, F.max)


def running_sum(df: DataFrame, keys: list[str], bucket: str, order: list[Column], value: str, out: str) -> DataFrame:
    """Sum of ``value`` over this and all earlier rows of the key; NULL counts as 0."""
    return _running(df, keys, bucket, order, value, out, F.sum)

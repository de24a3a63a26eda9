"""References to records that do not exist (yet, or any more).

A Bloom filter of the parent keys, built by aggregation and carried in the plan as one literal, proves
most orphans where they are read. Only filter-positive references are verified, each (key, time) once: whether a parent
version covers the time is a running maximum, cut into ranges of counted rows where a key is large. The few pairs that
fail meet the references again in one join, so good references are never shuffled as long as the failing pairs are few.

Defined results
- reference NULL, empty or blank: no reference. Text that reads as no whole number names no parent: ``missing``.
- parent rows with NULL key hold nothing; NULL start: open start; NULL end: open end; end <= start covers nothing.
- reference time NULL: no row covers it, and not all rows begin after it: ``deleted`` (if the key exists).
- equal times: a version covers its start, not its end. Repeated rows count each; empty tables give no rows
  (no parents: every reference is ``missing``).
"""

from __future__ import annotations

import numpy as np
from pyspark import SparkContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldspark.operators.prefix import running
from fieldspark.session import broadcast_if_small, cut

HASHES = 4
MIN_BITS, MAX_BITS = 1 << 16, 1 << 26  # at most 8 MB


def long_array(values: list[int]) -> Column:
    """ARRAY<BIGINT> as one packed literal of the plan, 8 bytes a value (``lit`` of a list would be one expression per value)."""
    sc = SparkContext._active_spark_context
    packed = sc._gateway.new_array(sc._jvm.long, len(values))
    sc._jvm.java.nio.ByteBuffer.wrap(np.array(values, dtype=">i8").tobytes()).asLongBuffer().get(packed)
    sql = sc._jvm.org.apache.spark.sql
    kind = sql.types.ArrayType(sql.types.DataType.fromDDL("bigint"), False)
    literal = sql.catalyst.expressions.Literal(sql.catalyst.expressions.UnsafeArrayData.fromPrimitiveArray(packed), kind)
    return Column(sql.classic.ExpressionUtils.column(literal))


def _positions(key: Column, bits: int) -> list[Column]:
    """Bits of a key, from the halves of one hash; ``bits`` is a power of 2."""
    h = F.xxhash64(key)
    low, high = h.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(h, 32).bitwiseOR(F.lit(1))
    return [(low + high * i).bitwiseAND(F.lit(bits - 1)) for i in range(HASHES)]


def bloom_filter(keys: DataFrame, key: str, bits: int | None = None) -> list[int]:
    """The filter in words of 64 bits; at most MAX_BITS / 64 words, whatever the number of keys.

    The size follows the number of keys (12 bits each) up to MAX_BITS; beyond that the filter only
    lets more references through to the exact join, the result stays the same.
    """
    if bits is None:
        n = keys.select(F.approx_count_distinct(key)).first()[0]
        bits = MIN_BITS
        while bits < 12 * n and bits < MAX_BITS:
            bits *= 2
    pos = keys.where(F.col(key).isNotNull()).select(F.explode(F.array(*_positions(F.col(key), bits))).alias("p"))
    words = pos.groupBy(F.shiftright("p", 6).alias("id")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("w"))
    out = [0] * (bits // 64)
    for r in words.toPandas().itertuples():
        out[r.id] = int(r.w)
    return out


def might_contain(words: list[int], key: Column) -> Column:
    """False only if the key is surely not among the filter's keys; a few shifts per bit inside generated code."""
    filt = long_array(words)
    out = F.lit(True)
    for p in _positions(key, len(words) * 64):
        word = F.get(filt, F.shiftright(p, 6).cast("int"))
        out = out & (F.call_function("shiftright", word, p.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1)) == 1)
    return out


_FIRST, _LAST = "timestamp_ntz'0001-01-01 00:00:00'", "timestamp_ntz'9999-12-31 23:59:59.999999'"


def failing(pairs: DataFrame, parents: DataFrame, bucket_rows: int | None = None) -> DataFrame:
    """key, at, kind of the (key, at) pairs that no parent version covers; parents without NULL keys."""
    until = F.when(F.expr("stop is null or start is null or stop > start"), F.coalesce("stop", F.expr(_LAST))).otherwise(F.expr(_FIRST))
    versions = parents.groupBy("key", F.coalesce("start", F.expr(_FIRST)).alias("time")).agg(F.max(until).alias("stop"))
    events = versions.select("key", "time", F.lit(0).alias("is_ref"), "stop", F.lit(None).cast("timestamp_ntz").alias("at")).unionByName(
        pairs.select("key", F.coalesce("at", F.expr(_LAST)).alias("time"), F.lit(1).alias("is_ref"), F.lit(None).cast("timestamp_ntz").alias("stop"), "at")
    )
    # the latest end of all versions begun so far; NULL: none has begun
    told = running(cut(events), ["key"], ["time", "is_ref"], maxima={"until": "stop"}, rows=bucket_rows).where("is_ref = 1")
    bad = told.where(~F.coalesce(F.col("until") > F.col("at"), F.lit(False)))
    known = broadcast_if_small(parents.select("key", F.lit(True).alias("known")).distinct())
    kind = F.when(F.col("until").isNotNull(), "deleted").when(F.col("known"), "late").otherwise("missing")
    return bad.join(known, "key", "left").select("key", "at", kind.alias("kind"))


def orphans(refs: DataFrame, parents: DataFrame, bits: int | None = None, bucket_rows: int | None = None) -> DataFrame:
    """Orphan references with their kind.

    refs: key (BIGINT, NULL if the text names no parent), at (time) and any further columns; rows
    that are no reference must be left out before. parents: key, start, stop. Result: refs' columns
    and ``kind``.
    """
    parents = parents.where("key is not null").select("key", "start", "stop")
    words = bloom_filter(parents, "key", bits)
    # a key is asked for only if the filter lets it through; NULL: surely missing. The generator keeps the expression that
    # reads the key from being copied into every probe of the filter.
    read = refs.withColumn("__key", F.explode(F.array("key")))
    asked = F.when(F.col("__key").isNotNull() & might_contain(words, F.col("__key")), F.col("__key"))
    routed = read.withColumn("__ask", asked).drop("__key")
    pairs = routed.where("__ask is not null").select(F.col("__ask").alias("key"), "at").distinct()
    bad = broadcast_if_small(failing(pairs, parents, bucket_rows).select(F.col("key").alias("__key"), F.col("at").alias("__at"), F.col("kind").alias("__kind")))
    # rows the filter proved carry no key and spread over the tasks by their time
    joined = routed.join(bad, (F.col("__ask") == F.col("__key")) & F.col("at").eqNullSafe(F.col("__at")), "left")
    kind = F.when(F.col("__ask").isNull(), F.lit("missing")).otherwise(F.col("__kind"))
    return joined.select(*refs.columns, kind.alias("kind")).where("kind is not null")


def orphan_report(found: DataFrame, src: str = "src", period: str = "period") -> DataFrame:
    """Orphans per table, period and kind (partial counts before the shuffle)."""
    return found.groupBy(src, period, "kind").agg(F.count(F.lit(1)).alias("n_orphans"), F.count_distinct("key").alias("n_keys"))

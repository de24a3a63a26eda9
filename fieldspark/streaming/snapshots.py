"""Incremental forms of the weekly snapshots and deliveries on Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_deliveries(stream: DataFrame, key: str, time: str, late: str = "7 days") -> DataFrame:
    """Each key once; repeats within the watermark are dropped, its state is forgotten after it."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def windowed_totals(stream: DataFrame, time: str, keys: list[str], value: str, size: str = "7 days", slide: str | None = None, late: str = "1 day") -> DataFrame:
    """Count and sum per key and event-time window, with bounded state."""
    w = F.window(time, size, slide) if slide else F.window(time, size)
    return stream.withWatermark(time, late).groupBy(w, *keys).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total")).select("window.start", "window.end", *keys, "n", "total")


def sessions(stream: DataFrame, time: str, key: str, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """Activity sessions of a key."""
    return stream.withWatermark(time, late).groupBy(F.session_window(time, gap).alias("w"), key).agg(F.count(F.lit(1)).alias("n")).select("w.start", "w.end", key, "n")


def append_totals(stream: DataFrame, path: str, keys: list[str], week: str, sums: list[str], checkpoint: str):
    """Write additive weekly parts of every micro-batch; a repeated batch overwrites its own partition."""

    def sink(batch: DataFrame, epoch: int) -> None:
        parts = batch.groupBy(*keys, week).agg(F.count(F.lit(1)).alias("n"), *[F.coalesce(F.sum(s), F.lit(0)).alias(s) for s in sums])
        parts.withColumn("epoch", F.lit(epoch)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("epoch").parquet(path)

    return stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def merged_totals(parts: DataFrame, keys: list[str], week: str, sums: list[str]) -> DataFrame:
    """Weekly totals over all micro-batches, ready for the cumulative snapshots."""
    return parts.groupBy(*keys, week).agg(F.sum("n").alias("n"), *[F.sum(s).alias(s) for s in sums])

"""Writing season tables: partitioned, idempotent, with a manifest and refusals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_season(df: DataFrame, base: str, dataset: str, season: int, csv: bool = False) -> int:
    """Replace one season of a dataset; an empty frame writes nothing and leaves what is there. Returns the rows written.

    The frame is computed once, into a staging folder; its rows are counted from the written footers, and the
    folder then takes the season's place by renaming.
    """
    spark = df.sparkSession
    staged, final = f"{base}/{dataset}/_staged/season={season}", f"{base}/{dataset}/parquet/season={season}"
    df.drop("season").write.mode("overwrite").parquet(staged)
    rows = spark.read.parquet(staged).count()
    _take_place(spark, staged, final if rows else None)
    if not rows:
        return 0
    if csv:
        flat = spark.read.parquet(final)
        flat.write.mode("overwrite").option("header", "true").option("compression", "gzip").csv(f"{base}/{dataset}/csv/{season}")
    upsert_manifest(spark, base, dataset, season, rows)
    return rows


def _take_place(spark: SparkSession, staged: str, final: str | None) -> None:
    """Rename a staged folder to its final place; without one, remove it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    here = path(staged)
    fs = here.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if final is None:
        fs.delete(here, True)
        return
    there = path(final)
    fs.mkdirs(there.getParent())
    fs.delete(there, True)
    if not fs.rename(here, there):
        raise OSError(f"cannot put {staged} in the place of {final}")


def upsert_manifest(spark: SparkSession, base: str, dataset: str, season: int, rows: int) -> None:
    """One manifest file per season, replaced as a whole; readers see a table sorted by season."""
    row = spark.range(1).select(F.lit(season).alias("season"), F.lit(rows).alias("row_count"), F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("generated_at_utc"))
    row.coalesce(1).write.mode("overwrite").json(f"{base}/{dataset}/manifest/part_season={season}")


def read_manifest(spark: SparkSession, base: str, dataset: str) -> DataFrame:
    return spark.read.schema("season int, row_count bigint, generated_at_utc string").option("recursiveFileLookup", "true").json(f"{base}/{dataset}/manifest").orderBy("season")


def run_summary(spark: SparkSession, base: str, datasets: list[str]) -> DataFrame:
    """Seasons and rows of several datasets from their manifests."""
    out = None
    for d in datasets:
        m = read_manifest(spark, base, d).groupBy().agg(F.lit(d).alias("dataset"), F.count(F.lit(1)).alias("seasons"), F.sum("row_count").alias("rows"), F.max("season").alias("last_season"))
        out = m if out is None else out.unionByName(m)
    return out


def write_snapshot(df: DataFrame, base: str, dataset: str, through_week: int, publish: bool = False) -> None:
    """A weekly snapshot lives in its own partition and is never published."""
    if publish:
        raise ValueError("snapshots are not published")
    df.withColumn("through_week", F.lit(through_week)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("through_week").parquet(f"{base}/snapshots/{dataset}")


def publish_plan(spark: SparkSession, base: str, dataset: str, seasons: list[int]) -> DataFrame:
    """What would be published (dry run); nothing to publish is an error."""
    m = read_manifest(spark, base, dataset).where(F.col("season").isin(seasons) & (F.col("row_count") > 0))
    if m.isEmpty():
        raise ValueError(f"{dataset}: nothing to publish")
    return m.select("season", "row_count", F.concat(F.lit(f"{base}/{dataset}/parquet/season="), F.col("season").cast("string")).alias("path"))


def versioned_input(spark: SparkSession, source: str, archive: str) -> DataFrame:
    """Copy a source once and read the copy from then on, whatever happens to the source."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{archive}/_SUCCESS")
    if not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        spark.read.parquet(source).write.mode("overwrite").parquet(archive)
    return spark.read.parquet(archive)

"""Reading inputs: documents with quarantine, tables with pruning, curves, page stores, id unions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_CURVE = 100_000


def json_documents(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(documents, quarantine): one document per file as VARIANT; unreadable files are kept apart, none stops the read."""
    raw = spark.read.option("wholetext", "true").option("recursiveFileLookup", "true").text(path).select(F.input_file_name().alias("file"), F.col("value").alias("body"))
    parsed = raw.withColumn("doc", F.try_parse_json("body"))
    return parsed.where("doc is not null").drop("body"), parsed.where("doc is null").select("file", "body")


def json_rows(spark: SparkSession, path: str, schema: str, seasons: list[int] | None = None) -> DataFrame:
    """JSON lines with a pinned schema (no inference pass)."""
    df = spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)
    return df.where(F.col("season").isin(seasons)) if seasons else df


def schedule_ids(spark: SparkSession, path: str, seasons: list[int]) -> DataFrame:
    """Game ids of the seasons; the filter and the two columns reach the scan."""
    return spark.read.parquet(path).where(F.col("season").isin(seasons)).select("game_id").where("game_id is not null").distinct()


def curve(spark: SparkSession, path: str, key: str, value: str) -> list[float]:
    """A lookup curve, ordered by its key; more than MAX_CURVE points are an error, as a curve becomes a literal of the plan."""
    rows = spark.read.csv(path, header=True, schema=f"{key} double, {value} double").orderBy(key).limit(MAX_CURVE + 1).collect()
    if len(rows) > MAX_CURVE:
        raise ValueError(f"{path}: more than {MAX_CURVE} points")
    return [float(r[value]) for r in rows]


def complete_years(pages: DataFrame, manifest: DataFrame, years: list[int] | None = None) -> DataFrame:
    """Pages of the years the manifest calls complete; asking for an incomplete year is an error."""
    done = manifest.where("complete").select("year").distinct()
    if years:
        want = manifest.sparkSession.createDataFrame([(y,) for y in years], "year int")
        lacking = [r[0] for r in want.join(done, "year", "left_anti").collect()]
        if lacking:
            raise ValueError(f"incomplete years: {sorted(lacking)}")
        done = done.join(want, "year", "left_semi")
    return pages.join(done, "year", "left_semi")


def union_ids(scheduled: DataFrame, released: DataFrame, cached: DataFrame) -> DataFrame:
    """Scheduled ids and the released ones missing from them, as far as they are cached."""
    extra = released.select("game_id").join(scheduled, "game_id", "left_anti")
    return scheduled.select("game_id").unionByName(extra).distinct().join(cached.select("game_id"), "game_id", "left_semi")


def crosswalk(a: DataFrame, b: DataFrame, on: list[str], a_id: str, b_id: str, source: str) -> DataFrame:
    """Distinct pairs of ids from two sources that share their keys, with where they come from."""
    return a.select(*on, a_id).dropna().distinct().join(b.select(*on, b_id).dropna().distinct(), on).select(a_id, b_id).distinct().withColumn("source", F.lit(source))


def local_first(spark: SparkSession, local: str, fallback: str) -> DataFrame:
    """Parquet where it exists, else (compressed) CSV with a header."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(local)
    if hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.read.parquet(local)
    return spark.read.csv(fallback, header=True, inferSchema=True)

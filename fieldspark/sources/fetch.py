"""Fetching documents over a network into a table, as far as they are not there yet.

Requests are rows. Those whose answer is cached are removed by an anti join, the rest are fetched by the tasks, each
politely: waiting and trying again where the server asks for it. How a request is made is a parameter, ``get(url) ->
(status, headers, body)``, so nothing here needs a network or a particular client.

Defined results
- status 200: the body is kept. 429 and 5xx: tried again after the answer's Retry-After, or 2^n seconds, at most
  MAX_WAIT; the last status is kept if it never ends well. Other statuses are final. A request that raises is status 0 and tried again.
- a host that is not on the list, or a scheme other than https: status -1, never requested.
- NULL keys or urls are no requests; equal keys are one request (the smallest url).
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Get = Callable[[str], tuple[int, dict[str, str], str]]

# The longest wait between tries, in seconds, and the tries of an ordinary and of a final document.
MAX_WAIT = 60
TRIES, FINAL_TRIES = 6, 3
#: Weeks and season types (regular, post-season) that a season is probed for.
WEEKS, SEASON_TYPES = 20, (2, 3)
SCHEMA = "key string, url string, status int, body string"


def allowed(url: str, hosts: frozenset[str] | None) -> bool:
    parts = urlsplit(url)
    return parts.scheme == "https" and (hosts is None or parts.hostname in hosts)


def wait_before(attempt: int, headers: dict[str, str] | None = None) -> float:
    """Seconds before try number ``attempt`` (the first retry is 1): the server's wish, or 1, 2, 4, ..."""
    wish = {k.lower(): v for k, v in (headers or {}).items()}.get("retry-after", "")
    return float(min(MAX_WAIT, int(wish) if wish.isdigit() else 2 ** (attempt - 1)))


def polite_get(get: Get, url: str, tries: int = TRIES, sleep: Callable[[float], None] = time.sleep) -> tuple[int, str | None]:
    """(status, body) after at most ``tries`` tries."""
    status = 0
    for attempt in range(1, tries + 1):
        headers: dict[str, str] = {}
        try:
            status, headers, body = get(url)
        except Exception:  # noqa: BLE001 (whatever a client raises, the request has failed)
            status, body = 0, None
        if status == 200:
            return status, body
        if status not in (0, 429) and status < 500:
            break
        if attempt < tries:
            sleep(wait_before(attempt, headers))
    return status, None


def fetched(requests: DataFrame, get: Get, hosts: frozenset[str] | None = None, tries: int = TRIES, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """key, url, status, body of every request; requests: key, url. The number of partitions is the number of callers at a time."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            got = [polite_get(get, u, tries, sleep) if allowed(u, hosts) else (-1, None) for u in p["url"]]
            yield pd.DataFrame({"key": p["key"], "url": p["url"], "status": [s for s, _ in got], "body": [b for _, b in got]})

    one = requests.where("key is not null and url is not null").groupBy(F.col("key").cast("string").alias("key")).agg(F.min("url").alias("url"))
    return one.mapInPandas(run, SCHEMA)


def cached(spark: SparkSession, cache: str) -> DataFrame:
    """Answers kept so far; an absent cache is empty."""
    here = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(cache)
    if here.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(here):
        return spark.read.schema(SCHEMA).parquet(cache)
    return spark.createDataFrame([], SCHEMA)


def missing(requests: DataFrame, cache: str) -> DataFrame:
    """Requests without a good answer in the cache."""
    good = cached(requests.sparkSession, cache).where("status = 200").select("key").distinct()
    return requests.withColumn("key", F.col("key").cast("string")).join(good, "key", "left_anti")


def fetch_missing(requests: DataFrame, get: Get, cache: str, hosts: frozenset[str] | None = None, callers: int = 6, tries: int = TRIES, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """Fetch what the cache lacks, append the answers, and return the good answers to all requests.

    A task that is lost fetches its share again; an answer that is kept twice counts once.
    """
    spark = requests.sparkSession
    want = requests.select(F.col("key").cast("string").alias("key"), "url")
    todo = missing(want, cache).where("url is not null").repartition(callers, "key")
    fetched(todo, get, hosts, tries, sleep).write.mode("append").parquet(cache)
    good = cached(spark, cache).where("status = 200").groupBy("key").agg(F.min_by(F.struct("url", "body"), "url").alias("a")).select("key", "a.*")
    return good.join(want.select("key").distinct(), "key", "left_semi")


def season_chunks(spark: SparkSession, seasons: list[int], url: str, weeks: int = WEEKS, types: tuple[int, ...] = SEASON_TYPES) -> DataFrame:
    """key, url of every (season, type, week); ``url`` is a pattern with {season}, {type} and {week}."""
    rows = [(f"{s}-{t}-{w}", url.format(season=s, type=t, week=w)) for s in seasons for t in types for w in range(1, weeks + 1)]
    return spark.createDataFrame(rows, "key string, url string")


def linked_requests(answers: DataFrame, array_path: str, ref: str = "$ref") -> DataFrame:
    """key, url of the references that answers hold in an array (``{"$ref": url}``), keyed by the last whole number of the url's path."""
    items = F.expr(f"try_variant_get(try_parse_json(body), '{array_path}', 'array<map<string,string>>')")
    urls = answers.select(F.explode(items).alias("r")).select(F.try_element_at("r", F.lit(ref)).alias("u")).where("u is not null")
    url = F.regexp_replace("u", "^http://", "https://")
    return urls.select(F.nullif(F.regexp_extract("u", r"/(\d+)(?:[/?][^/\d]*)?$", 1), F.lit("")).alias("key"), url.alias("url")).where("key is not null").distinct()

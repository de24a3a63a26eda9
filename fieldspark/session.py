"""Session settings and lineage cuts."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(app: str = "fieldspark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the engine's pinned settings (UTC, AQE, ANSI)."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    fixed = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    for k, v in {**fixed, **conf}.items():
        b = b.config(k, v)
    return b.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: the cluster's ``spark.checkpoint.dir``.

    Only a local session without the setting (tests) takes a temporary folder, which is removed at exit;
    a cluster without it is an error, as a folder of one machine would lose data.
    """
    sc = spark.sparkContext
    have = sc._jsc.sc().getCheckpointDir()
    if have.isDefined():
        return have.get()
    shared = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="fieldspark_cp_")
        atexit.register(shutil.rmtree, shared, ignore_errors=True)
    sc.setCheckpointDir(shared)
    return sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and go on from the files."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def broadcast_if_small(df: DataFrame, rows: int = 200_000) -> DataFrame:
    """``df``, cut; marked for broadcasting only if it has at most ``rows`` rows (else the planner decides)."""
    df = cut(df)
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def _file(spark: SparkSession, path: str):
    here = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return here.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), here


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file in the shared folder, without a job."""
    fs, here = _file(spark, path)
    out = fs.create(here, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, here = _file(spark, path)
    stream = fs.open(here)
    text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    return text


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make the package importable in Python workers, once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="fieldspark_zip_"), "fieldspark.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.join("fieldspark", os.path.relpath(full, root)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)

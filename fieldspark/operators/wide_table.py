"""Attribute-value rows into wide tables, as a log of sparse deltas.

Every batch of (entity, attribute, value) rows becomes one *run*: sorted sparse wide rows, one per entity, each a
map from the attributes that occur in the batch to a cell with its version. Compaction merges any number of runs by
keeping the latest version of every cell. The work goes with the rows, not with rows x attributes: rows are reduced
per (entity, attribute) by partial aggregates before they are shuffled, and columns appear only when the table is read.

A run knows nothing of the other runs: a row without a name is kept under its label, read once for each kind of value,
and takes its attribute when the table is read, from the label catalogue that all batches add to.

Defined results
- entity part NULL: the row counts for nothing.
- attribute NULL, blank or punctuation only: the attribute its label stands for in most named rows of all batches;
  an unknown label makes no attribute.
- letter case, blanks and punctuation of names and labels make no difference.
- unreadable value (also empty text, NaN): the row fills no cell and replaces none.
- equal versions: the larger tie-break id wins; repeated rows and repeated batches change nothing.
- empty input: no attributes, no rows. Further columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fieldspark.functions.exprs import plain_text, squash_key
from fieldspark.session import broadcast_if_small, read_text, shared_folder, write_text

#: More attributes than this is an error, as every attribute is a column of the plan.
MAX_ATTRIBUTES = 5000

# Attributes that are no whole numbers, by kind.
BOX_SCORE_KINDS = {
    "yardsPerPass": "decimal",
    "yardsPerRushAttempt": "decimal",
    "successRate": "decimal",
    "possessionTime": "duration",
    "completionAttempts": "pair",
    "thirdDownEff": "pair",
    "fourthDownEff": "pair",
    "totalPenaltiesYards": "pair",
    "sacksYardsLost": "pair",
}


@dataclass(frozen=True)
class Layout:
    """Which columns of the input play which part."""

    entity: tuple[str, ...] = ("game_id", "team_id")
    name: str = "stat_name"
    label: str = "stat_label"
    text: str = "display_value"
    number: str = "stat_value"
    version: str = "loaded_at"
    tie: str = "stat_row_id"
    kinds: dict[str, str] = field(default_factory=lambda: dict(BOX_SCORE_KINDS))

    def kind_by_key(self) -> dict[str, str]:
        return {"".join(ch for ch in k.lower() if ch.isalnum()): v for k, v in self.kinds.items()}


# ------------------------------------------------------------------ names
KINDS = ("whole", "decimal", "duration", "pair")


def name_counts(rows: DataFrame, lay: Layout, run: Column) -> DataFrame:
    """run, label, name, n: how often each spelling of a label goes with each spelling of a name."""
    return rows.groupBy(run.alias("run"), F.col(lay.label).alias("label"), F.col(lay.name).alias("name")).agg(F.count(F.lit(1)).alias("n"))


def attribute_names(counts: DataFrame) -> DataFrame:
    """(attribute_key, attribute): the spelling most rows use; ties go to the smaller spelling."""
    spelled = counts.groupBy(F.col("name").alias("attribute")).agg(F.sum("n").alias("n"))
    keyed = spelled.withColumn("attribute_key", squash_key("attribute")).where("attribute_key is not null")
    best = Window.partitionBy("attribute_key").orderBy(F.desc("n"), F.asc("attribute"))
    return keyed.withColumn("r", F.row_number().over(best)).where("r = 1").select("attribute_key", "attribute")


def label_meanings(counts: DataFrame) -> DataFrame:
    """(label_key, attribute_key): the attribute a label stands for in most rows that have both."""
    keyed = counts.select(squash_key("label").alias("label_key"), squash_key("name").alias("attribute_key"), "n").dropna()
    counted = keyed.groupBy("label_key", "attribute_key").agg(F.sum("n").alias("n"))
    best = Window.partitionBy("label_key").orderBy(F.desc("n"), F.asc("attribute_key"))
    return counted.withColumn("r", F.row_number().over(best)).where("r = 1").select("label_key", "attribute_key")


# ------------------------------------------------------------------ values
_GROUPED = r"[0-9]{1,3}(,[0-9]{3})+"


def _whole(s: Column) -> Column:
    digits = F.translate(F.substring_index(s, ".", 1), ",()+ ", "")
    signed = F.when(s.startswith("("), F.concat(F.lit("-"), digits)).otherwise(digits)
    body = rf"([0-9]+|{_GROUPED})(\.0*)?"
    return F.when(s.rlike("^[0-9]+$"), s.try_cast("bigint")).when(s.rlike(rf"^([+-] ?)?{body}$") | s.rlike(rf"^\({body}\)$"), signed.try_cast("bigint"))


def _thousandths(s: Column) -> Column:
    plain = F.when(s.rlike(rf"^[(+-]* ?{_GROUPED}\.[0-9]*\)?$"), F.replace(s, F.lit(","), F.lit(""))).otherwise(F.replace(s, F.lit(","), F.lit(".")))
    digits = F.regexp_replace(plain, r"[()+ ]", "")
    signed = F.when(plain.startswith("("), F.concat(F.lit("-"), digits)).otherwise(digits)
    body = r"([0-9]+(\.[0-9]*)?|\.[0-9]+)"
    ok = plain.rlike(rf"^([+-] ?)?{body}$") | plain.rlike(rf"^\({body}\)$")
    return F.when(ok, (signed.try_cast("decimal(30,3)") * 1000).try_cast("bigint"))


def _seconds(s: Column) -> Column:
    clock = r"^([0-9]{1,2}:)?([0-9]{1,3}):([0-5][0-9])$"
    part = lambda pattern, i: F.regexp_extract(s, pattern, i)
    hours = F.coalesce(F.nullif(F.replace(part(clock, 1), F.lit(":"), F.lit("")), F.lit("")).cast("bigint"), F.lit(0))
    spelled = r"^(?i)([0-9]{1,3}) ?m(?:in)?(?:utes)?\.? ?([0-5]?[0-9]) ?s(?:ec)?(?:onds)?\.?$"
    return F.when(s.rlike(clock), hours * 3600 + part(clock, 2).try_cast("bigint") * 60 + part(clock, 3).try_cast("bigint")).when(
        s.rlike(spelled), part(spelled, 1).try_cast("bigint") * 60 + part(spelled, 2).try_cast("bigint")
    )


_PAIR = r"^([0-9]{1,9}) ?(?:[-/‐-―]|(?i:of)) ?([0-9]{1,9})(?: ?\([0-9]+(?:[.,][0-9]+)? ?%\))?$"


def cell_value(kind: Column, text: Column, number: Column) -> Column:
    """struct(a, b) of the value read by its kind: the number, thousandths, seconds, or both numbers of a pair; a is NULL if unreadable."""
    s = plain_text(text)
    num = F.when(~F.isnan(number) & (F.abs(number) < 1e15), number)
    integral = F.when(num == F.floor(num), num.try_cast("bigint"))
    first = F.when(s.rlike(_PAIR), F.regexp_extract(s, _PAIR, 1).try_cast("bigint"))
    second = F.when(s.rlike(_PAIR), F.regexp_extract(s, _PAIR, 2).try_cast("bigint"))
    from_text = F.when(kind == "pair", first).when(kind == "decimal", _thousandths(s)).when(kind == "duration", _seconds(s)).otherwise(_whole(s))
    from_number = F.when(kind == "decimal", F.round(num * 1000).try_cast("bigint")).when(kind != "pair", integral)
    a = F.when(text.isNotNull(), from_text).otherwise(from_number)
    return F.struct(a.alias("a"), F.when(kind == "pair", second).alias("b"))


# ------------------------------------------------------------------ log-structured table
def _kind_of(lay: Layout, key: str) -> Column:
    if not lay.kinds:
        return F.lit("whole")
    kinds = F.create_map(*[F.lit(x) for kv in lay.kind_by_key().items() for x in kv])
    return F.coalesce(F.try_element_at(kinds, F.col(key)), F.lit("whole"))


def readings(rows: DataFrame, lay: Layout, run: Column) -> DataFrame:
    """run, entity..., key, version, tie, a, b of every readable row.

    key: the attribute's key, or for a row without a name ``?kind?label key``, once for each kind it reads as.
    """
    r = rows.where(" and ".join(f"`{c}` is not null" for c in lay.entity)).select(
        run.alias("run"), *lay.entity, squash_key(lay.name).alias("own_key"), F.col(lay.label).alias("label"), F.col(lay.text).alias("t"),
        F.col(lay.number).cast("double").alias("x"), F.col(lay.version).alias("version"), F.col(lay.tie).alias("tie"),
    )
    r = r.withColumn("label_key", F.when(F.col("own_key").isNull(), squash_key("label"))).drop("label")
    kinds = F.when(F.col("own_key").isNotNull(), F.array(_kind_of(lay, "own_key"))).when(F.col("label_key").isNotNull(), F.array(*[F.lit(k) for k in KINDS]))
    r = r.withColumn("kind", F.explode(kinds))
    key = F.coalesce("own_key", F.concat(F.lit("?"), "kind", F.lit("?"), "label_key"))
    # the generator keeps the long reading expressions from being copied into the aggregate
    read = F.filter(F.array(cell_value(F.col("kind"), F.col("t"), F.col("x"))), lambda c: c["a"].isNotNull())
    return r.select("run", *lay.entity, key.alias("key"), "version", "tie", F.inline(read))


def latest(cells: DataFrame, keys: list[str]) -> DataFrame:
    """The latest version of every cell: keys..., cell (version, tie, a, b)."""
    return cells.groupBy(*keys).agg(F.max("cell").alias("cell"))


class WideTableLog:
    """A wide table kept in a folder as sorted runs: ``append`` adds runs, ``merge`` rewrites all runs as one.

    A run takes its place whole (the committer renames it), so a lost executor leaves nothing half written; appending
    the same batch again replaces its run. ``runs`` holds the sparse rows, ``names`` the label catalogue.
    """

    def __init__(self, spark, path: str, lay: Layout | None = None):
        self.spark, self.path, self.lay = spark, path.rstrip("/"), lay or Layout()

    def _write(self, df: DataFrame, part: str) -> None:
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run").parquet(f"{self.path}/{part}")
        write_text(self.spark, f"{self.path}/{part}.schema", df.drop("run").schema.json())  # an empty log has no file to tell it

    def _read(self, part: str) -> DataFrame:
        schema = StructType.fromJson(json.loads(read_text(self.spark, f"{self.path}/{part}.schema")))
        return self.spark.read.schema(schema).parquet(f"{self.path}/{part}")

    def _write_runs(self, cells: DataFrame) -> None:
        """Sparse wide rows out of single cells (run, entity..., key, cell), in sorted runs: a range of (run, entity) per task."""
        place = ["run", *self.lay.entity]
        sparse = cells.repartitionByRange(*place).groupBy(*place).agg(F.map_from_entries(F.collect_list(F.struct("key", "cell"))).alias("cells"))
        self._write(sparse.sortWithinPartitions(*place), "runs")

    def append(self, rows: DataFrame, run) -> None:
        """Add the rows as runs; ``run``: a number or text for one batch, or a column that tells a row's batch."""
        run = (run if isinstance(run, Column) else F.lit(run)).cast("string")
        cells = readings(rows, self.lay, run).select("run", *self.lay.entity, "key", F.struct("version", "tie", "a", "b").alias("cell"))
        self._write_runs(latest(cells, ["run", *self.lay.entity, "key"]))
        self._write(name_counts(rows, self.lay, run), "names")

    def _single_cells(self) -> DataFrame:
        return self._read("runs").select(*self.lay.entity, F.explode("cells").alias("key", "cell"))

    def catalogue(self) -> list[tuple[str, str]]:
        """The attributes as (key, spelling), sorted by key; at most MAX_ATTRIBUTES, else an error."""
        got = attribute_names(self._read("names")).limit(MAX_ATTRIBUTES + 1).collect()
        if len(got) > MAX_ATTRIBUTES:
            raise ValueError(f"more than {MAX_ATTRIBUTES} attributes")
        return sorted((r["attribute_key"], r["attribute"]) for r in got)

    def cells(self) -> DataFrame:
        """entity..., attribute_key, cell: the compacted table's filled cells."""
        labels = broadcast_if_small(label_meanings(self._read("names")).select("label_key", F.col("attribute_key").alias("meant")))
        part = F.split("key", r"\?", 3)
        unnamed = F.col("key").startswith("?")
        c = self._single_cells().select("*", F.when(unnamed, F.get(part, 1)).alias("read_as"), F.when(unnamed, F.get(part, 2)).alias("label_key"))
        c = c.join(labels, "label_key", "left").withColumn("attribute_key", F.when(F.col("read_as").isNull(), F.col("key")).otherwise(F.col("meant")))
        fits = F.col("read_as").isNull() | (F.col("read_as") == _kind_of(self.lay, "attribute_key"))
        return latest(c.where(F.col("attribute_key").isNotNull() & fits), [*self.lay.entity, "attribute_key"])

    def _pivot(self, column) -> DataFrame:
        """One row per entity; ``column``(cell, key, name) makes each attribute's column."""
        rows = self.cells().groupBy(*self.lay.entity).agg(F.map_from_entries(F.collect_list(F.struct("attribute_key", "cell"))).alias("m"))
        return rows.select(*self.lay.entity, *[column(F.try_element_at("m", F.lit(k)), k, name) for k, name in self.catalogue()])

    def read(self) -> DataFrame:
        """The table with its versioned cells ``c_<key>``."""
        return self._pivot(lambda c, k, name: c.alias(f"c_{k}"))

    def typed(self) -> DataFrame:
        """One typed column per attribute, named by its usual spelling."""
        kinds = self.lay.kind_by_key()
        return self._pivot(lambda c, k, name: _typed(kinds.get(k, "whole"), c).alias(name))

    def long(self) -> DataFrame:
        """entity..., stat, val of the filled cells (pairs as 1000 x first + second)."""
        known = self.catalogue()
        names = F.create_map(*[F.lit(x) for kv in known for x in kv]) if known else F.create_map().cast("map<string,string>")
        val = F.when(F.col("cell.b").isNull(), F.col("cell.a")).otherwise(F.col("cell.a") * 1000 + F.col("cell.b"))
        return self.cells().select(*self.lay.entity, F.try_element_at(names, F.col("attribute_key")).alias("stat"), val.alias("val"))

    def merge(self, target: str) -> "WideTableLog":
        """Write one sorted run to ``target`` and return the log there; the old runs stay for readers."""
        out = WideTableLog(self.spark, target, self.lay)
        out._write_runs(latest(self._single_cells(), [*self.lay.entity, "key"]).withColumn("run", F.lit("0")))
        counts = self._read("names").groupBy("label", "name").agg(F.sum("n").alias("n")).withColumn("run", F.lit("0"))
        out._write(counts.select("run", "label", "name", "n"), "names")
        return out


def _typed(kind: str, cell: Column) -> Column:
    a, b = cell["a"], cell["b"]
    if kind == "decimal":
        return (a.cast("decimal(19,0)") * F.lit("0.001").cast("decimal(3,3)")).cast("decimal(19,3)")
    if kind == "pair":
        return F.when(a.isNotNull(), F.struct(a.alias("first"), b.alias("second")))
    return a


def as_log(rows: DataFrame, lay: Layout | None = None, batch: Column | None = None) -> WideTableLog:
    """The rows as a log in the shared folder; ``batch`` cuts them into runs, by default the month of the version."""
    lay = lay or Layout()
    log = WideTableLog(rows.sparkSession, f"{shared_folder(rows.sparkSession)}/wide_{uuid.uuid4().hex}", lay)
    log.append(rows, F.date_format(F.col(lay.version), "yyyy-MM") if batch is None else batch)
    return log


def wide_table(rows: DataFrame, lay: Layout | None = None) -> DataFrame:
    """One row per entity with one typed column per attribute, named by its usual spelling.

    Whole numbers and seconds are BIGINT, decimals DECIMAL(19,3) (as wide as the BIGINT of their thousandths), pairs STRUCT<first, second>.
    """
    return as_log(rows, lay).typed()


def long_cells(rows: DataFrame, lay: Layout | None = None) -> DataFrame:
    """The wide table's filled cells as entity..., stat, val (pairs as 1000 x first + second)."""
    return as_log(rows, lay).long()

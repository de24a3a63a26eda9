"""Reshaping: nested cells, dynamic keys, pivots, unions by name with widening, column conventions."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldspark.functions.exprs import scaled_between
from fieldspark.operators.prefix import join_back
from pyspark.sql import types as T


def normalise_cell(c: Column, kind: T.DataType) -> Column:
    """Export form of a cell: empty lists are NULL, lists of one are unboxed, the rest is compact JSON."""
    if isinstance(kind, T.ArrayType):
        inner = normalise_cell(F.get(c, 0), kind.elementType)
        whole = F.to_json(c, {"ignoreNullFields": "false"})
        return F.when(F.size(c) == 0, F.lit(None)).when(F.size(c) == 1, inner.cast("string")).otherwise(whole)
    if isinstance(kind, (T.StructType, T.MapType)):
        return F.to_json(c, {"ignoreNullFields": "false"})
    return c


def normalise_frame(df: DataFrame) -> DataFrame:
    return df.select(*[normalise_cell(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema])


def stamp(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    """Set identity columns: overwritten in place where present, else appended."""
    return df.withColumns(values)


def flat_block(df: DataFrame, block: str, keep: list[str]) -> DataFrame:
    """One row per object of an array column; rows without objects stay with NULL fields."""
    return df.select(*keep, F.inline_outer(F.col(block)))


def dynamic_objects(df: DataFrame, json: str, keep: list[str]) -> DataFrame:
    """One row per entry of a JSON object whose values are objects; scalars beside them are skipped."""
    pairs = F.explode(F.expr(f"map_entries(try_variant_get(try_parse_json({json}), '$', 'map<string,variant>'))"))
    rows = df.select(*keep, pairs.alias("e")).where("try_variant_get(e.value, '$', 'map<string,variant>') is not null")
    return rows.select(*keep, F.col("e.key").alias("key"), F.col("e.value").alias("value"))


def unbox(df: DataFrame, a: str, b: str, keep: list[str]) -> DataFrame:
    """Zip a list of keys with a list of values; on unequal lengths the values are named by place."""
    keys = F.when(F.size(a) == F.size(b), F.col(a)).otherwise(F.transform(b, lambda x, i: F.concat(F.lit("stat_"), i.cast("string"))))
    z = F.explode(F.arrays_zip(keys.alias("k"), F.col(b).alias("v")))
    return df.select(*keep, z.alias("z")).select(*keep, F.col("z.k").alias("key"), F.col("z.v").alias("value"))


def to_wide(df: DataFrame, keys: list[str], name: str, value: Column, names: list) -> DataFrame:
    """Pivot with the names given, so no extra job lists them; of several values the first by value."""
    return df.groupBy(*keys).pivot(name, names).agg(F.min(value))


def to_long(df: DataFrame, keys: list[str], columns: list[str], name: str = "measure", value: str = "value") -> DataFrame:
    return df.unpivot(keys, columns, name, value)


def decode_name(c: Column) -> dict[str, Column]:
    """Side, whether a rank, and base name of a column named <base>[_rank][_off|_def]."""
    side = F.when(c.endswith("_off"), "off").when(c.endswith("_def"), "def")
    bare = F.regexp_replace(c, "_(off|def)$", "")
    return {"side": side, "is_rank": F.contains(bare, F.lit("_rank")), "base": F.regexp_replace(bare, "_rank", "")}


def alias_absent(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rename source columns to canonical names, only where the canonical one is absent."""
    have = set(df.columns)
    return df.withColumnsRenamed({old: new for old, new in names.items() if old in have and new not in have})


def with_absent(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add missing columns as typed NULLs."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns})


def conform(df: DataFrame, order: list[str], drop: tuple[str, ...] = ()) -> DataFrame:
    """Listed columns first, unknown ones after them, dropped ones gone (a tier is its drop list)."""
    have = [c for c in df.columns if c not in drop]
    return df.select(*[f"`{c}`" for c in order if c in have], *[f"`{c}`" for c in have if c not in order])


def suffix_others(df: DataFrame, keys: list[str], suffix: str) -> DataFrame:
    return df.withColumnsRenamed({c: f"{c}{suffix}" for c in df.columns if c not in keys})


def rank_last(df: DataFrame) -> DataFrame:
    """``x_rank_off`` becomes ``x_off_rank``."""
    return df.withColumnsRenamed({c: re.sub(r"_rank_(off|def)$", r"_\1_rank", c) for c in df.columns})


def join_suffixed(left: DataFrame, right: DataFrame, on: list[str], suffix: str) -> DataFrame:
    """Left join; only clashing names of the right side get the suffix."""
    clash = {c: f"{c}{suffix}" for c in right.columns if c in left.columns and c not in on}
    return left.join(right.withColumnsRenamed(clash), on, "left")


def diff_collapse(df: DataFrame, features: list[str], keep: list[str]) -> DataFrame:
    return df.select(*keep, *[(F.col(f"{f}_home") - F.col(f"{f}_away")).alias(f"{f}_diff") for f in features])


def numeric_features(df: DataFrame, keys: list[str]) -> list[str]:
    """Numeric columns that are neither keys nor ranks."""
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in keys and "_rank" not in f.name]


_WIDTH = {t: i for i, t in enumerate(["tinyint", "smallint", "int", "bigint", "float", "double"])}


def wider(a: str, b: str) -> str:
    """Common type of two columns: numbers widen, anything else that differs becomes text."""
    if a == b:
        return a
    if "void" in (a, b):
        return b if a == "void" else a
    if a in _WIDTH and b in _WIDTH:
        return max(a, b, key=_WIDTH.__getitem__)
    return "string"


def diagonal_union(frames: list[DataFrame]) -> DataFrame:
    """Union by name: missing columns are NULL, types are widened first (a late cast would fail at run time)."""
    types: dict[str, str] = {}
    for f in frames:
        for name, kind in f.dtypes:
            types[name] = wider(types[name], kind) if name in types else kind
    cast = lambda f: f.select(*[(F.to_json(F.col(f"`{n}`")) if k.startswith(("array", "struct", "map")) and types[n] == "string" else F.col(f"`{n}`").cast(types[n])).alias(n) for n, k in f.dtypes])
    out = cast(frames[0])
    for f in frames[1:]:
        out = out.unionByName(cast(f), allowMissingColumns=True)
    return out


def long_sides(games: DataFrame, shared: list[str], sides: dict[str, dict[str, str]]) -> DataFrame:
    """Home and away as two rows from one scan; sides: label -> {output column: input column}."""
    each = F.array(*[F.struct(F.lit(label).alias("side"), *[F.col(src).alias(dst) for dst, src in cols.items()]) for label, cols in sides.items()])
    return games.select(*shared, F.inline(each))


def scaled_within(rows: DataFrame, keys: list[str], value: str, out: str, inverted: bool = False) -> DataFrame:
    """Min-max scale of a column within its group; the bounds are aggregates joined back, so that no group has to fit a task."""
    bounds = rows.groupBy(*keys).agg(F.min(value).alias("__lo"), F.max(value).alias("__hi"))
    return join_back(rows, bounds, keys).withColumn(out, scaled_between(value, "__lo", "__hi", inverted)).drop("__lo", "__hi")

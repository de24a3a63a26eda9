"""Data-quality gates: one aggregate each, then an error that names what is wrong."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class GateError(AssertionError):
    """A gate did not hold."""


def require(ok: bool, message: str) -> None:
    if not ok:
        raise GateError(message)


def adjustment_report(df: DataFrame, pairs: dict[str, str]) -> dict[str, float | None]:
    """Correlation of each adjusted column with its raw one."""
    r = df.agg(F.count(F.lit(1)).alias("n"), *[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(a) for a, b in pairs.items()]).first()
    return {"rows": r["n"], **{a: r[a] for a in pairs}}


def assert_adjusted(df: DataFrame, pairs: dict[str, str], limit: float = 0.95, least_rows: int = 50) -> dict:
    """An adjustment that correlates almost perfectly with its input did nothing."""
    r = adjustment_report(df, pairs)
    if r["rows"] >= least_rows:
        for a in pairs:
            require(r[a] is None or r[a] <= limit, f"{a}: correlation {r[a]} with its raw column; the adjustment is a no-op")
    return r


def assert_spread(df: DataFrame, column: str, least_sd: float, low: float | None = None, high: float | None = None) -> None:
    """Rows, values and a real spread; optionally a mean within bounds."""
    r = df.agg(F.count(F.lit(1)).alias("n"), F.count(column).alias("v"), F.stddev_samp(column).alias("sd"), F.avg(column).alias("m")).first()
    require(r["n"] > 0, f"{column}: no rows")
    require(r["v"] > 0, f"{column}: only NULL")
    require(r["sd"] is not None and r["sd"] >= least_sd, f"{column}: standard deviation {r['sd']} below {least_sd}")
    require((low is None or r["m"] >= low) and (high is None or r["m"] <= high), f"{column}: mean {r['m']} out of bounds")


def assert_identity(df: DataFrame, whole: Column, parts: Column, rel: float = 1e-6) -> None:
    """whole = parts within a relative tolerance, on every row where both are known."""
    bad = F.abs(whole - parts) > F.lit(rel) * F.greatest(F.lit(1.0), F.abs(whole))
    n = df.agg(F.count_if(F.coalesce(bad, F.lit(False)))).first()[0]
    require(n == 0, f"{n} rows break the identity")


def assert_finite(df: DataFrame, columns: list[str]) -> None:
    r = df.agg(*[F.count_if(F.isnan(F.col(c).cast("double")) | (F.abs(F.col(c).cast("double")) == float("inf"))).alias(c) for c in columns]).first()
    bad = {c: r[c] for c in columns if r[c]}
    require(not bad, f"values that are no numbers: {bad}")


def assert_arms_differ(df: DataFrame, a: list[str], b: list[str]) -> None:
    """Feature arms must differ, and their extra columns must carry values that vary."""
    require(set(a) != set(b), "both arms have the same features")
    extra = sorted(set(a) ^ set(b))
    r = df.agg(*[F.count_distinct(c).alias(c) for c in extra]).first()
    dull = [c for c in extra if r[c] < 2]
    require(not dull, f"constant or empty features: {dull}")


def assert_columns(df: DataFrame, columns: list[str]) -> None:
    absent = [c for c in columns if c not in df.columns]
    require(not absent, f"columns missing: {absent}")


def assert_rows(df: DataFrame, what: str) -> DataFrame:
    require(not df.isEmpty(), f"{what}: no rows")
    return df


def missing_weeks(built: DataFrame, expected: DataFrame, keys: list[str]) -> DataFrame:
    return expected.select(*keys).distinct().join(built.select(*keys).distinct(), keys, "left_anti")


def kept_and_dropped(df: DataFrame, required: list[str]) -> tuple[DataFrame, dict[str, int]]:
    """Rows with all required columns, and how many were kept and dropped (one pass)."""
    whole = F.lit(True)
    for c in required:
        whole = whole & F.col(c).isNotNull()
    r = df.agg(F.count_if(whole).alias("kept"), F.count_if(~whole).alias("dropped")).first()
    return df.where(whole), r.asDict()

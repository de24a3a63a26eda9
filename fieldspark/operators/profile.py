"""Column-level quality profile per load, and what changed between loads.

The columns are aggregated where they are read, a few at a time (each scan reads its own columns): per load counts,
ranges, violations and exact power sums of the numbers (orders 0 to 2). The sums are kept in parts of 16 bits per scan
task and then as decimals, so partial sums merge in any order to the same digits and nothing near-unique is shuffled.
Distinct values are counted in a second pass, by 96 bits of hash (a count of n is short by one with a chance of about
n^2 / 2^97). Shifts between loads are standardised differences of the means.

Defined results
- NULL is counted as a null; empty text is a value that violates the pattern.
- text is *readable* if, blanks at the ends aside, it is a whole number of at most 38 digits, optionally signed or with zero decimals.
- DOUBLE, FLOAT and DECIMAL values are numbers in billionths (rounded to the ninth decimal); NaN, the infinities and
  numbers from 10^29 on are violations. Whole numbers and booleans (0 and 1) are exact.
- times have a range (microseconds), but no sums. Other types are profiled as their text. Text with a pattern of its own is not read as numbers.
- no number: no range, no mean, no constant, no shift. A first load, or one whose number
  minus one does not occur, has no shift.
- empty table: no rows. Repeated rows count each. NULL load numbers form a load of their own without neighbours.
"""

from __future__ import annotations

from fractions import Fraction
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldspark.functions.exprs import safe_div
from fieldspark.operators.prefix import running
from fieldspark.session import broadcast_if_small, cut

READABLE = r"^[+-]?[0-9]+(\.0+)?$"
PART = 10**9
#: Decimals of the units in which DOUBLE, FLOAT and DECIMAL values are summed.
DECIMALS = 9
#: Columns aggregated by one scan; generated code for many more grows beyond what the JVM compiles.
COLUMNS_PER_SCAN = 4


def readable(value: Column) -> Column:
    """DECIMAL(38,0) of a readable value, else NULL."""
    s = F.regexp_replace(value, r"^[\s\x{00A0}\x{2000}-\x{200B}\x{3000}\x{FEFF}]+|[\s\x{00A0}\x{2000}-\x{200B}\x{3000}\x{FEFF}]+$", "")
    return F.when(s.rlike(READABLE), F.regexp_replace(F.regexp_replace(s, r"\.0+$", ""), r"^\+", "").try_cast("decimal(38,0)"))


# ------------------------------------------------------------------ one value
def _family(kind: T.DataType) -> str:
    if isinstance(kind, (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "whole"
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return "time"
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return "double"
    return "decimal" if isinstance(kind, T.DecimalType) else "text"


def _decimals(df: DataFrame, columns: list[str]) -> list[int]:
    return [DECIMALS if _family(df.schema[c].dataType) in ("double", "decimal") else 0 for c in columns]


def unpivoted(df: DataFrame, load: str, columns: list[str]) -> DataFrame:
    """load, ci (place in ``columns``), family, and the value as l (whole numbers, times), d (DOUBLE) or s (text, DECIMAL)."""
    each = []
    for i, c in enumerate(columns):
        family, x = _family(df.schema[c].dataType), F.col(f"`{c}`")
        boolean = isinstance(df.schema[c].dataType, T.BooleanType)
        whole = F.unix_micros(x.cast("timestamp")) if family == "time" else (x.cast("int") if boolean else x).cast("bigint") if family == "whole" else F.lit(None).cast("bigint")
        each.append(
            F.struct(
                F.lit(i).alias("ci"), F.lit(family).alias("family"), whole.alias("l"),
                ((x + F.lit(0.0)).cast("double") if family == "double" else F.lit(None).cast("double")).alias("d"),  # one zero
                (x.cast("string") if family in ("text", "decimal") else F.lit(None).cast("string")).alias("s"),
            )
        )
    return df.select(F.col(load).alias("load"), F.inline(F.array(*each)))


def _numbers(family: str, l: Column, d: Column, s: Column) -> tuple[Column, Column, Column]:
    """Of one value: units as BIGINT, units as DECIMAL(38,0) where they need more than 18 digits, the value as DOUBLE."""
    top, wide = F.lit(PART * PART), F.lit(None).cast("decimal(38,0)")
    scale = F.lit(float(PART))
    if family == "whole":
        small = l.between(1 - PART * PART, PART * PART - 1)
        return F.when(small, l), F.when(~small, l.cast("decimal(38,0)")), l.cast("double")
    if family == "time":
        return F.lit(None).cast("bigint"), wide, l.cast("double")
    if family in ("double", "decimal"):
        exact = (d if family == "double" else s).try_cast(f"decimal(38,{DECIMALS})")
        units = F.replace(exact.cast("string"), F.lit("."), F.lit("")).try_cast("decimal(38,0)")
        if family == "double":
            near = F.abs(d) < float(PART)
            return F.when(near, F.round(d * scale).try_cast("bigint")), F.when(~near & ~F.isnan(d), units), F.when(F.abs(d) < 1e29, d)
        small = F.abs(units) < top
        return F.when(small, units.try_cast("bigint")), F.when(~small, units), exact.cast("double")
    plain = s.rlike("^-?[0-9]{1,18}$")
    number = F.when(s.rlike("[0-9]"), readable(s))
    small = F.abs(number) < top
    u = F.when(plain, s.try_cast("bigint")).otherwise(F.when(small, number.try_cast("bigint")))
    w = F.when(s.rlike("[0-9]{19}"), F.when(~small, number))
    return u, w, F.coalesce(u.cast("double"), w.cast("double"))


def numbered(long: DataFrame, families: set[str]) -> DataFrame:
    """Adds u and w (see ``_numbers``) to unpivoted values of these families."""
    pick = {f: _numbers(f, F.col("l"), F.col("d"), F.col("s")) for f in sorted(families)}
    one = lambda k, kind: F.coalesce(*[F.when(F.col("family") == f, n[k]) for f, n in pick.items()]) if pick else F.lit(None).cast(kind)
    return long.withColumns({"u": one(0, "bigint"), "w": one(1, "decimal(38,0)")})


def _sums(u: Column, limbs: int) -> tuple[list[Column], list[Column]]:
    """A BIGINT in base 2^16 (least part first, the last with the sign), and its square's coefficients, all below 2^35."""
    parts = [F.shiftright(u, 16 * i) if i == limbs - 1 else F.shiftright(u, 16 * i).bitwiseAND(F.lit(0xFFFF)) for i in range(limbs)]
    squares = []
    for k in range(2 * limbs - 1):
        same = [parts[k // 2] * parts[k // 2]] if k % 2 == 0 else []
        mixed = [parts[i] * parts[k - i] * 2 for i in range(limbs) if i < k - i < limbs]
        squares.append(sum(same + mixed[1:], mixed[0]) if mixed and not same else sum(mixed, same[0]))
    return parts, squares


def _limbs(x: Column) -> tuple[list[Column], list[Column]]:
    """A whole number in base 10^9 (least part first, with its sign), and its square's coefficients: no part exceeds a BIGINT."""
    digits = F.lpad(F.abs(x).cast("string"), 45, "0")
    parts = [digits.substr(1 + 9 * (4 - i), 9).cast("bigint") for i in range(5)]
    squares = [sum((parts[i] * parts[k - i] for i in range(5) if 0 <= k - i < 5), F.lit(0)) for k in range(9)]
    return [F.when(x < 0, -p).otherwise(p) for p in parts], squares


def _total(c: Column) -> Column:
    return F.sum(c.cast("decimal(19,0)"))


def _joined(values, base: int) -> int:
    return sum(int(v or 0) * base**i for i, v in enumerate(values or []))


def _moments(n, parts, squares, wide_parts, wide_squares, decimals):
    """(s1, s2 in units as text, s1, s2, mean, sd) from the sums of the parts, in whole numbers of any size."""
    if not n:
        return None
    s1, s2 = _joined(parts, 1 << 16) + _joined(wide_parts, PART), _joined(squares, 1 << 16) + _joined(wide_squares, PART)
    unit = 10**decimals
    return str(s1), str(s2), s1 / unit, s2 / unit**2, s1 / (n * unit), (max(n * s2 - s1 * s1, 0) / (n * unit) ** 2) ** 0.5


def _scan(df: DataFrame, load: str, columns: list[str], chosen: list[int], patterns: dict[str, str], ranges: dict[str, tuple[int, int]]) -> DataFrame:
    """Per load, scan task and chosen column: counts, range and sums that fit a BIGINT (a task reads less than 2^28 rows of a load)."""
    values, aggs, out = [], [F.count(F.lit(1)).alias("rows")], []
    for i in chosen:
        c = columns[i]
        kind, x = df.schema[c].dataType, F.col(f"`{c}`")
        family, boolean = _family(kind), isinstance(kind, T.BooleanType)
        whole = F.unix_micros(x.cast("timestamp")) if family == "time" else (x.cast("int") if boolean else x).cast("bigint") if family == "whole" else x
        read = family != "text" or c not in patterns
        u, w, v = _numbers(family, whole, x, x.cast("string")) if read else (F.lit(None).cast("bigint"), F.lit(None).cast("decimal(38,0)"), F.lit(None).cast("double"))
        fits = x.cast("string").rlike(patterns[c]) if c in patterns else v.isNotNull()
        values += [x.isNotNull().alias(f"p{i}"), (x.isNotNull() & ~F.coalesce(fits, F.lit(False))).alias(f"b{i}"), v.alias(f"v{i}"), u.alias(f"u{i}"), w.alias(f"w{i}")]
        limbs = 2 if isinstance(kind, (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType)) else 4
        parts, squares = _sums(F.col(f"u{i}"), limbs) if read and family != "time" else ([], [])
        outside = F.count_if(~F.col(f"v{i}").between(*ranges[c])) if c in ranges else F.lit(0).cast("bigint")
        aggs += [F.count_if(f"p{i}").alias(f"p{i}"), F.count_if(f"b{i}").alias(f"b{i}"), outside.alias(f"o{i}"), F.min(f"v{i}").alias(f"lo{i}"), F.max(f"v{i}").alias(f"hi{i}")]
        aggs += [F.count(f"u{i}").alias(f"n{i}"), F.count(f"w{i}").alias(f"m{i}"), *[F.sum(p).alias(f"s{i}_{k}") for k, p in enumerate(parts)], *[F.sum(q).alias(f"q{i}_{k}") for k, q in enumerate(squares)]]
        padded = lambda letter, have, want: F.array(*[(F.col(f"{letter}{i}_{k}") if k < have else F.lit(None)).cast("bigint") for k in range(want)])  # noqa: B023, E731
        out.append(
            F.struct(
                F.lit(i).alias("ci"), (F.col("rows") - F.col(f"p{i}")).alias("nulls"), F.col(f"b{i}").alias("violations"), F.col(f"o{i}").alias("outside"), F.col(f"lo{i}").alias("low"), F.col(f"hi{i}").alias("high"),
                F.col(f"n{i}").alias("n_u"), F.col(f"m{i}").alias("n_w"), padded("s", len(parts), 4).alias("parts"), padded("q", len(squares), 7).alias("squares"),
            )
        )
    per_task = df.select(F.col(load).alias("load"), F.spark_partition_id().alias("task"), *values).groupBy("load", "task").agg(*aggs)
    return per_task.select("load", "rows", F.inline(F.array(*out)))


def column_stats(df: DataFrame, load: str, columns: list[str], patterns: dict[str, str] | None = None, ranges: dict[str, tuple[int, int]] | None = None) -> DataFrame:
    """load, col, rows, nulls, violations, outside, low, high, s0, exact power sums, mean, sd: one row per load and column, written down."""
    decimals = _decimals(df, columns)
    patterns, ranges = patterns or {}, ranges or {}
    scans = [_scan(df, load, columns, list(range(a, min(a + COLUMNS_PER_SCAN, len(columns)))), patterns, ranges) for a in range(0, len(columns), COLUMNS_PER_SCAN)]
    tasks = reduce(DataFrame.unionByName, scans)
    total = lambda c, n: F.array(*[_total(F.get(c, k)) for k in range(n)]).alias(c)
    stats = tasks.groupBy("load", "ci").agg(
        *[F.sum(c).alias(c) for c in ("rows", "nulls", "violations", "outside", "n_u", "n_w")], F.min("low").alias("low"), F.max("high").alias("high"), total("parts", 4), total("squares", 7)
    )
    stats = cut(stats)
    if stats.where("n_w > 0").isEmpty():
        stats = stats.withColumns({"wide_parts": F.lit(None).cast("array<decimal(29,0)>"), "wide_squares": F.lit(None).cast("array<decimal(29,0)>")})
    else:  # numbers of 19 digits and more
        parts, squares = _limbs(F.col("w"))
        numeric = [c for c in columns if c not in patterns or _family(df.schema[c].dataType) != "text"]
        large = numbered(unpivoted(df, load, numeric), {_family(df.schema[c].dataType) for c in numeric}).where("w is not null")
        large = large.withColumn("ci", F.get(F.array(*[F.lit(columns.index(c)) for c in numeric]), F.col("ci")))
        more = large.groupBy("load", "ci").agg(F.array(*map(_total, parts)).alias("wide_parts"), F.array(*map(_total, squares)).alias("wide_squares"))
        wide = more.select(F.col("load").alias("l"), F.col("ci").alias("c"), "wide_parts", "wide_squares")
        stats = stats.join(wide, F.col("load").eqNullSafe(F.col("l")) & (F.col("ci") == F.col("c")), "left").drop("l", "c")
    names, scales = F.array(*[F.lit(c) for c in columns]), F.array(*[F.lit(d) for d in decimals])
    moments = F.udf(_moments, "s1_units string, s2_units string, s1 double, s2 double, mean double, sd double")
    named = stats.select("*", F.get(names, F.col("ci")).alias("col"), F.get(scales, F.col("ci")).alias("decimals"), (F.col("n_u") + F.col("n_w")).alias("s0"))
    out = named.withColumn("m", moments("s0", "parts", "squares", "wide_parts", "wide_squares", "decimals"))
    return cut(out.select("load", "col", "ci", "decimals", "rows", "nulls", "violations", "outside", "low", "high", "s0", "m.*"))


def distinct_counts(df: DataFrame, load: str, columns: list[str]) -> DataFrame:
    """load, ci, distinct_values of the non-NULL values."""
    long = unpivoted(df, load, columns).where("l is not null or d is not null or s is not null")
    tag = F.shiftleft(F.col("ci").cast("bigint"), 32) + F.hash("l", "d", "s").cast("bigint") + F.lit(1 << 31)
    values = long.select("load", tag.alias("tag"), F.xxhash64("l", "d", "s").alias("h")).groupBy("load", "tag", "h").agg(F.lit(1).alias("one"))
    return values.groupBy("load", F.shiftright("tag", 32).cast("int").alias("ci")).agg(F.count(F.lit(1)).alias("distinct_values"))


def _with_prior(stats: DataFrame, *columns: str) -> DataFrame:
    """Adds ``<column>_p`` of the load numbered one lower."""
    prior = stats.select((F.col("load") + 1).alias("load"), "col", *[F.col(c).alias(f"{c}_p") for c in columns])
    return stats.join(prior, ["load", "col"], "left")


def column_profile(df: DataFrame, load: str, columns: list[str], patterns: dict[str, str] | None = None) -> DataFrame:
    """One row per load and column: nulls, distinct values, violations, range, exact sums, change to the load before.

    ``patterns``: a regular expression a column's values must match; default: being a number.
    """
    stats = column_stats(df, load, columns, patterns)
    n = distinct_counts(df, load, columns).select(F.col("load").alias("l"), F.col("ci").alias("c"), "distinct_values")
    both = _with_prior(stats, "mean", "sd", "nulls", "rows").join(n, F.col("load").eqNullSafe(F.col("l")) & (F.col("ci") == F.col("c")), "left")
    pooled = F.sqrt((F.col("sd") * F.col("sd") + F.col("sd_p") * F.col("sd_p")) / 2)
    return both.select(
        "load", "col", "rows", "nulls", F.coalesce("distinct_values", F.lit(0)).alias("distinct_values"), "violations", "low", "high", "decimals", "s0", "s1_units", "s2_units", "s1", "s2", "mean", "sd",
        safe_div(F.col("mean") - F.col("mean_p"), pooled).alias("std_diff"),
        (safe_div("nulls", "rows") - safe_div("nulls_p", "rows_p")).alias("null_rate_diff"),
    )


def _surely_moved(limit: str):
    """Whether the power sums alone prove that cumulative shares differ by more than the limit.

    The area between two distribution functions is at least the difference of the means; it is at most the largest
    difference of the functions times the range that both cover.
    """
    share = Fraction(limit)

    def proves(n, s1, n_p, s1_p, low, high, low_p, high_p, decimals):
        if not n or not n_p:
            return False
        reach = Fraction(max(high, high_p)) - Fraction(min(low, low_p))
        reach = (reach * Fraction(1_000_000_001, 1_000_000_000)) * 10**decimals  # low and high are DOUBLE
        return abs(Fraction(int(s1), n) - Fraction(int(s1_p), n_p)) > share * reach and reach > 0

    return F.udf(proves, "boolean")


def shifted(df: DataFrame, load: str, columns: list[str], stats: DataFrame, limit: float) -> DataFrame:
    """load, col of the pairs whose cumulative shares differ from the load before by more than ``limit`` at some number.

    Power sums prove most shifts; what they leave open is compared exactly, by counts per number.
    """
    near = _with_prior(stats, "s0", "s1_units", "low", "high").where("s0 > 0 and s0_p > 0")
    judged = cut(near.select("load", "col", "ci", _surely_moved(str(limit))("s0", "s1_units", "s0_p", "s1_units_p", "low", "high", "low_p", "high_p", "decimals").alias("sure")))
    open_pairs = judged.where("not sure").select("load", "ci")
    needed = broadcast_if_small(open_pairs.unionByName(open_pairs.withColumn("load", F.col("load") - 1)).distinct())
    # counts per value as written, then per number: a spelling is read once per load
    written = unpivoted(df, load, columns).join(needed, ["load", "ci"], "left_semi").groupBy("load", "ci", "family", "l", "d", "s").agg(F.count(F.lit(1)).alias("n"))
    x = F.coalesce(F.col("u").cast("decimal(38,0)"), F.col("w"))
    read = numbered(written, {_family(df.schema[c].dataType) for c in columns}).where("u is not null or w is not null")
    numbers = cut(read.groupBy("load", "ci", x.alias("x")).agg(F.sum("n").alias("n")))
    zero = F.lit(0).cast("bigint")
    sides = numbers.select("load", "ci", "x", F.col("n").alias("own"), zero.alias("prior")).unionByName(numbers.select((F.col("load") + 1).alias("load"), "ci", "x", zero.alias("own"), F.col("n").alias("prior")))
    merged = cut(sides.join(broadcast_if_small(open_pairs), ["load", "ci"], "left_semi").groupBy("load", "ci", "x").agg(F.sum("own").alias("own"), F.sum("prior").alias("prior")))
    totals = merged.groupBy("load", "ci").agg(F.sum("own").alias("na"), F.sum("prior").alias("nb"))
    upto = running(merged, ["load", "ci"], ["x"], sums={"a": "own", "b": "prior"}).join(totals, ["load", "ci"])
    dec = lambda c: F.col(c).cast("decimal(19,0)")
    gap = F.abs(dec("a") * dec("nb") - dec("b") * dec("na"))
    beyond = upto.where((gap > dec("na") * dec("nb") * F.lit(str(limit)).cast("decimal(6,4)")) & (F.col("na") > 0) & (F.col("nb") > 0))
    names = F.array(*[F.lit(c) for c in columns])
    exact = beyond.select("load", "ci").distinct().select("load", F.get(names, F.col("ci")).alias("col"))
    return judged.where("sure").select("load", "col").unionByName(exact)


def load_issues(df: DataFrame, load: str, ranges: dict[str, tuple[int, int]], null_pct=30, pattern_pct=3, range_pct=2, shift=0.25) -> DataFrame:
    """load, col, issue: load-column pairs beyond the limits (nulls, pattern, range, constant, shift), from the profile.

    All comparisons are between whole numbers or exact decimals, so limits are met exactly. ``constant`` is a variance of
    exactly 0 by the power sums.
    """
    columns = list(ranges)
    stats = column_stats(df, load, columns, ranges=ranges)
    moved = shifted(df, load, columns, stats, shift).withColumn("moved", F.lit(True))
    pct = lambda part, limit: F.col(part) * 100 > F.col("rows") * limit
    checks = {
        "nulls": pct("nulls", null_pct),
        "pattern": pct("violations", pattern_pct),
        "range": pct("outside", range_pct),
        "constant": (F.col("s0") > 0) & (F.col("sd") == 0),
        "shift": F.coalesce("moved", F.lit(False)),
    }
    found = F.filter(F.array(*[F.when(c, F.lit(k)) for k, c in checks.items()]), lambda i: i.isNotNull())
    return stats.join(moved, ["load", "col"], "left").select("load", "col", F.explode(found).alias("issue"))

"""Column expressions with one defined meaning for nulls, NaN, ties and bad input.

Everything here is a JVM-side expression; nothing crosses into Python per row.
"""

from __future__ import annotations

import builtins

from pyspark.sql import Column, Window
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- arithmetic
def safe_div(a, b) -> Column:
    """a / b, NULL where b is 0 or either side is NULL."""
    return F.try_divide(col(a).cast("double"), col(b).cast("double"))


def sum0(c) -> Column:
    """Sum that is 0 over no or only NULL values."""
    return F.coalesce(F.sum(col(c)), F.lit(0))


def n_unique_null(c) -> Column:
    """Distinct count in which NULL is one more value."""
    return F.count_distinct(col(c)) + F.max(F.when(col(c).isNull(), 1).otherwise(0))


def clip_null(c, low=None, high=None) -> Column:
    """Clip to [low, high]; NULL stays NULL (greatest/least alone would drop it)."""
    out = col(c)
    if low is not None:
        out = F.greatest(out, F.lit(low))
    if high is not None:
        out = F.least(out, F.lit(high))
    return F.when(col(c).isNotNull(), out)


def finite(c) -> Column:
    """NaN and the infinities become NULL."""
    x = col(c)
    return F.when(~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))), x)


def translate(c, in_low, in_high, out_low, out_high) -> Column:
    """Clamp to the input range, then map it linearly onto the output range."""
    x = clip_null(c, in_low, in_high)
    return F.lit(out_low) + (x - F.lit(in_low)) / F.lit(in_high - in_low) * F.lit(out_high - out_low)


def minmax(c, w, inverted: bool = False) -> Column:
    """Min-max scale inside a window; a constant column scales to 1."""
    lo, hi = F.min(col(c)).over(w), F.max(col(c)).over(w)
    scaled = (hi - col(c) if inverted else col(c) - lo) / F.nullif(hi - lo, F.lit(0.0))
    return F.when(col(c).isNotNull(), F.coalesce(scaled, F.lit(1.0)))


def scaled_between(c, lo, hi, inverted: bool = False) -> Column:
    """Min-max scale between known bounds; equal bounds scale to 1."""
    x = (col(hi) - col(c) if inverted else col(c) - col(lo)) / F.nullif(col(hi) - col(lo), F.lit(0.0))
    return F.when(col(c).isNotNull(), F.coalesce(x, F.lit(1.0)))


def logistic(c) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-col(c)))


def logit(c) -> Column:
    return F.ln(F.try_divide(col(c), F.lit(1.0) - col(c)))


def norm_cdf(c) -> Column:
    """Standard normal distribution function, JVM-side.

    Spark has no erf; erfc comes from a rational Chebyshev fit (relative error below 1.2e-7).
    """
    x = col(c).cast("double")
    z = F.abs(x) / F.lit(2.0**0.5)
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(0.5) * z)
    # Coefficients of the published fit, constant term first.
    coef = [-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277]
    poly = F.lit(0.0)
    for k in reversed(coef[1:]):
        poly = (poly + F.lit(k)) * t
    erfc = t * F.exp(-z * z + F.lit(coef[0]) + poly)
    return F.when(x.isNotNull(), F.when(x >= 0, F.lit(1.0) - erfc / 2).otherwise(erfc / 2))


def norm_pdf(c) -> Column:
    x = col(c).cast("double")
    return F.exp(-x * x / 2) / F.lit((2 * 3.141592653589793) ** 0.5)


def american_prob(c) -> Column:
    """Implied probability of American odds; NULL for 0, NULL, NaN and infinities."""
    o = finite(col(c).cast("double"))
    return F.when(o < 0, -o / (-o + 100)).when(o > 0, F.lit(100.0) / (o + 100))


def lookup(values: list[float], c) -> Column:
    """Element of a fixed curve at the clamped index; NULL index gives NULL."""
    i = clip_null(col(c).cast("int"), 0, len(values) - 1)
    return F.when(i.isNotNull(), F.get(F.array(*[F.lit(float(v)) for v in values]), i))


# The last seasons of the first three rule eras.
ERAS = (2006, 2013, 2020)


def era(season, bounds: tuple[int, ...] = ERAS) -> Column:
    """Ordinal era of a season, from 0; a NULL season is of the last era."""
    out = F.lit(len(bounds))
    for i, last in reversed(list(enumerate(bounds))):
        out = F.when(col(season) <= last, i).otherwise(out)
    return out


def era_dummies(season, bounds: tuple[int, ...] = ERAS) -> list[Column]:
    """0/1 columns era0, era1, ...; all NULL for a NULL season."""
    e = F.when(col(season).isNotNull(), era(season, bounds))
    return [(e == i).cast("int").alias(f"era{i}") for i in range(len(bounds) + 1)]


# ---------------------------------------------------------------- order and rank
def avg_rank(c, by: list, tie: list, ascending: bool = True, partition: list | None = None) -> Column:
    """Average-tie rank, NULL last.

    Equal values share the mean of their places; NULLs get the places after all values,
    one each, in the order of ``tie``. ``by`` is unused for values (they tie).
    """
    part = list(partition or [])
    x = col(c)
    order = x.asc_nulls_last() if ascending else x.desc_nulls_last()
    w = Window.partitionBy(*part)
    same = Window.partitionBy(*part, x)
    value_rank = F.rank().over(w.orderBy(order)) + (F.count(F.lit(1)).over(same) - 1) / 2
    null_rank = F.row_number().over(w.orderBy(order, *[col(t) for t in [*by, *tie]]))
    return F.when(x.isNotNull(), value_rank.cast("double")).otherwise(null_rank.cast("double"))


def back_fill(c, partition: list, order: list) -> Column:
    """Next non-NULL value at or after the row."""
    w = Window.partitionBy(*partition).orderBy(*order).rowsBetween(0, Window.unboundedFollowing)
    return F.first(col(c), ignorenulls=True).over(w)


def first_by(value, *order) -> Column:
    """Value of the row that comes first by a total order (not by arrival)."""
    return F.min_by(col(value), F.struct(*[col(o) for o in order]))


def last_by(value, *order) -> Column:
    return F.max_by(col(value), F.struct(*[col(o) for o in order]))


# ---------------------------------------------------------------- text
def squash_key(c) -> Column:
    """Matching key: lower case, letters and digits only; NULL where nothing is left."""
    k = F.nullif(F.regexp_replace(F.lower(col(c)), r"[^\p{L}\p{N}]+", ""), F.lit(""))
    return F.when(col(c).rlike("^[A-Za-z0-9]+$"), F.lower(col(c))).otherwise(k)


def plain_text(c) -> Column:
    """Every kind of space becomes a blank, every minus sign a hyphen-minus; ends trimmed."""
    s = F.regexp_replace(col(c), r"[\s  -​ 　﻿]+", " ")
    spaced = F.trim(F.regexp_replace(s, "−", "-"))
    return F.when(col(c).rlike("^[0-9A-Za-z.:,%()/+-]*$"), col(c)).otherwise(spaced)


def whole_number(c) -> Column:
    """BIGINT of text that reads as a whole number (sign and zero decimals allowed), else NULL."""
    s = F.trim(F.regexp_replace(col(c).cast("string"), r"[\s ]+", " "))
    ok = s.rlike(r"^[+-]?[0-9]+(\.0+)?$")
    return F.when(ok, F.regexp_replace(F.regexp_replace(s, r"\.0+$", ""), r"^\+", "").try_cast("bigint"))


def coalesce_all(cols: builtins.list) -> Column:
    return F.coalesce(*[col(c) for c in cols])

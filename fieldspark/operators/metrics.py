"""Evaluation metrics as aggregates: one pass over the predictions each."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldspark.functions.exprs import norm_cdf, norm_pdf, safe_div

_EPS = 1e-15


def binary(df: DataFrame, p: str, y: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Log loss, Brier score and counts."""
    q = F.least(F.greatest(F.col(p), F.lit(_EPS)), F.lit(1 - _EPS))
    t = F.col(y).cast("double")
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.avg(-(t * F.ln(q) + (1 - t) * F.ln(1 - q))).alias("log_loss"), F.avg((F.col(p) - t) * (F.col(p) - t)).alias("brier"))


def auc(df: DataFrame, score: str, y: str) -> DataFrame:
    """Area under the ROC curve; ties count half. Scores are pre-counted, so equal scores meet as one row.

    The running count runs over buckets of scores, so no task holds all distinct scores.
    """
    t = F.col(y).cast("bigint")
    s = df.where(F.col(score).isNotNull() & F.col(y).isNotNull()).groupBy(score).agg(F.sum(t).alias("pos"), F.sum(1 - t).alias("neg"))
    lo, hi = s.agg(F.min(score), F.max(score)).first()
    width = max(float((hi or 0) - (lo or 0)), 1e-12)
    s = s.withColumn("b", F.least(F.floor((F.col(score) - F.lit(float(lo or 0))) / F.lit(width) * 256), F.lit(255)))
    per = s.groupBy("b").agg(F.sum("neg").alias("k"))
    below = per.select("b", F.coalesce(F.sum("k").over(Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    w = Window.partitionBy("b").orderBy(score).rowsBetween(Window.unboundedPreceding, -1)
    j = s.join(below, "b").withColumn("under", F.col("before") + F.coalesce(F.sum("neg").over(w), F.lit(0)))
    return j.agg(F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"), safe_div(F.sum(F.col("pos") * (F.col("under") + F.col("neg") / 2)), F.sum("pos").cast("double") * F.sum("neg")).alias("auc"))


def margins(df: DataFrame, pred: str, actual: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Error, bias, regression of actual on predicted, spread of the residuals."""
    e = F.col(actual) - F.col(pred)
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(e).alias("bias"), F.corr(pred, actual).alias("corr"),
        F.regr_slope(actual, pred).alias("slope"), F.regr_intercept(actual, pred).alias("intercept"), F.stddev_pop(e).alias("resid_sd"), F.regr_r2(actual, pred).alias("r2"),
    )


def calibration(df: DataFrame, p: str, y: str, bins: int = 20, by: tuple[str, ...] = ()) -> DataFrame:
    """Equal-width bins, the last one closed: predicted and actual rate."""
    b = F.least(F.floor(F.col(p) * bins), F.lit(bins - 1))
    return df.groupBy(*by, b.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.avg(p).alias("predicted"), F.avg(F.col(y).cast("double")).alias("actual"))


def calibration_error(bins: DataFrame, by: tuple[str, ...] = (), least: int = 1) -> DataFrame:
    """Mean (by rows) and largest distance of predicted and actual rate over bins of enough rows."""
    d = F.abs(F.col("predicted") - F.col("actual"))
    return bins.where(F.col("n") >= least).groupBy(*by).agg(safe_div(F.sum(d * F.col("n")), F.sum("n")).alias("mean_error"), F.max(d).alias("max_error"))


def quantile_bins(df: DataFrame, p: str, y: str, bins: int = 10) -> DataFrame:
    """Bins at exact quantiles of the prediction; equal edges merge."""
    edges = df.agg(F.array_sort(F.array_distinct(F.percentile(p, F.array(*[F.lit(i / bins) for i in range(1, bins)]))))).first()[0] or []
    cut = F.array(*[F.lit(float(e)) for e in edges]) if edges else F.array().cast("array<double>")
    b = F.size(F.filter(cut, lambda e: e <= F.col(p)))
    return df.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.avg(p).alias("predicted"), F.avg(F.col(y).cast("double")).alias("actual"))


def baselines(df: DataFrame, y: str) -> DataFrame:
    """Errors of the constant predictions mean and median."""
    m, md = df.agg(F.avg(y), F.median(y)).first()
    if m is None:
        return df.agg(F.lit(None).cast("double").alias("mae_mean"), F.lit(None).cast("double").alias("mae_median"))
    return df.agg(F.avg(F.abs(F.col(y) - F.lit(m))).alias("mae_mean"), F.avg(F.abs(F.col(y) - F.lit(md))).alias("mae_median"))


def clustered_mean(df: DataFrame, cluster: str, value: str) -> DataFrame:
    """Mean over clusters' means with its standard error (clusters, not rows, are independent)."""
    per = df.groupBy(cluster).agg(F.avg(value).alias("m"))
    return per.agg(F.count("m").alias("clusters"), F.avg("m").alias("mean"), (F.stddev_samp("m") / F.sqrt(F.count("m").cast("double"))).alias("se"))


def crps_normal(mu, sigma, y):
    """Continuous ranked probability score of a normal forecast."""
    z = (y - mu) / sigma
    return sigma * (z * (F.lit(2.0) * norm_cdf(z) - 1) + F.lit(2.0) * norm_pdf(z) - F.lit(1 / 3.141592653589793**0.5))


def distribution_scores(df: DataFrame, mu: str, sigma: str, y: str) -> DataFrame:
    """CRPS, log score and probability integral transform of normal forecasts."""
    m, s, t = F.col(mu), F.col(sigma), F.col(y).cast("double")
    pit = norm_cdf((t - m) / s)
    return df.agg(F.count(F.lit(1)).alias("n"), F.avg(crps_normal(m, s, t)).alias("crps"), F.avg(F.ln(s) + F.lit(0.9189385332046727) + (t - m) * (t - m) / (2 * s * s)).alias("log_score"), F.avg(pit).alias("pit_mean"), F.var_pop(pit).alias("pit_var"))


def rounded_calibration_mae(rows: DataFrame, pred: str, actual: str, per_unit: float = 1.0) -> DataFrame:
    """mae, bins, n: predictions rounded to bins of 1 / per_unit, mean distance of the bins' means weighted by rows."""
    b = rows.groupBy(F.round(F.col(pred) * F.lit(per_unit)).cast("bigint").alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.avg(pred).alias("p"), F.avg(actual).alias("a"))
    return b.agg(F.try_divide(F.sum(F.col("n") * F.abs(F.col("p") - F.col("a"))), F.sum("n")).alias("mae"), F.count(F.lit(1)).alias("bins"), F.sum("n").alias("n"))


def welch(rows: DataFrame, group: str, a: str, b: str, value: str) -> DataFrame:
    """t, df of the difference of two groups' means with unequal variances, from one aggregate."""
    on = lambda g: F.when(F.col(group) == g, F.col(value).cast("double"))
    s = rows.agg(*[f(on(g)).alias(f"{k}_{i}") for i, g in enumerate((a, b)) for k, f in (("m", F.avg), ("v", F.var_samp), ("n", F.count))])
    va, vb = F.col("v_0") / F.col("n_0"), F.col("v_1") / F.col("n_1")
    df = F.try_divide((va + vb) * (va + vb), va * va / (F.col("n_0") - 1) + vb * vb / (F.col("n_1") - 1))
    return s.select(F.try_divide(F.col("m_0") - F.col("m_1"), F.sqrt(va + vb)).alias("t"), df.alias("df"))


def shape(rows: DataFrame, value: str) -> DataFrame:
    """n, sd, skewness and excess kurtosis (population moments)."""
    return rows.agg(F.count(value).alias("n"), F.stddev_pop(value).alias("sd"), F.skewness(value).alias("skewness"), F.kurtosis(value).alias("excess_kurtosis"))


def chi_square(rows: DataFrame, a: str, b: str) -> DataFrame:
    """chi2, df of the independence of two columns; rows are counted per cell first."""
    cells = rows.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(F.col(a).alias("a"), F.col(b).alias("b")).agg(F.count(F.lit(1)).alias("n"))
    by = lambda c: cells.groupBy(c).agg(F.sum("n").alias(f"n_{c}"))
    every = cells.agg(F.sum("n").alias("all"), F.count_distinct("a").alias("ka"), F.count_distinct("b").alias("kb"))
    share = cells.join(by("a"), "a").join(by("b"), "b").agg(F.sum(F.col("n") * F.col("n") / (F.col("n_a") * F.col("n_b"))).alias("s"))
    e = every.first()
    return share.select(((F.col("s") - 1) * F.lit(e["all"])).alias("chi2"), F.lit((e["ka"] - 1) * (e["kb"] - 1)).cast("bigint").alias("df"))


#: Mean of ln|z| over a standard normal z: -(Euler's constant + ln 2) / 2.
LOG_ABS_NORMAL = -(0.5772156649015329 + 0.6931471805599453) / 2


def sigma_from_logs(rows: DataFrame, residual: str, groups: tuple[str, ...]) -> DataFrame:
    """groups..., n, sigma: spread of normal residuals from the mean of their logarithms; residuals of 0 are left out."""
    e = F.abs(F.col(residual).cast("double"))
    return rows.where(e > 0).groupBy(*groups).agg(F.count(F.lit(1)).alias("n"), F.exp(F.avg(F.ln(e)) - F.lit(LOG_ABS_NORMAL)).alias("sigma"))

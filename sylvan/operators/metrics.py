"""Regression metrics and residual statistics as Spark aggregations.

Every metric is one pass of partial + final aggregation over (y, p),
optionally grouped (per model, fold, segment).  Medians and quartiles
use the distributed exact quantile operator, so no group is ever
gathered into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sylvan.operators.ranking import exact_percentiles

ALL_METRICS = ("mse", "rmse", "mae", "mape", "r2_score", "explained_variance",
               "max_error", "median_ae", "smape")

# Fixed values of the reference's reports, in its order: score tiers
# (>= 0.85 outstanding, >= 0.80 success, >= 0.75 close, otherwise below;
# target 0.80) and per-row error bands (< 15 % good, < 25 % ok, else high).
TIERS = ((0.85, "outstanding"), (0.80, "success"), (0.75, "close"))
TIER_BELOW = "below"
TARGET_R2 = 0.80
ERROR_BANDS = ((15.0, "good"), (25.0, "ok"))
ERROR_BAND_ELSE = "high"


def _grouped(df: DataFrame, group_cols):
    g = list(group_cols)
    if g:
        return df, g, False
    return df.withColumn("_all", F.lit(0)), ["_all"], True


def with_residual(df: DataFrame, y: str = "y", p: str = "p", name: str = "residual") -> DataFrame:
    """Residual column y - p."""
    return df.withColumn(name, F.col(y) - F.col(p))


def regression_metrics(df: DataFrame, y: str = "y", p: str = "p", group_cols=(),
                       n_features: int | None = None, with_median: bool = True) -> DataFrame:
    """M1-M11 in one aggregation (+ one distributed median for M9).

    Constant y: R2 and explained variance are 1 when the fit is exact,
    else 0 (finite convention).  MAPE ignores y = 0 and is +inf when no
    row is left; SMAPE ignores zero denominators and is 0 when none is
    left.  Adjusted R2 is added when ``n_features`` is given (NaN when
    n <= k + 1).  ``with_median=False`` skips the median absolute error
    (the only metric that needs a sort) when a caller needs R2 only.
    """
    d, g, dropg = _grouped(df.select(*list(group_cols), F.col(y).cast("double").alias("_y"),
                                     F.col(p).cast("double").alias("_p")), group_cols)
    e = F.col("_y") - F.col("_p")
    den = (F.abs(F.col("_y")) + F.abs(F.col("_p"))) / 2
    mom = d.groupBy(*g).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(e * e).alias("mse"),
        F.avg(F.abs(e)).alias("mae"),
        F.avg(F.when(F.col("_y") != 0, F.abs(e / F.col("_y")))).alias("_mape"),
        F.var_pop("_y").alias("_vy"),
        F.var_pop(e).alias("_ve"),
        F.max(F.abs(e)).alias("max_error"),
        F.avg(F.when(den != 0, F.abs(e) / den)).alias("_smape"),
    )
    if with_median:
        med = exact_percentiles(d.withColumn("_ae", F.abs(e)), "_ae", [0.5], g, ["median_ae"])
        m = mom.join(med, g, "left")
    else:
        m = mom.withColumn("median_ae", F.lit(None).cast("double"))
    r2 = (F.when(F.col("_vy") > 0, F.lit(1.0) - F.col("mse") / F.col("_vy"))
           .when(F.col("mse") == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
    ev = (F.when(F.col("_vy") > 0, F.lit(1.0) - F.col("_ve") / F.col("_vy"))
           .when(F.col("_ve") == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
    cols = [*g, "n", "mse", F.sqrt("mse").alias("rmse"), "mae",
            F.coalesce(F.col("_mape") * 100, F.lit(float("inf"))).alias("mape"),
            r2.alias("r2_score"), ev.alias("explained_variance"), "max_error", "median_ae",
            F.coalesce(F.col("_smape") * 100, F.lit(0.0)).alias("smape")]
    out = m.select(*cols)
    if n_features is not None:
        k = int(n_features)
        out = out.withColumn(
            "adjusted_r2",
            F.when(F.col("n") <= k + 1, F.lit(float("nan")))
             .otherwise(F.lit(1.0) - (F.lit(1.0) - F.col("r2_score")) * (F.col("n") - 1)
                        / (F.col("n") - k - 1)))
    return out.drop("_all") if dropg else out


def metrics_long(metrics_wide: DataFrame, group_cols=(), requested=None) -> DataFrame:
    """(group..., metric, value) long form, optionally only the
    requested metric names (unknown names raise before execution)."""
    names = list(requested or ALL_METRICS)
    unknown = [m for m in names if m not in metrics_wide.columns]
    if unknown:
        raise ValueError(f"unknown metrics: {unknown}")
    stacked = F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in names]))
    return metrics_wide.select(*list(group_cols), stacked.alias("_m")).select(
        *list(group_cols), "_m.metric", "_m.value")


def residual_statistics(df: DataFrame, y: str = "y", p: str = "p", group_cols=()) -> DataFrame:
    """Mean, population std, min, max, median, q25, q75, IQR,
    population skewness and excess kurtosis (0 when std = 0)."""
    d, g, dropg = _grouped(df.select(*list(group_cols),
                                     (F.col(y) - F.col(p)).cast("double").alias("_r")), group_cols)
    mom = d.groupBy(*g).agg(
        F.avg("_r").alias("mean"), F.stddev_pop("_r").alias("std"),
        F.min("_r").alias("min"), F.max("_r").alias("max"),
        F.skewness("_r").alias("_sk"), F.kurtosis("_r").alias("_ku"))
    qs = exact_percentiles(d, "_r", [0.5, 0.25, 0.75], g, ["median", "q25", "q75"])
    out = mom.join(qs, g, "left").select(
        *g, "mean", "std", "min", "max", "median", "q25", "q75",
        (F.col("q75") - F.col("q25")).alias("iqr"),
        F.when(F.col("std") == 0, F.lit(0.0)).otherwise(F.col("_sk")).alias("skewness"),
        F.when(F.col("std") == 0, F.lit(0.0)).otherwise(F.col("_ku")).alias("kurtosis"))
    return out.drop("_all") if dropg else out


def target_statistics(df: DataFrame, y: str, class_col: str | None = None) -> DataFrame:
    """Min / max / mean of the target and the number of classes."""
    aggs = [F.count(F.lit(1)).alias("n"), F.min(y).alias("y_min"),
            F.max(y).alias("y_max"), F.avg(y).alias("y_mean")]
    if class_col:
        # distinct via a grouped count: partial aggregation, no single-task set
        classes = df.groupBy(class_col).count().agg(F.count(F.lit(1)).alias("n_classes"))
        return df.agg(*aggs).withColumn("_k", F.lit(0)).join(
            classes.withColumn("_k", F.lit(0)), "_k").drop("_k")
    return df.agg(*aggs)


def error_bands(df: DataFrame, y: str = "y", p: str = "p", bands=ERROR_BANDS) -> DataFrame:
    """Per-row absolute percentage error and its band."""
    pct = F.abs(F.try_divide(F.col(y) - F.col(p), F.col(y))) * 100
    band = F.lit(ERROR_BAND_ELSE)
    for limit, name in reversed(bands):
        band = F.when(F.col("error_pct") < limit, F.lit(name)).otherwise(band)
    return df.withColumn("error_pct", pct).withColumn("band", band)


def score_tiers(metrics: DataFrame, score: str = "r2_score", target: float = TARGET_R2,
                tiers=TIERS) -> DataFrame:
    """Tier of a score, the gap to the target in percentage points
    and a meets-target flag."""
    s = F.col(score)
    tier = F.lit(TIER_BELOW)
    for limit, name in reversed(tiers):
        tier = F.when(s >= limit, F.lit(name)).otherwise(tier)
    return (metrics.withColumn("tier", tier)
                   .withColumn("gap_pct", (F.lit(float(target)) - s) * 100)
                   .withColumn("meets_target", s >= F.lit(float(target))))


def compare_models(predictions: DataFrame, model_col: str = "model", y: str = "y",
                   p: str = "p", baseline: str | None = None) -> DataFrame:
    """Metrics per model on one test set; with ``baseline`` also the
    R2 improvement in percent over that model."""
    m = regression_metrics(predictions, y, p, [model_col])
    if baseline is None:
        return m
    base = m.where(F.col(model_col) == baseline).select(F.col("r2_score").alias("_b"),
                                                         F.lit(0).alias("_k"))
    return (m.withColumn("_k", F.lit(0)).join(F.broadcast(base), "_k", "left")
             .withColumn("improvement_pct",
                         F.try_divide(F.col("r2_score") - F.col("_b"), F.abs(F.col("_b"))) * 100)
             .drop("_k", "_b"))

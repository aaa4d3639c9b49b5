"""Missing values, validation and outliers.

Fitted state (fill values, means, standard deviations) is O(#columns)
and is returned to the driver as a small dict, then applied as literals
so the transform is a pure projection/filter inside whole-stage codegen.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from sylvan.functions.exprs import finite_or_null, unused
from sylvan.operators.ranking import column_medians


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NumericType) and f.name not in set(exclude)]


def string_columns(df: DataFrame, exclude=()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, StringType) and f.name not in set(exclude)]


def normalize_missing(df: DataFrame, cols=None) -> DataFrame:
    """NaN and +-inf become NULL in floating columns."""
    cols = [c for c in (cols or numeric_columns(df))
            if df.schema[c].dataType.typeName() in ("double", "float")]
    return df.withColumns({c: finite_or_null(c) for c in cols}) if cols else df


def drop_missing(df: DataFrame, cols=None) -> DataFrame:
    """drop whole rows (target included) having any missing value."""
    return normalize_missing(df).dropna("any", subset=cols)


def missing_report(df: DataFrame, cols=None) -> DataFrame:
    """(column, n_missing) for every column, one aggregation pass."""
    cols = list(cols or df.columns)
    num = set(numeric_columns(df))
    aggs = []
    for c in cols:
        miss = F.col(c).isNull()
        if c in num and df.schema[c].dataType.typeName() in ("double", "float"):
            miss = miss | F.isnan(c)
        aggs.append(F.count_if(miss).alias(c))
    wide = df.agg(*aggs)
    stacked = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("n_missing")) for c in cols]))
    return wide.select(stacked.alias("_s")).select("_s.column", "_s.n_missing")


def column_modes(df: DataFrame, cols) -> dict:
    """Most frequent value per column; ties go to the smallest value.

    Each column is a grouped count (partial aggregation, one row per
    distinct value) reduced by ``min(struct(-count, value))``: no value
    set is gathered in one task.
    """
    out = {}
    for c in cols:
        r = (df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("_n"))
               .agg(F.min(F.struct((-F.col("_n")).alias("k"), F.col(c).alias("v"))).alias("m"))
               .collect())
        out[c] = r[0]["m"]["v"] if r and r[0]["m"] is not None else None
    return out


def impute_median_mode(df: DataFrame, exclude=()) -> DataFrame:
    """Numeric columns filled with their exact median, string columns
    with their (smallest) mode."""
    d = normalize_missing(df)
    nums = numeric_columns(d, exclude)
    strs = string_columns(d, exclude)
    fills = {c: v for c, v in column_medians(d, nums).items() if v is not None}
    fills.update({c: v for c, v in column_modes(d, strs).items() if v is not None})
    return d.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast(d.schema[c].dataType))
                          for c, v in fills.items()}) if fills else d


@dataclass
class ImputerState:
    strategy: str
    fills: dict = field(default_factory=dict)


def fit_imputer(df: DataFrame, cols, strategy: str = "median",
                only_missing: bool = False) -> ImputerState:
    """Learn fill values (mean or exact median).

    ``only_missing=True`` reproduces the reference rule of learning a
    fill only for columns that have missing values at fit time.
    """
    if strategy not in ("mean", "median"):
        raise ValueError(f"no fill rule named {strategy!r}; use 'mean' or 'median'")
    d = normalize_missing(df, cols)
    cols = list(cols)
    if only_missing:
        rep = {r["column"]: r["n_missing"] for r in missing_report(d, cols).collect()}
        cols = [c for c in cols if rep.get(c, 0) > 0]
    if not cols:
        return ImputerState(strategy, {})
    if strategy == "mean":
        row = d.agg(*[F.avg(c).alias(c) for c in cols]).first()
        fills = {c: row[c] for c in cols}
    else:
        fills = column_medians(d, cols)
    return ImputerState(strategy, {c: v for c, v in fills.items() if v is not None})


def apply_imputer(df: DataFrame, state: ImputerState) -> DataFrame:
    d = normalize_missing(df, list(state.fills))
    return d.withColumns({c: F.coalesce(F.col(c), F.lit(float(v)))
                          for c, v in state.fills.items()}) if state.fills else d


def median_fill(df: DataFrame, cols=None) -> DataFrame:
    """+-inf/NaN to missing, then exact-median fill of numeric columns."""
    cols = list(cols or numeric_columns(df))
    return apply_imputer(df, fit_imputer(df, cols, "median"))


@dataclass
class OutlierState:
    means: dict
    stds: dict
    threshold: float


def fit_outliers(df: DataFrame, cols, threshold: float = 3.0) -> OutlierState:
    """F2 fit: mean and population std per feature (one aggregation)."""
    row = df.agg(*[F.avg(c).alias(f"m_{c}") for c in cols],
                 *[F.stddev_pop(c).alias(f"s_{c}") for c in cols]).first()
    return OutlierState({c: row[f"m_{c}"] for c in cols},
                        {c: row[f"s_{c}"] for c in cols}, float(threshold))


def outlier_flag(state: OutlierState):
    """True when any feature has |x - mean| / (std + 1e-8) > threshold."""
    cond = F.lit(False)
    for c in state.means:
        z = F.abs((F.col(c) - F.lit(state.means[c])) / (F.lit(state.stds[c]) + F.lit(1e-8)))
        cond = cond | (z > F.lit(state.threshold))
    return cond


def remove_outliers(df: DataFrame, cols, threshold: float = 3.0):
    """F2: drop rows that are z-score outliers in any feature (whole rows,
    target included).  Returns (kept rows, state)."""
    st = fit_outliers(df, cols, threshold)
    return df.where(~outlier_flag(st)), st


def outlier_summary(df: DataFrame, cols, threshold: float = 3.0) -> DataFrame:
    """F2 report: number and percentage of outlier rows."""
    st = fit_outliers(df, cols, threshold)
    return df.agg(F.count_if(outlier_flag(st)).alias("n_outliers"),
                  F.count(F.lit(1)).alias("n_rows")).withColumn(
        "pct_outliers", F.col("n_outliers") * 100.0 / F.col("n_rows"))


def validation_rules(df: DataFrame, feature_cols=None, target: str | None = None,
                     array_col: str | None = None, n_features: int | None = None) -> dict:
    """F3 rules as named boolean columns (True = violation)."""
    rules = {}
    for c in feature_cols or []:
        x = F.col(c)
        rules[f"missing_{c}"] = x.isNull() | F.isnan(x)
        rules[f"infinite_{c}"] = F.abs(x) == F.lit(float("inf"))
    if target:
        rules["missing_target"] = F.col(target).isNull() | F.isnan(target)
    if array_col:
        rules["empty_array"] = F.coalesce(F.size(array_col), F.lit(-1)) <= 0
        if n_features is not None:
            rules["wrong_length"] = F.size(array_col) != F.lit(int(n_features))
        rules["nonfinite_element"] = F.exists(
            array_col, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    return rules


def validate(df: DataFrame, **kw) -> DataFrame:
    """one aggregation giving (rule, n_violations) per rule."""
    rules = validation_rules(df, **kw)
    wide = df.agg(*[F.count_if(c).alias(n) for n, c in rules.items()])
    stacked = F.explode(F.array(*[
        F.struct(F.lit(n).alias("rule"), F.col(n).alias("n_violations")) for n in rules]))
    return wide.select(stacked.alias("_s")).select("_s.rule", "_s.n_violations")


def with_reasons(df: DataFrame, out: str = "reasons", **kw) -> DataFrame:
    """``df`` plus the names of the rules each row breaks.  A rule is undecided only on a
    missing value, which the rule for missing values or empty arrays names."""
    named = F.array(*(F.when(c, F.lit(n)) for n, c in validation_rules(df, **kw).items()))
    return df.withColumn(out, F.array_compact(named))


def quarantine(df: DataFrame, reasons: str | None = None, **kw):
    """split rows into (valid, rejected) by the same rules; ``reasons``
    names a column of the rejected rows that lists the rules they break."""
    (col,) = unused(df, reasons or "reasons")
    told = with_reasons(df, col, **kw)
    bad = told.where(F.size(col) > 0)
    return told.where(F.size(col) == 0).drop(col), bad if reasons else bad.drop(col)

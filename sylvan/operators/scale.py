"""Scalers and the preprocessing pipeline.

Fitting is one aggregation (O(#features) result, collected as state);
transform and inverse are projections with literal constants, so they
stay inside whole-stage codegen with no join and no shuffle.  Population
standard deviation is used (a zero spread becomes 1), matching the
reference; this is why ``pyspark.ml`` scalers (sample std, midpoint for
constants) are not used.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sylvan.operators import clean


class NotFittedError(ValueError):
    pass


def significant(x, digits: int | None):
    """Round a fitted constant to ``digits`` significant digits.

    Floating sums depend on the order partial aggregates are merged,
    which varies between runs and partitionings; a caller that needs a refit
    on the same data to give the same bits can store fewer digits.
    """
    if x is None or digits is None or x == 0 or x != x:
        return x
    return float(f"{x:.{digits}g}")


@dataclass
class StandardScaler:
    cols: list
    mean_: dict = field(default_factory=dict)
    scale_: dict = field(default_factory=dict)
    sig_digits: int | None = None

    def fit(self, df: DataFrame) -> "StandardScaler":
        row = df.agg(*[F.avg(c).alias(f"m_{c}") for c in self.cols],
                     *[F.stddev_pop(c).alias(f"s_{c}") for c in self.cols]).first()
        self.mean_ = {c: significant(row[f"m_{c}"], self.sig_digits) for c in self.cols}
        self.scale_ = {c: (significant(row[f"s_{c}"], self.sig_digits) if row[f"s_{c}"] else 1.0)
                       for c in self.cols}
        return self

    def _check(self, df: DataFrame):
        if not self.mean_:
            raise NotFittedError("call fit on this StandardScaler first")
        missing = [c for c in self.cols if c not in df.columns]
        if missing:
            raise ValueError(f"Expected features {self.cols}, missing {missing}")

    def transform(self, df: DataFrame) -> DataFrame:
        self._check(df)
        return df.withColumns({c: (F.col(c) - F.lit(self.mean_[c])) / F.lit(self.scale_[c])
                               for c in self.cols})

    def inverse_transform(self, df: DataFrame) -> DataFrame:
        self._check(df)
        return df.withColumns({c: F.col(c) * F.lit(self.scale_[c]) + F.lit(self.mean_[c])
                               for c in self.cols})

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)

    def state(self) -> list[tuple]:
        return [(c, "mean", self.mean_[c]) for c in self.cols] + \
               [(c, "scale", self.scale_[c]) for c in self.cols]


@dataclass
class MinMaxScaler:
    cols: list
    feature_range: tuple = (0.0, 1.0)
    data_min_: dict = field(default_factory=dict)
    data_max_: dict = field(default_factory=dict)
    scale_: dict = field(default_factory=dict)
    min_: dict = field(default_factory=dict)

    def fit(self, df: DataFrame) -> "MinMaxScaler":
        lo, hi = self.feature_range
        if lo >= hi:
            raise ValueError(f"empty feature_range {self.feature_range}")
        row = df.agg(*[F.min(c).alias(f"lo_{c}") for c in self.cols],
                     *[F.max(c).alias(f"hi_{c}") for c in self.cols]).first()
        for c in self.cols:
            dmin, dmax = row[f"lo_{c}"], row[f"hi_{c}"]
            rng = (dmax - dmin) or 1.0
            self.data_min_[c], self.data_max_[c] = dmin, dmax
            self.scale_[c] = (hi - lo) / rng
            self.min_[c] = lo - dmin * self.scale_[c]
        return self

    def _check(self, df: DataFrame):
        if not self.scale_:
            raise NotFittedError("call fit on this MinMaxScaler first")
        missing = [c for c in self.cols if c not in df.columns]
        if missing:
            raise ValueError(f"Expected features {self.cols}, missing {missing}")

    def transform(self, df: DataFrame) -> DataFrame:
        self._check(df)
        return df.withColumns({c: F.col(c) * F.lit(self.scale_[c]) + F.lit(self.min_[c])
                               for c in self.cols})

    def inverse_transform(self, df: DataFrame) -> DataFrame:
        self._check(df)
        return df.withColumns({c: (F.col(c) - F.lit(self.min_[c])) / F.lit(self.scale_[c])
                               for c in self.cols})

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)

    def state(self) -> list[tuple]:
        return [(c, "scale", self.scale_[c]) for c in self.cols] + \
               [(c, "min", self.min_[c]) for c in self.cols]


def make_scaler(kind: str, cols, sig_digits: int | None = None):
    if kind == "standard":
        return StandardScaler(list(cols), sig_digits=sig_digits)
    if kind == "minmax":
        return MinMaxScaler(list(cols))
    raise ValueError(f"no scaler named {kind!r}; use 'standard' or 'minmax'")


@dataclass
class Preprocessor:
    """C4: missing values -> outliers (fit only) -> scaler.

    ``transform`` applies the learned fills and scaling but never removes
    outliers; ``inverse_transform`` undoes the scaling only.  Rows are
    always removed whole (target included).
    """
    cols: list
    scaler_type: str = "standard"
    handle_missing: str = "mean"
    remove_outliers: bool = False
    outlier_threshold: float = 3.0
    sig_digits: int | None = None
    imputer_: clean.ImputerState | None = None
    scaler_: object = None
    n_outliers_: int = 0

    def _missing(self, df: DataFrame, fit: bool) -> DataFrame:
        if self.handle_missing == "drop":
            return clean.drop_missing(df, self.cols)
        if fit:
            self.imputer_ = clean.fit_imputer(df, self.cols, self.handle_missing)
        return clean.apply_imputer(df, self.imputer_)

    def fit(self, df: DataFrame) -> "Preprocessor":
        d = self._missing(df, True)
        if self.remove_outliers:
            d, _ = clean.remove_outliers(d, self.cols, self.outlier_threshold)
        self.scaler_ = make_scaler(self.scaler_type, self.cols, self.sig_digits).fit(d)
        return self

    def fit_transform(self, df: DataFrame) -> DataFrame:
        d = self._missing(df, True)
        if self.remove_outliers:
            d, _ = clean.remove_outliers(d, self.cols, self.outlier_threshold)
        self.scaler_ = make_scaler(self.scaler_type, self.cols, self.sig_digits).fit(d)
        return self.scaler_.transform(d)

    def transform(self, df: DataFrame) -> DataFrame:
        if self.scaler_ is None:
            raise NotFittedError("call fit on this Preprocessor first")
        return self.scaler_.transform(self._missing(df, False))

    def inverse_transform(self, df: DataFrame) -> DataFrame:
        if self.scaler_ is None:
            raise NotFittedError("call fit on this Preprocessor first")
        return self.scaler_.inverse_transform(df)

"""Synthetic regression sets (S3, S4) over the keys of a given table.

The number of rows follows the key table (so the work grows with the
data); every value is a hash-derived draw of (key, seed, column), so a
row's features never depend on partitioning and DuckDB can reproduce
them.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sylvan.functions.hashing import TWO32, hash8, normal


def _normal_col(key: str, seed, *salt) -> F.Column:
    s = F.lit(str(seed))
    parts = [F.lit(str(p)) for p in salt]
    return normal(hash8(key, s, *parts, F.lit("a")), hash8(key, s, *parts, F.lit("b")))


def linear_coefficients(seed, n_informative: int) -> list[float]:
    """Coefficients 100 * U(0, 1) of the informative features, one hash
    draw each (a handful of numbers, computed once)."""
    out = []
    for j in range(n_informative):
        h = hashlib.md5(f"{seed}|coef|{j}".encode()).hexdigest()[:8]
        out.append(100.0 * (int(h, 16) / TWO32))
    return out


def linear_set(keys: DataFrame, n_features: int = 10, n_informative: int = 5, noise: float = 0.1,
               seed=42, key: str = "row_key") -> DataFrame:
    """S3: Gaussian features ``feature_i``; target = sum of coef_j *
    feature_j over the informative features + noise * N(0, 1)."""
    if n_informative > n_features:
        raise ValueError("n_informative must be <= n_features")
    d = keys.select(key, *[_normal_col(key, seed, "x", i).alias(f"feature_{i}") for i in range(n_features)],
                    _normal_col(key, seed, "noise").alias("_eps"))
    lin = None
    for j, c in enumerate(linear_coefficients(seed, n_informative)):
        term = F.lit(c) * F.col(f"feature_{j}")
        lin = term if lin is None else lin + term
    lin = lin if lin is not None else F.lit(0.0)
    return d.withColumn("target", lin + F.lit(float(noise)) * F.col("_eps")).drop("_eps")


def nonlinear_set(keys: DataFrame, n_features: int = 5, noise: float = 0.1, complexity: str = "medium",
                  seed=42, key: str = "row_key") -> DataFrame:
    """Gaussian features and a simple / medium / complex nonlinear
    target (unknown level raises)."""
    if complexity not in ("simple", "medium", "complex"):
        raise ValueError(f"no target formula named {complexity!r}")
    d = keys.select(key, *[_normal_col(key, seed, "x", i).alias(f"feature_{i}") for i in range(n_features)],
                    _normal_col(key, seed, "noise").alias("_eps"))
    x = [F.col(f"feature_{i}") for i in range(n_features)]
    if complexity == "simple":
        y = x[0] * x[0] + F.lit(0.5) * x[1] + F.lit(0.2) * x[2]
    elif complexity == "medium":
        y = (x[0] * x[0] + x[1] * x[1] + x[0] * x[1] + F.lit(0.5) * F.sin(x[2])
             + F.lit(0.3) * F.exp(x[3] / 2))
    else:
        y = (F.sin(x[0]) * (x[1] * x[1]) + F.cos(x[2]) * x[3] + F.exp(x[4] / 3)
             + x[0] * x[1] * x[2] + F.sqrt(F.abs(x[0] + x[1])))
    return d.withColumn("target", y + F.lit(float(noise)) * F.col("_eps")).drop("_eps")

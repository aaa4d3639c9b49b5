import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from sylvan.functions.hashing import hash8, hex_threshold, poisson1_thresholds, poisson1_weight, uniform
from sylvan.operators.ranking import column_medians, exact_percentiles


def test_poisson_cut_points_follow_the_rule():
    # fixed values: floor(2^32 * P(Poisson(1) <= k)) for k = 0..6, in hex
    assert len(poisson1_thresholds()) == 12
    assert poisson1_thresholds()[:7] == ["5e2d58d8", "bc5ab1b1", "eb715e1d", "fb239797",
                                     "ff1025f5", "ffd90f3b", "fffa8b71"]
    assert hex_threshold(0.2) == "33333333"


def test_hash8_matches_python_md5(spark):
    df = spark.range(50).withColumnRenamed("id", "row_key")
    got = df.select("row_key", hash8("row_key", F.lit("42"), F.lit(3)).alias("h")).toPandas()
    for k, h in zip(got.row_key, got.h):
        assert h == hashlib.md5(f"{k}|42|3".encode()).hexdigest()[:8]


def test_uniform_and_poisson_distribution(spark):
    df = spark.range(20000).withColumnRenamed("id", "row_key")
    h = hash8("row_key", F.lit("7"))
    r = df.select(uniform(h).alias("u"), poisson1_weight(h).alias("w")).toPandas()
    assert r.u.between(0, 1).all() and r.u.max() < 1
    assert abs(r.u.mean() - 0.5) < 0.02
    assert abs(r.w.mean() - 1.0) < 0.03
    assert abs((r.w == 0).mean() - np.exp(-1)) < 0.02


def _np_pct(v, p):
    return float(np.percentile(np.asarray(v, dtype=float), p * 100))


def test_exact_percentiles_match_numpy_with_hot_value_and_group(spark):
    rng = np.random.RandomState(0)
    n = 3000
    g = np.where(rng.rand(n) < 0.6, "hot", rng.choice(["a", "b", "c"], n))
    v = rng.randn(n)
    v[: n // 3] = 1.25  # one value holds a third of all rows
    pdf = pd.DataFrame({"g": g, "v": v})
    df = spark.createDataFrame(pdf).repartition(5)
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    for parts in (1, 7):
        got = exact_percentiles(df, "v", probs, ["g"]).toPandas().set_index("g")
        for key, grp in pdf.groupby("g"):
            for p in probs:
                assert abs(got.loc[key, f"p{int(p * 100)}"] - _np_pct(grp.v, p)) < 1e-12
    whole = exact_percentiles(df, "v", [0.5]).first()[0]
    assert abs(whole - _np_pct(pdf.v, 0.5)) < 1e-12


def test_column_medians_ignore_nulls(spark):
    pdf = pd.DataFrame({"a": [1.0, None, 3.0, 10.0], "b": [2.0, 2.0, None, None]})
    m = column_medians(spark.createDataFrame(pdf), ["a", "b"])
    assert m == {"a": 3.0, "b": 2.0}


def test_exact_percentiles_after_a_shuffle_are_stable(spark):
    # rows arriving from a shuffle have no fixed order; positions must still agree
    rng = np.random.RandomState(5)
    pdf = pd.DataFrame({"v": np.round(rng.randn(4000) * 100)})  # many duplicate values
    df = spark.createDataFrame(pdf).repartition(9).withColumn("v", F.col("v") * 1.0)
    for _ in range(2):
        got = exact_percentiles(df, "v", [0.25, 0.5, 0.9]).first()
        for p in (0.25, 0.5, 0.9):
            assert got[f"p{int(p * 100)}"] == _np_pct(pdf.v, p)

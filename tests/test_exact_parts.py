"""Exact split sizes, fold-routed scoring, rejected lines, quantiles whose bracket misses."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sylvan.operators import clean, ranking, score as SC, split as SP
from sylvan.operators.forest import ForestParams, fit_forest
from sylvan.session import scratch_path
from sylvan.sources.io import read_csv_checked


def order(keys, seed=42):
    return sorted(keys, key=lambda k: (hashlib.md5(f"{k}|{seed}".encode()).hexdigest()[:8], k))


@pytest.mark.parametrize("n", [0, 1, 2, 30, 997])
def test_sizes_are_exact_and_the_same_for_any_partitioning(spark, n):
    df = spark.range(n).withColumnRenamed("id", "row_key")
    ranked = order(range(n))
    for parts in (1, 7):
        d = df.repartition(parts)
        test = {r[0] for r in SP.exact_train_test_split(d, test_size=0.1).where("split = 'test'").collect()}
        assert test == set(ranked[:math.ceil(n / 10)])
        three = {r[0]: r[1] for r in SP.exact_three_way_split(d, test_size=0.15, val_size=0.2).collect()}
        t = -(-15 * n // 100)
        v = -(-(n - t) // 5)
        assert [three[k] for k in ranked] == ["test"] * t + ["val"] * v + ["train"] * (n - t - v)
        folds = {r[0]: r[1] for r in SP.exact_kfold(d, k=4).collect()}
        sizes = np.bincount(list(folds.values()), minlength=4) if folds else np.zeros(4, int)
        assert sizes.tolist() == [n // 4 + (i < n % 4) for i in range(4)]
        assert [folds[k] for k in ranked] == sorted(folds.values())


def test_equal_hashes_are_told_apart_by_key(spark, monkeypatch):
    monkeypatch.setattr(SP, "split_hash", lambda key, seed: F.when(F.col(key) % 3 == 0, F.lit("00000aaa")).otherwise(F.lit("00000bbb")))
    df = spark.range(30).withColumnRenamed("id", "row_key").repartition(4)
    ranked = sorted(range(30), key=lambda k: (k % 3 > 0, k))
    for share in (0.1, 1 / 3, 0.5, 1.0):
        m = math.ceil(share * 30)
        got = SP.exact_train_test_split(df, test_size=share).where("split = 'test'").collect()
        assert {r[0] for r in got} == set(ranked[:m])
    assert SP.exact_train_test_split(df, test_size=0.0).where("split = 'test'").count() == 0


def test_null_keys_are_ordinary(spark):
    df = spark.createDataFrame([(None,), (1,), (2,), (3,)], "row_key long")
    assert SP.exact_train_test_split(df, test_size=0.5).where("split = 'test'").count() == 2
    with pytest.raises(ValueError):
        SP.exact_kfold(df, k=1)


def test_rows_walk_the_trees_of_their_own_block(sample_regression):
    train, test, _ = sample_regression
    feats = [f"x{i}" for i in range(5)]
    model = fit_forest(train, feats, "y", ForestParams(n_trees=6, max_depth=3))
    blocks = test.withColumn("b", F.when(F.col("row_key") % 5 < 4, (F.col("row_key") % 5).cast("int")))
    got = {r["row_key"]: r for r in SC.predict_blocks(blocks, model, "b", 2).collect()}
    every = {r["row_key"]: r["tree_predictions"] for r in SC.predict(test, model, per_tree=True).collect()}
    for k, r in got.items():
        if r["b"] is None or r["b"] > 2:
            assert r["prediction"] is None
        else:
            assert r["prediction"] == pytest.approx(np.mean(every[k][2 * r["b"]:2 * r["b"] + 2]), rel=1e-12)


def test_rejected_lines_have_reasons_and_no_line_is_lost(spark):
    path = scratch_path(spark, "ragged")
    lines = ["a,b,t", "1,2.5,3", "2,x,3", "3,1", "4,1,2,9", "5,,3", "6,NaN,3", "7,1.5,", "8,Infinity,1", "", ",,"]
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(path)
    good, bad = read_csv_checked(spark, path, "a long, b double, t double", feature_cols=["b"], target="t")
    assert [tuple(r) for r in good.collect()] == [(1, 2.5, 3.0)] and good.columns == ["a", "b", "t"]
    got = sorted((r["line"] or str(r["a"]), *r["reasons"]) for r in bad.collect())
    assert got == [("2,x,3", "unreadable"), ("3,1", "unreadable"), ("4,1,2,9", "unreadable"), ("5", "missing_b"),
                   ("6", "missing_b"), ("7", "missing_target"), ("8", "infinite_b"), ("None", "empty")]
    plain, ragged = read_csv_checked(spark, path, "a long, b double, t double")
    assert plain.count() == 5 and ragged.count() == 4


def test_quarantine_lists_every_broken_rule(spark):
    df = spark.createDataFrame([(1.0, [1.0, 2.0], "x"), (None, [1.0], "y"), (float("inf"), None, "z"), (2.0, [1.0, None], "w")],
                               "v double, arr array<double>, reasons string")
    good, bad = clean.quarantine(df, reasons="reasons", feature_cols=["v"], array_col="arr", n_features=2)
    assert good.columns == df.columns and [r["reasons"] for r in good.collect()] == ["x"]
    assert {r["reasons"]: r["reasons_"] for r in bad.collect()} == {
        "y": ["missing_v", "wrong_length"], "z": ["infinite_v", "empty_array"], "w": ["nonfinite_element"]}


def test_a_bracket_without_its_rank_is_never_a_silent_null(spark, monkeypatch):
    df = spark.range(1000).select(F.col("id").cast("double").alias("v"))
    monkeypatch.setattr(ranking, "ACCURACY", 100)
    real = ranking._brackets

    def wrong(v, probs):
        n, low, high, _ = real(v, probs)
        return [n, low, high, F.array(*[F.lit(900.0), F.lit(950.0)] * len(probs))]
    monkeypatch.setattr(ranking, "_brackets", wrong)
    assert ranking.column_medians(df, ["v"]) == {"v": 499.5}
    with pytest.raises(Exception, match="outside its sketch bracket"):
        ranking.exact_percentiles(df, "v", [0.5]).collect()

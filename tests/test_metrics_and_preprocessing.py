import math

import numpy as np
import pandas as pd
import pytest

from sylvan.operators import clean, metrics as M, scale as C, split as SP


def _pairs(spark, y, p):
    return spark.createDataFrame(pd.DataFrame({"y": y, "p": p}))


def test_metrics_doc_example(spark):
    y = np.array([1.0, 2.0, 3.0, 4.0])
    p = np.array([1.1, 1.9, 3.2, 3.8])
    r = M.regression_metrics(_pairs(spark, y, p), n_features=1).first().asDict()
    e = y - p
    assert r["mse"] == pytest.approx(np.mean(e ** 2))
    assert r["rmse"] == pytest.approx(np.sqrt(np.mean(e ** 2)))
    assert r["mae"] == pytest.approx(np.mean(np.abs(e)))
    assert r["mape"] == pytest.approx(np.mean(np.abs(e / y)) * 100)
    assert r["r2_score"] == pytest.approx(1 - np.sum(e ** 2) / np.sum((y - y.mean()) ** 2))
    assert r["explained_variance"] == pytest.approx(1 - np.var(e) / np.var(y))
    assert r["max_error"] == pytest.approx(np.max(np.abs(e)))
    assert r["median_ae"] == pytest.approx(np.median(np.abs(e)))
    assert r["smape"] == pytest.approx(np.mean(np.abs(e) / ((np.abs(y) + np.abs(p)) / 2)) * 100)
    assert r["adjusted_r2"] == pytest.approx(1 - (1 - r["r2_score"]) * 3 / 2)


def test_metric_edge_cases(spark):
    r = M.regression_metrics(_pairs(spark, [2.0, 2.0, 2.0], [2.0, 2.0, 2.0]), n_features=5).first()
    assert r["r2_score"] == 1.0 and math.isnan(r["adjusted_r2"])
    r = M.regression_metrics(_pairs(spark, [2.0, 2.0], [1.0, 3.0])).first()
    assert r["r2_score"] == 0.0
    r = M.regression_metrics(_pairs(spark, [0.0, 0.0], [0.0, 0.0])).first()
    assert math.isinf(r["mape"]) and r["smape"] == 0.0


def test_residual_statistics_population_moments(spark):
    rng = np.random.RandomState(3)
    y = rng.gamma(2.0, 2.0, 500)
    p = np.zeros(500)
    r = M.residual_statistics(_pairs(spark, y, p)).first()
    x = y - p
    z = (x - x.mean()) / x.std()
    assert r["std"] == pytest.approx(x.std())
    assert r["skewness"] == pytest.approx(np.mean(z ** 3))
    assert r["kurtosis"] == pytest.approx(np.mean(z ** 4) - 3)
    assert r["q25"] == pytest.approx(np.percentile(x, 25))
    assert r["iqr"] == pytest.approx(np.percentile(x, 75) - np.percentile(x, 25))


def test_standard_scaler_doc_example_and_inverse(spark):
    df = spark.createDataFrame(pd.DataFrame({"a": [1.0, 3.0, 5.0], "b": [2.0, 4.0, 6.0], "c": [7.0, 7.0, 7.0]}))
    sc = C.StandardScaler(["a", "b", "c"])
    out = sc.fit_transform(df).toPandas()
    assert np.allclose(out.a, [-1.224744871, 0.0, 1.224744871])
    assert sc.scale_["c"] == 1.0 and np.allclose(out.c, 0.0)
    back = sc.inverse_transform(sc.transform(df)).toPandas()
    assert np.allclose(back.a, [1, 3, 5]) and np.allclose(back.c, 7)
    with pytest.raises(ValueError):
        C.StandardScaler(["a"]).transform(df)


def test_minmax_constant_column_maps_to_lower_bound(spark):
    df = spark.createDataFrame(pd.DataFrame({"a": [1.0, 3.0, 5.0], "c": [7.0, 7.0, 7.0]}))
    sc = C.MinMaxScaler(["a", "c"], feature_range=(-1.0, 1.0))
    out = sc.fit_transform(df).toPandas()
    assert np.allclose(out.a, [-1, 0, 1]) and np.allclose(out.c, -1.0)
    assert np.allclose(sc.inverse_transform(sc.transform(df)).toPandas().a, [1, 3, 5])


def test_imputer_and_outliers_remove_whole_rows(spark):
    pdf = pd.DataFrame({"row_key": range(6), "a": [1.0, None, 3.0, np.inf, 5.0, 100.0],
                        "y": [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]})
    df = spark.createDataFrame(pdf)
    st = clean.fit_imputer(df, ["a"], "median")
    assert st.fills["a"] == pytest.approx(4.0)  # median of 1, 3, 5, 100 (inf and NaN are missing)
    dropped = clean.drop_missing(df).toPandas()
    assert sorted(dropped.row_key) == [0, 2, 4, 5]
    kept, _ = clean.remove_outliers(clean.apply_imputer(df, st), ["a"], threshold=2.0)
    assert 5 not in set(kept.toPandas().row_key)


def test_hash_splits_are_stable_and_disjoint(spark):
    df = spark.range(5000).withColumnRenamed("id", "row_key")
    a = SP.train_test_split(df, test_size=0.2, seed=1).toPandas()
    b = SP.train_test_split(df.repartition(7), test_size=0.2, seed=1).toPandas()
    assert a.sort_values("row_key").split.tolist() == b.sort_values("row_key").split.tolist()
    assert abs((a.split == "test").mean() - 0.2) < 0.03
    f = SP.kfold(df, k=5).toPandas()
    assert set(f.fold) == {0, 1, 2, 3, 4} and len(f) == 5000
    t = SP.three_way_split(df).toPandas()
    assert abs((t.split == "test").mean() - 0.15) < 0.03


def test_resolve_max_features():
    assert SP.resolve_max_features("sqrt", 8) == 2
    assert SP.resolve_max_features("log2", 8) == 3
    assert SP.resolve_max_features(0.5, 9) == 4
    assert SP.resolve_max_features(20, 9) == 9
    assert SP.resolve_max_features(None, 9) == 9
    with pytest.raises(ValueError):
        SP.resolve_max_features("bogus", 9)

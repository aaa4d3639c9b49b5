"""Property checks on random inputs (Hypothesis)."""

import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests import plain_tree
from sylvan.operators.forest import ForestParams, fit_forest
from sylvan.operators.ranking import exact_percentiles

SETTINGS = dict(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@settings(**SETTINGS)
@given(values=st.lists(st.integers(-5, 5), min_size=1, max_size=60),
       groups=st.integers(1, 3), parts=st.integers(1, 6))
def test_quantiles_match_numpy(spark, values, groups, parts):
    v = np.array(values, dtype=float) / 2
    g = np.arange(len(v)) % groups
    df = spark.createDataFrame(pd.DataFrame({"g": g, "v": v})).repartition(parts)
    got = exact_percentiles(df, "v", [0.1, 0.5, 0.99], ["g"]).toPandas().set_index("g")
    for key in np.unique(g):
        vv = v[g == key]
        for p in (0.1, 0.5, 0.99):
            assert abs(got.loc[key, f"p{int(round(p * 100))}"] - np.percentile(vv, p * 100)) < 1e-9


@settings(**SETTINGS)
@given(n=st.integers(12, 60), seed=st.integers(0, 1000), msl=st.integers(1, 3))
def test_fit_equals_a_plain_tree_on_random_data(spark, n, seed, msl):
    rng = np.random.RandomState(seed)
    x = np.round(rng.randn(n, 3), 1)  # rounded: many ties and duplicate values
    pdf = pd.DataFrame(x, columns=["a", "b", "c"])
    pdf["y"] = np.round(x[:, 0] * 3 + rng.randn(n), 2)
    pdf.insert(0, "row_key", np.arange(n, dtype=np.int64))
    df = spark.createDataFrame(pdf)
    kw = dict(n_trees=2, max_depth=4, min_samples_leaf=msl, seed=seed, max_features=2)
    nodes = fit_forest(df, ["a", "b", "c"], "y", ForestParams(**kw)).nodes
    rows = list(zip(pdf[["a", "b", "c"]].to_numpy().tolist(), pdf["y"], pdf["row_key"]))
    want = {t: plain_tree.grow([(x, plain_tree.poisson(plain_tree.h8(k, seed, t)), y) for x, y, k in rows],
                               3, 2, t, seed, 4, msl=msl) for t in range(2)}
    assert plain_tree.same(nodes, want)


@settings(**SETTINGS)
@given(n=st.integers(20, 80), seed=st.integers(0, 1000), buckets=st.integers(2, 9))
def test_bucketed_exact_search_equals_single_window(spark, n, seed, buckets):
    rng = np.random.RandomState(seed)
    x = rng.randn(n, 3)
    x[: n // 3, 0] = 0.5  # a value holding a third of the rows
    pdf = pd.DataFrame(np.round(x, 2), columns=["a", "b", "c"])
    pdf["y"] = np.round(x[:, 1] - x[:, 0] + rng.randn(n) * 0.1, 3)
    pdf.insert(0, "row_key", np.arange(n, dtype=np.int64))
    df = spark.createDataFrame(pdf)
    kw = dict(n_trees=2, max_depth=3, seed=seed, max_features=None)
    a = fit_forest(df, ["a", "b", "c"], "y", ForestParams(**kw)).nodes
    b = fit_forest(df, ["a", "b", "c"], "y", ForestParams(**kw, prefix_buckets=buckets)).nodes
    cols = ["tree_id", "node_id", "feature", "threshold", "n", "is_leaf"]
    assert a[cols].astype(str).reset_index(drop=True).equals(b[cols].astype(str).reset_index(drop=True))

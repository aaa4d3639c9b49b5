"""Large nodes: the screened search gives the same trees and ships few values."""

import numpy as np
import pandas as pd
import pytest

from sylvan.operators import forest, levels, screened
from sylvan.operators.forest import ForestParams, fit_forest

FEATS = ["strong", "weak", "few", "gaps", "same"]


def _frame(spark, n=3000, seed=5):
    rng = np.random.default_rng(seed)
    d = pd.DataFrame({"row_key": np.arange(n), "strong": rng.normal(size=n), "weak": rng.normal(size=n),
                      "few": rng.integers(0, 6, n).astype(float), "gaps": rng.normal(size=n), "same": 3.0})
    d["y"] = 100 * d["strong"] + 30 * d["few"] + 5 * rng.normal(size=n)
    d.loc[d["row_key"] % 5 == 0, "gaps"] = None
    return spark.createDataFrame(d)


@pytest.mark.parametrize("cells, buckets", [(16, 3), (200, 64), (1 << 17, 4096)])
def test_trees_do_not_depend_on_bins(spark, monkeypatch, cells, buckets):
    df = _frame(spark)
    base = dict(n_trees=3, max_depth=4, min_samples_leaf=3, max_features=3, seed=9)
    whole = fit_forest(df, FEATS, "y", ForestParams(**base)).nodes
    monkeypatch.setattr(screened, "CELLS", cells)
    monkeypatch.setattr(screened, "GROUP_ROWS", 300)
    got = fit_forest(df, FEATS, "y", ForestParams(**base, prefix_buckets=buckets)).nodes
    pd.testing.assert_frame_equal(whole, got, check_exact=True)


def test_large_and_small_nodes_together(spark, monkeypatch):
    df = _frame(spark)
    base = dict(n_trees=2, max_depth=5, seed=4)
    whole = fit_forest(df, FEATS, "y", ForestParams(**base)).nodes
    monkeypatch.setattr(forest, "SMALL_NODE", 400)
    got = fit_forest(df, FEATS, "y", ForestParams(**base, bucket_rows=1000)).nodes
    pd.testing.assert_frame_equal(whole, got, check_exact=True)


def test_rows_already_spread_are_not_dealt_again(spark, monkeypatch):
    df = _frame(spark).repartition(12)
    base = dict(n_trees=2, max_depth=3, seed=4)
    whole = fit_forest(df, FEATS, "y", ForestParams(**base)).nodes
    monkeypatch.setattr(forest, "SPREAD_ROWS", 1)
    pd.testing.assert_frame_equal(whole, fit_forest(df, FEATS, "y", ForestParams(**base)).nodes, check_exact=True)
    cached = df.select("row_key").persist()
    assert forest._spread(cached, 4, 3000) and not forest._spread(cached, 400, 3000)
    lopsided = df.where("row_key < 2900").coalesce(1).union(df.where("row_key >= 2900").repartition(11)).persist()
    assert not forest._spread(lopsided, 12, 3000)


def test_few_values_are_shipped(spark, monkeypatch):
    """The root's best cut of a strong feature: nearly all of 20,000 distinct values stay where they are."""
    n = 20_000
    rng = np.random.default_rng(1)
    d = pd.DataFrame({"row_key": np.arange(n), "a": rng.normal(size=n)})
    d["y"] = d["a"] + 0.1 * rng.normal(size=n)
    params = ForestParams(n_trees=1, max_features=None, bootstrap=False, prefix_buckets=1000)
    with forest.training_state(spark.createDataFrame(d), ["a"], "y", params, "row_key") as ready:
        (_, weight, total, squares, room), = levels.tree_sums(ready.state, 1)
        trees = forest._Trees(1)
        front = trees.frontier([0], [(0, trees.add(0), [0], weight, total / weight, squares - total ** 2 / weight, 1, room)],
                               1, 0)
        shared = spark.sparkContext.broadcast(front)
        shipped = []
        merge = screened._may_hold
        monkeypatch.setattr(screened, "_may_hold", lambda fr, b, *a: shipped.append(
            int(b.own[merge(fr, b, *a), 0].sum())) or merge(fr, b, *a))
        got = screened.best_splits(ready.state, shared, 1, 1, 1.0, ready.buckets)
        want = levels.best_splits(ready.state, shared, 1, 1, 1.0).first()
    assert got == [(0, False, (0, want["threshold"], want["lw"], want["ls"], want["lq"]))]
    assert 0 < shipped[0] < n / 5

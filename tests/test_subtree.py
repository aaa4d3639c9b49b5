"""Lower parts of the trees: grown in groups, the same nodes as level by level, with few passes over the table."""

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from sylvan.functions import hashing
from sylvan.operators import forest, subtree
from sylvan.operators.forest import ForestParams, fit_forest

FEATS = ["fine", "few", "gaps", "same"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(2)
    n = 12_000
    d = pd.DataFrame({"fine": rng.normal(size=n), "few": rng.integers(0, 5, n) / 3, "gaps": np.round(rng.normal(size=n), 2),
                      "same": 1.0, "row_key": np.arange(n)})
    d.loc[::7, "gaps"] = None
    d["y"] = 1e6 + 3 * d["fine"] + d["few"] * np.sin(5 * d["fine"]) + rng.standard_t(2, n)
    return spark.createDataFrame(d).repartition(6)


@pytest.mark.parametrize("settings", [dict(n_trees=16, max_depth=9, min_samples_leaf=3, max_features=2),
                                      dict(n_trees=2, min_samples_leaf=25, max_broadcast_nodes=20),
                                      dict(n_trees=1, max_depth=5, bootstrap=False, max_features=None)])
def test_same_nodes_with_few_passes(rows, monkeypatch, settings):
    passes = []
    search = forest._search_level
    monkeypatch.setattr(forest, "_search_level", lambda *a: passes.append(1) or search(*a))
    got = fit_forest(rows, FEATS, "y", ForestParams(seed=3, **settings))
    grouped = len(passes)
    monkeypatch.setattr(forest, "GROUPED_FROM", 1 << 40)
    want = fit_forest(rows, FEATS, "y", ForestParams(seed=3, **settings))
    pd.testing.assert_frame_equal(want.nodes, got.nodes, check_exact=True)
    assert want.importances == got.importances
    if settings["n_trees"] > 10:       # the upper part ends where nodes have a share of all rows
        assert grouped <= 6 and len(passes) - grouped == 9


def test_keys_beyond_one_number(monkeypatch):
    """Nodes, ranks and rows that do not fit 63 bits together are sorted in two numbers."""
    rng = np.random.default_rng(1)
    rank, at = rng.integers(-1, 50, 400).astype(np.int32), rng.integers(0, 3, 400)
    terms = [rng.integers(1, 4, 400) for _ in range(3)]
    n = np.array([float(terms[0][at == k].sum()) for k in range(3)])
    more = (np.arange(3) * 0, terms, (None, np.ones(3), np.ones(3)), n, n * 10, 2.0, np.arange(51.0), np.array([0, 50]))
    want = subtree._best_cuts(rank, at, *more)
    wide = rank.astype(np.int64)
    wide[wide == wide.max()] = 1 << 55                 # a rank of 56 bits: the same order
    values = {int(v): float(v) for v in np.unique(rank)}
    values[1 << 55] = float(rank.max())

    class Values(np.ndarray):
        def __getitem__(self, i):
            return np.array([values[int(k)] for k in i]) if isinstance(i, np.ndarray) else super().__getitem__(i)
    got = subtree._best_cuts(wide, at, *more[:-2], np.zeros(1).view(Values), more[-1])
    np.testing.assert_array_equal(want[:5], got[:5])


def test_hashes_of_a_batch():
    starts = [f"{k}|42" for k in range(1000)] + ["42", "é" * 9, "", "x" * 60] * 300
    ends = [f"|{t}".encode() for t in (0, 7, 10, 123)]
    want = [[int(hashlib.md5(s.encode() + e).hexdigest()[:8], 16) for s in starts] for e in ends]
    assert hashing.hash_numbers(pa.array(["-", *starts])[1:], ends).tolist() == want
    assert hashing.hash_numbers(pa.array([], pa.string()), ends).shape == (4, 0)


def test_screened_levels_end_where_groups_begin(rows, monkeypatch):
    """A large table: few of a tree's levels are searched by passes over all rows."""
    calls = []
    real = forest.screened.best_splits
    monkeypatch.setattr(forest, "SMALL_NODE", 50)
    monkeypatch.setattr(forest.screened, "best_splits", lambda *a: calls.append(1) or real(*a))
    params = ForestParams(n_trees=16, max_depth=8, min_samples_leaf=3, max_features=2, seed=3)
    want = fit_forest(rows, FEATS, "y", params).nodes
    assert not calls
    got = fit_forest(rows, FEATS, "y", ForestParams(**{**params.as_dict(), "bucket_rows": 1000})).nodes
    pd.testing.assert_frame_equal(want, got, check_exact=True)
    assert 2 <= len(calls) <= 6


def test_medians_of_hot_and_spread_columns(spark):
    from sylvan.operators.ranking import column_medians
    rng = np.random.default_rng(4)
    n = 30_001                                         # beyond MEDIAN_ACCURACY: brackets come from the sketch
    d = pd.DataFrame({"spread": rng.standard_t(1, n), "hot": rng.integers(0, 3, n) * 1.0, "one": 7.0, "none": np.nan,
                      "gaps": np.where(rng.random(n) < 0.5, np.nan, rng.normal(size=n))})
    got, want = column_medians(spark.createDataFrame(d).repartition(5), list(d.columns)), d.median()
    assert got.pop("none") is None and got == want.drop("none").to_dict()

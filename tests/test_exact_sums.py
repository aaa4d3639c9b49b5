"""Sums that do not depend on the order of their terms, and trees that do not depend on partitioning."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sylvan.operators import levels
from sylvan.operators.forest import ForestParams, fit_forest
from sylvan.operators.node_table import fit_node_table

FEATS = [f"x{i}" for i in range(4)]


def heavy_frame(spark, rows=1500, centre=0.0):
    rng = np.random.RandomState(5)
    x = rng.randn(rows, 4).round(2)
    y = centre + np.exp(2 * rng.randn(rows)) * np.sign(x[:, 0]) + x[:, 1] / 3       # heavy tails on both sides
    pdf = pd.DataFrame(x, columns=FEATS)
    pdf.loc[::17, "x2"] = np.nan
    return spark.createDataFrame(pdf.assign(y=y, row_key=np.arange(rows)))


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 12), st.floats(-1e9, 1e9).filter(lambda y: y == 0 or abs(y) > 1e-100)),
                min_size=1, max_size=200))
def test_whole_multiples_add_up_exactly(rows):
    w, y = (np.array(c, float) for c in zip(*rows))
    room = float((w * y * y).sum())
    us, uq = levels.quanta(w.sum(), room)
    for terms, unit, size in ((w * y, us, np.sqrt(w.sum() * room)), (w * y * y, uq, room)):
        v = levels.fixed(terms, unit)
        assert sum(abs(int(i)) for i in v) < 2 ** 62
        assert abs(int(v.sum()) * float(unit) - terms.sum()) <= len(v) * size * 2.0 ** -52


def test_quantum_edges():
    assert levels.quantum(0.0) == 1.0 and levels.fixed(np.zeros(1), levels.quantum(0.0))[0] == 0
    assert levels.quantum(1.0) == 2.0 ** -60
    assert levels.quantum(1e-320) > 0


@pytest.mark.parametrize("options", [{}, {"streamed": True, "stream_partitions": 6}, {"prefix_buckets": 5},
                                     {"splitter": "extra"}])
def test_trees_are_equal_to_the_bit(spark, options):
    df = heavy_frame(spark).persist()
    depth = 6 if options else 9
    params = dict(n_trees=3, max_depth=depth, min_samples_leaf=1, seed=8, **options)
    fits = [fit_forest(df.repartition(k), FEATS, "y", ForestParams(**params, state_partitions=k))
            for k in ((7, 40) if options else (1, 7, 40))]
    assert (fits[0].nodes.depth == depth).any()
    if "streamed" in options:       # the same splits as the search over collected sums
        fits.append(fit_forest(df, FEATS, "y", ForestParams(**{**params, "streamed": False})))
    for other in fits[1:]:
        assert other.y_mean == fits[0].y_mean
        pd.testing.assert_frame_equal(other.nodes, fits[0].nodes, check_exact=True)
    df.unpersist()


def test_node_table_equals_the_level_fit_to_the_bit(spark):
    df = heavy_frame(spark, centre=1e7)
    params = ForestParams(n_trees=1, min_samples_leaf=12, seed=4)
    whole = fit_forest(df, FEATS, "y", params).nodes
    for bound, k in ((200, 3), (5000, 9)):
        table = fit_node_table(df.repartition(k), FEATS, "y", params, local_rows=bound)
        pd.testing.assert_frame_equal(table.to_model().nodes.astype(whole.dtypes), whole, check_exact=True)


def test_exact_mean(spark):
    df = spark.createDataFrame(pd.DataFrame({"y": [1e16, 1.0, -1e16, 3.0]}))
    assert levels.exact_mean(df, "y")[0] == 4
    assert len({levels.exact_mean(heavy_frame(spark, 500, 1e5).repartition(k), "y") for k in (1, 5, 9)}) == 1
    assert levels.exact_mean(df.where("y < 0 and y > 0"), "y") == (0, 0.0)
    assert levels.exact_mean(spark.range(3).selectExpr("0D as y"), "y") == (3, 0.0)


def test_streamed_search_at_every_cut(spark):
    """Hot values, keys that span partitions, single rows: equal to the collected search."""
    rng = np.random.RandomState(2)
    x = rng.randn(400, 3)
    x[:, 0] = np.where(rng.rand(400) < 0.6, 0.25, x[:, 0])      # one value holds most rows
    x[:, 1] = 1.0                                               # a constant feature has no threshold
    y = x[:, 0] * 2 + x[:, 2] ** 2
    df = spark.createDataFrame(pd.DataFrame(x, columns=FEATS[:3]).assign(y=y, row_key=np.arange(400)))
    whole = None
    for partitions in (None, 1, 21):
        p = ForestParams(n_trees=2, max_depth=3, seed=1, max_features=None, min_samples_leaf=2,
                         streamed=partitions is not None, stream_partitions=partitions, state_partitions=2)
        nodes = fit_forest(df, FEATS[:3], "y", p).nodes
        whole = nodes if whole is None else whole
        pd.testing.assert_frame_equal(nodes, whole, check_exact=True)


def test_streamed_search_refuses_what_it_does_not_do():
    for more in ({"max_bins": 8}, {"splitter": "random"}, {"prefix_buckets": 4}, {"stream_partitions": 0}):
        with pytest.raises(ValueError):
            ForestParams(streamed=True, **more).validate()


def test_bag_weights_equal_the_hash_rule(spark):
    from sylvan.operators import split
    keys = spark.createDataFrame([(1,), (None,), (10 ** 12,)], "row_key long")
    rule = {(r["row_key"], r["tree_id"]): r["w"] for r in split.bootstrap_weights(keys, 30).collect()}
    for r in keys.select("row_key", split.bag_weight_array("row_key", 42, 30).alias("w"), split.bag_weight_array(
            "row_key", 42, 30, tree_mask=lambda t: F.when(t < 10, 0).otherwise(1)).alias("m")).collect():
        assert r["w"] == [rule[r["row_key"], t] for t in range(30)] and r["m"] == [0] * 10 + r["w"][10:]

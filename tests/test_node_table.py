"""Trees as a distributed node table: the same nodes as the level-wise fit, few of them on the driver."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sylvan.operators import model_store as MS, node_table as NT, score as SC
from sylvan.operators.forest import ForestParams, fit_forest

FEATS = [f"x{i}" for i in range(4)]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(900, 4)), 2)               # many equal values
    y = np.round(3 * x[:, 0] + np.sin(5 * x[:, 1]) + rng.normal(size=900), 3)
    pdf = pd.DataFrame(x, columns=FEATS)
    pdf["y"], pdf["row_key"] = y, np.arange(900)
    pdf.loc[::13, "x1"] = np.nan
    pdf.loc[::29, "x2"] = np.inf
    return spark.createDataFrame(pdf).repartition(5)


def frame(nodes):
    pdf = nodes.toPandas() if hasattr(nodes, "toPandas") else nodes.copy()
    pdf = pdf.sort_values(["tree_id", "node_id"]).reset_index(drop=True)
    return pdf.astype({c: "float64" for c in pdf.columns if c != "is_leaf"})


@pytest.mark.parametrize("local_rows", [1, 30, 300, 10_000])
@pytest.mark.parametrize("settings", [dict(n_trees=2, min_samples_leaf=3), dict(n_trees=3, max_depth=5, min_samples_split=9),
                                      dict(n_trees=1, bootstrap=False, max_features=None, min_samples_leaf=10)])
def test_nodes_equal_those_of_the_level_wise_fit(rows, local_rows, settings):
    p = ForestParams(seed=7, **settings)
    if local_rows == 1 and p.max_depth is None and p.min_samples_leaf < 10:
        pytest.skip("one row a group is every level by itself")
    want, got = frame(fit_forest(rows, FEATS, "y", p).nodes), frame(NT.fit_node_table(rows, FEATS, "y", p, local_rows=local_rows).nodes)
    pd.testing.assert_frame_equal(got, want, rtol=1e-9, atol=1e-9)


def test_the_driver_grows_only_large_nodes(rows, monkeypatch):
    """An unlimited fit: what the driver holds doesn't follow the number of nodes."""
    seen = {}
    real = NT._grow

    def watch(*args):
        seen["top"], seen["paths"] = real(*args)
        return seen["top"], seen["paths"]
    monkeypatch.setattr(NT, "_grow", watch)
    table = NT.fit_node_table(rows, FEATS, "y", ForestParams(n_trees=2, seed=7), local_rows=200)
    total = table.nodes.count()
    assert total > 1000 and len(seen["top"]) < 60 and all(r["n"] > 200 or r["is_leaf"] for r in seen["top"])
    leaves = table.nodes.where("is_leaf").groupBy("tree_id").agg(F.sum("n").alias("n")).collect()
    roots = {r["tree_id"]: r["n"] for r in table.nodes.where("node_id = 1").collect()}
    assert {r["tree_id"]: r["n"] for r in leaves} == roots
    assert MS.tree_stats(table.nodes).count() == 2
    model = table.to_model()
    assert SC.predict(rows, model).count() == 900 and len(model.nodes) == total
    with pytest.raises(ValueError, match="above the bound"):
        table.to_model(max_nodes=10)


def test_edges(spark, rows):
    same = rows.withColumn("y", F.lit(2.5))
    table = NT.fit_node_table(same, FEATS, "y", ForestParams(n_trees=2, bootstrap=False), local_rows=100)
    assert [(r["node_id"], r["value"], r["mse"], r["is_leaf"]) for r in table.nodes.collect()] == [(1, 2.5, 0.0, True)] * 2
    nothing = rows.withColumn("x0", F.lit(None).cast("double")).select("row_key", "x0", "y")
    assert NT.fit_node_table(nothing, ["x0"], "y", ForestParams(n_trees=1), local_rows=50).nodes.count() == 1
    empty = NT.fit_node_table(rows.limit(0), FEATS, "y", ForestParams(n_trees=1))
    assert empty.nodes.count() == 1
    for bad in (dict(splitter="random"), dict(max_bins=8)):
        with pytest.raises(ValueError):
            NT.fit_node_table(rows, FEATS, "y", ForestParams(**bad))
    with pytest.raises(ValueError):
        NT.fit_node_table(rows, FEATS, "y", ForestParams(), local_rows=0)

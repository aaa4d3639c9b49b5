"""Work that several fits or passes share is done once."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from sylvan.operators import cv, forest, levels, protocol
from sylvan.operators.fitted_state import fit_state
from sylvan.operators.forest import ForestParams, fit_forest, fit_forests

FEATS = ["a", "b", "c"]


def _frame(spark, n=400):
    rng = np.random.default_rng(3)
    d = pd.DataFrame(rng.normal(size=(n, 3)), columns=FEATS)
    d["y"] = d["a"] + 0.5 * d["b"] * d["c"]
    d["row_key"] = np.arange(n)
    d.loc[d["row_key"] % 9 == 0, "b"] = None
    return spark.createDataFrame(d)


def test_grid_forests_share_rows_and_searches(spark, monkeypatch):
    df = _frame(spark)
    settings = [ForestParams(n_trees=2, max_depth=3, min_samples_split=s, min_samples_leaf=k, seed=8)
                for s, k in ((2, 5), (90, 5), (2, 40))]
    alone = [fit_forest(df, FEATS, "y", p).nodes for p in settings]
    calls = {"state": 0, "level": 0}

    def counted(name, of):
        def run(*a, **k):
            calls[of] += 1
            return old(*a, **k)
        old = getattr(forest, name)
        monkeypatch.setattr(forest, name, run)
    counted("training_state", "state"), counted("_search_level", "level")
    for one, model in zip(alone, fit_forests(df, FEATS, "y", settings)):
        pd.testing.assert_frame_equal(one, model.nodes, check_exact=True)
    assert calls == {"state": 1, "level": 6}          # the second forest's nodes are all known
    calls.update(state=0)
    cv.grid_search(df, df, FEATS, "y", {"n_trees": [2], "max_depth": [2], "min_samples_split": [2, 9],
                                        "min_samples_leaf": [5, 9]})
    assert calls["state"] == 1


def test_splitters_get_only_values_their_nodes_may_use(spark):
    seen = []

    class Look(protocol.Splitter):
        def best_splits(self, level):
            long = level.long()
            assert "Generate" not in long._jdf.queryExecution().toString()       # no rows made to be dropped
            tall = (level.rows.select("slot", "w", "yc", F.posexplode("x").alias("feature", "v")).where("v is not null")
                    .join(level.nodes.select("slot", F.explode("features").alias("feature")), ["slot", "feature"]))
            cols = ["slot", "feature", "w", "yc", "v"]
            seen.append((long.select(cols).exceptAll(tall.select(cols)).count(),
                         tall.select(cols).exceptAll(long.select(cols)).count(), long.count()))
            return long.groupBy("slot").agg(F.min("feature").alias("feature"), F.lit(0.0).alias("threshold"))
    fit_forest(_frame(spark), FEATS, "y", ForestParams(n_trees=2, max_depth=2, max_features=2, splitter=Look()))
    assert [s[:2] for s in seen] == [(0, 0)] * 2 and all(s[2] > 0 for s in seen)


def test_rows_are_read_once_to_fit_a_state(spark):
    reads = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def slow(v):
        reads.add(1)
        return v
    df = _frame(spark).select("row_key", slow("a").alias("a"), F.when(F.col("row_key") % 2 == 0, "x").otherwise("z").alias("s"))
    state = fit_state(df, ["a"], ["s"])
    assert [r[0] for r in state.encoders.orderBy("code").select("class").collect()] == ["x", "z"]
    assert reads.value == 400

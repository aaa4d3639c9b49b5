"""Splitters and estimators from outside; the store under repeated and failed saves; column names."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sylvan.api import ForestRegressor
from sylvan.operators import cv, model_store as MS, score as SC
from sylvan.operators.forest import ForestParams, fit_forest
from sylvan.operators.protocol import Estimator, Splitter
from sylvan.operators.split import kfold
from sylvan.session import scratch_path

FEATS = [f"x{i}" for i in range(5)]


class Midrange:
    """The feature of the widest range, cut in its middle."""

    def best_splits(self, level):
        wide = F.struct((F.col("vmax") - F.col("vmin")).alias("wide"), (-F.col("feature")).alias("f"),
                        ((F.col("vmin") + F.col("vmax")) / 2).alias("mid"))
        best = level.ranges.groupBy("slot").agg(F.max(wide).alias("b"))
        return best.where("b.wide > 0").select("slot", (-F.col("b.f")).alias("feature"), F.col("b.mid").alias("threshold"))


def grow(x, y, depth, least):
    """The same tree in plain code: (depth, feature, threshold, n, mean) per node in id order."""
    out = {}

    def node(rows, i, d):
        out[i] = (d, None, None, len(rows), y[rows].mean())
        if d == depth or len(rows) < 2 * least or np.ptp(y[rows]) == 0:
            return
        wide = np.ptp(x[rows], axis=0)
        f = int(np.argmax(wide))
        t = (x[rows, f].min() + x[rows, f].max()) / 2
        left = x[rows, f] <= t
        if min(left.sum(), (~left).sum()) < least:
            return
        out[i] = (d, f, t, len(rows), y[rows].mean())
        node(rows[left], 2 * i, d + 1)
        node(rows[~left], 2 * i + 1, d + 1)
    node(np.arange(len(y)), 1, 0)
    return out


def test_splitter_from_outside_grows_its_tree(spark, sample_regression):
    train, _, pdf = sample_regression
    assert isinstance(Midrange(), Splitter)
    p = ForestParams(n_trees=1, max_depth=5, min_samples_leaf=3, max_features=None, bootstrap=False, splitter=Midrange())
    model = fit_forest(train, FEATS, "y", p)
    want = grow(pdf[FEATS].to_numpy()[:80], pdf["y"].to_numpy()[:80], 5, 3)
    got = {int(r.node_id): r for r in model.nodes.itertuples()}
    assert got.keys() == want.keys() and len(got) > 9
    for i, (depth, f, t, n, mean) in want.items():
        r = got[i]
        assert (r.depth, r.n) == (depth, n) and r.value == pytest.approx(mean)
        assert pd.isna(r.feature) if f is None else (r.feature == f and r.threshold == pytest.approx(t))
    # small broadcasts and several trees change nothing; the stored model says whose splits it holds
    many = fit_forest(train, FEATS, "y", ForestParams(**{**p.as_dict(), "n_trees": 3, "max_broadcast_nodes": 1}))
    assert all(len(many.nodes[many.nodes.tree_id == t]) == len(got) for t in range(3))
    store = scratch_path(spark, "outside")
    MS.save_model(spark, model, store)
    assert MS.load_model(spark, store, model.model_id).params.splitter == "Midrange"


@pytest.mark.parametrize("answer, problem", [
    (lambda level: level.ranges.select("slot", "feature"), "no column threshold"),
    (lambda level: level.ranges.select("slot", "feature", F.col("vmin").alias("threshold")), "more than one split"),
    (lambda level: level.nodes.select("slot", F.lit(99).alias("feature"), F.lit(0.0).alias("threshold")), "there is none")])
def test_wrong_answers_are_refused(sample_regression, answer, problem):
    class Wrong:
        def best_splits(self, level):
            return answer(level)
    with pytest.raises(ValueError, match=problem):
        fit_forest(sample_regression[0], FEATS, "y", ForestParams(n_trees=1, max_depth=2, max_features=None, splitter=Wrong()))


def test_no_split_gives_leaves_and_unknown_splitters_are_refused(sample_regression):
    class Never:
        def best_splits(self, level):
            return level.ranges.select("slot", "feature", F.lit(None).cast("double").alias("threshold"))
    model = fit_forest(sample_regression[0], FEATS, "y", ForestParams(n_trees=2, max_depth=4, splitter=Never()))
    assert len(model.nodes) == 2 and model.nodes.is_leaf.all()
    for bad in ("worst", object()):
        with pytest.raises(ValueError, match="splitter"):
            fit_forest(sample_regression[0], FEATS, "y", ForestParams(splitter=bad))


class GroupMean:
    """Predicts the training mean of rows on the same side of 0 in the first feature."""

    def fit(self, df, feature_cols, target):
        side = (F.col(feature_cols[0]) > 0).alias("side")
        self.first, self.means = feature_cols[0], {r["side"]: r["m"] for r in df.groupBy(side).agg(F.avg(target).alias("m")).collect()}
        return self

    def predict(self, df):
        return df.withColumn("prediction", F.when(F.col(self.first) > 0, self.means[True]).otherwise(self.means[False]))


def test_estimator_from_outside_is_cross_validated(spark, sample_regression):
    train, _, _ = sample_regression
    train = train.withColumn("fold", F.lit(77))                     # a column of the caller's
    assert isinstance(GroupMean(), Estimator) and isinstance(ForestRegressor(), Estimator)
    got = {(r["fold"], r["metric"]): r["value"] for r in cv.cross_validate(train, FEATS, "y", GroupMean(), k=4).collect()}
    pdf = kfold(train.drop("fold"), "row_key", 4).toPandas()
    for i in range(4):
        rest, own = pdf[pdf.fold != i], pdf[pdf.fold == i]
        means = rest.groupby(rest.x0 > 0).y.mean()
        error = own.y - (own.x0 > 0).map(means)
        assert got[i, "rmse"] == pytest.approx(np.sqrt((error ** 2).mean()))
        assert got[i, "mae"] == pytest.approx(error.abs().mean())
    forest = cv.cross_validate(train, FEATS, "y", ForestRegressor(2, 2), k=2)
    assert forest.count() == 6
    with pytest.raises(ValueError, match="no fit"):
        cv.cross_validate(train, FEATS, "y", object())


def test_saving_again_replaces_and_a_failed_save_is_not_seen(spark, sample_regression, monkeypatch):
    train, test, _ = sample_regression
    small, large = (fit_forest(train, FEATS, "y", ForestParams(n_trees=n, max_depth=3)) for n in (2, 3))
    large.model_id = small.model_id
    store = scratch_path(spark, "twice")
    for _ in range(2):
        MS.save_model(spark, small, store)
    assert len(MS.load_model(spark, store, small.model_id).nodes) == len(small.nodes)
    inventory = MS.list_models(spark, store).collect()
    assert len(inventory) == 1 and inventory[0]["total_nodes"] == len(small.nodes)
    with monkeypatch.context() as m:                               # the save ends before its commit
        m.setattr(MS, "tree_stats", lambda nodes: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            MS.save_model(spark, large, store)
    assert len(MS.load_model(spark, store, small.model_id).nodes) == len(small.nodes)
    reader = MS.load_model(spark, store, small.model_id)           # read before, used after the next save
    MS.save_model(spark, large, store)
    assert MS.load_model(spark, store, small.model_id).n_trees == 3 and SC.predict(test, reader).count() == 20
    with pytest.raises(KeyError):
        MS.load_model(spark, store, "nothing")


def test_scoring_leaves_the_callers_columns(sample_regression):
    train, test, _ = sample_regression
    model = fit_forest(train, FEATS, "y", ForestParams(n_trees=3, max_depth=3))
    own = test.withColumns({"_x": F.lit("mine"), "_w": F.lit(5), "prediction": F.lit("old"), "_y": F.lit(1)})
    got = SC.predict(own, model, uncertainty=True, oob=True)
    assert got.columns.count("prediction") == 1 and {"_x", "_w", "_y"} <= set(got.columns)
    rows, plain = (d.orderBy("row_key").collect() for d in (got, SC.predict(test, model)))
    assert [r["prediction"] for r in rows] == [r["prediction"] for r in plain]
    assert all((r["_x"], r["_w"]) == ("mine", 5) for r in rows)
    chunked = SC.predict(own, model, max_model_nodes=int(model.nodes.groupby("tree_id").size().max()))
    assert {"_x", "_w"} <= set(chunked.columns) and chunked.count() == 20
    renamed = [d.withColumnRenamed("x0", "_y") for d in (train, test)]
    assert cv.grid_search(*renamed, ["_y", *FEATS[1:]], "y", {"n_trees": [2], "max_depth": [2], "min_samples_split": [2],
                                                             "min_samples_leaf": [1]}).count() == 1


def test_null_and_repeated_keys_spread_over_the_state(spark, sample_regression):
    train, _, _ = sample_regression
    nothing = train.withColumn("row_key", F.lit(None).cast("long"))
    model = fit_forest(nothing, FEATS, "y", ForestParams(n_trees=1, max_depth=3, bootstrap=False, max_features=None))
    same = fit_forest(train, FEATS, "y", ForestParams(n_trees=1, max_depth=3, bootstrap=False, max_features=None))
    pd.testing.assert_frame_equal(model.nodes, same.nodes)

"""Models as plain tables.

A model is a ``nodes`` table (one row per node) and a one-row commit record
with its metadata, parquet under one store folder -- no pickles.  Node-table
operators (importances, depth/leaf statistics, rules) are joins and
aggregations over that table.
"""

from __future__ import annotations

import json
import time
import uuid
from datetime import datetime

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sylvan.operators.forest import NODE_SCHEMA, ForestModel, ForestParams
from sylvan.operators.protocol import splitter_name


# ---- T15 / T16: importances ------------------------------------------------

def node_importance(nodes: DataFrame) -> DataFrame:
    """Per internal node n*mse - (n_left*mse_left + n_right*mse_right),
    via a self-join of the node table on the child ids."""
    ch = nodes.select("tree_id", F.col("node_id").alias("cid"), F.col("n").alias("cn"),
                      F.col("mse").alias("cm"))
    inner = nodes.where(~F.col("is_leaf"))
    j = (inner.join(ch.withColumnRenamed("cid", "left_id").withColumnRenamed("cn", "ln")
                      .withColumnRenamed("cm", "lm"), ["tree_id", "left_id"], "left")
              .join(ch.withColumnRenamed("cid", "right_id").withColumnRenamed("cn", "rn")
                      .withColumnRenamed("cm", "rm"), ["tree_id", "right_id"], "left"))
    gain = (F.col("n") * F.col("mse")
            - (F.coalesce(F.col("ln") * F.col("lm"), F.lit(0.0))
               + F.coalesce(F.col("rn") * F.col("rm"), F.lit(0.0))))
    return j.select("tree_id", "node_id", "feature",
                    F.when(F.col("n") > 0, gain).otherwise(F.lit(0.0)).alias("gain"))


def tree_importances(nodes: DataFrame, n_features: int) -> DataFrame:
    """T16 (tree): (tree_id, feature, importance) normalised per tree to
    sum 1 (all zeros when the tree has no positive gain)."""
    trees = nodes.select("tree_id").distinct()
    feats = trees.select("tree_id", F.explode(F.sequence(F.lit(0), F.lit(n_features - 1))).alias("feature"))
    g = node_importance(nodes).groupBy("tree_id", "feature").agg(F.sum("gain").alias("raw"))
    full = feats.join(g, ["tree_id", "feature"], "left").fillna(0.0, ["raw"])
    tot = F.sum("raw").over(Window.partitionBy("tree_id"))
    return full.select("tree_id", "feature",
                       F.when(tot > 0, F.col("raw") / tot).otherwise(F.col("raw")).alias("importance"))


def forest_importances(nodes: DataFrame, n_features: int) -> DataFrame:
    """T16 (forest): mean of the tree importances, renormalised."""
    ti = tree_importances(nodes, n_features)
    avg = ti.groupBy("feature").agg((F.sum("importance")).alias("s"))
    tot = F.sum("s").over(Window.partitionBy())
    return avg.select("feature", F.when(tot > 0, F.col("s") / tot).otherwise(F.lit(0.0))
                      .alias("importance"))


def forest_importances_local(model: ForestModel) -> list:
    """Same numbers on the driver's copy of the node table (model-sized)."""
    nd = model.nodes
    nf = model.n_features
    if len(nd) == 0:
        return [0.0] * nf
    nd = nd.sort_values(["tree_id", "node_id"])
    tree, node = nd["tree_id"].to_numpy(np.int64), nd["node_id"].to_numpy(np.int64)
    weight = nd["n"].to_numpy(float) * nd["mse"].to_numpy(float)
    inner = ~nd["is_leaf"].to_numpy(bool)
    total = np.zeros(nf)
    for t in np.unique(tree):
        mine = tree == t
        own, up = weight[mine], inner[mine]
        left, right = (own[np.searchsorted(node[mine], nd[c].to_numpy(np.int64, na_value=0)[mine][up])]
                       for c in ("left_id", "right_id"))
        imp = np.bincount(nd["feature"].to_numpy(np.int64, na_value=0)[mine][up],
                          own[up] - (left + right), nf)
        s = imp.sum()
        total += imp / s if s > 0 else imp
    total /= max(model.n_trees, 1)
    s = total.sum()
    return list(total / s) if s > 0 else list(total)


def named_importances(importances: DataFrame, feature_names) -> DataFrame:
    """K2: attach feature names (positional)."""
    names = importances.sparkSession.createDataFrame(
        [(i, n) for i, n in enumerate(feature_names)], "feature int, feature_name string")
    return importances.join(F.broadcast(names), "feature", "left")


def top_features(importances: DataFrame, k: int = 5) -> DataFrame:
    """K1: the k most important features, ties broken by feature id
    (a top-k report: the limit is the feature)."""
    return importances.orderBy(F.desc("importance"), F.asc("feature")).limit(k)


# ---- T18 / T19 / T20 --------------------------------------------------------

def tree_stats(nodes: DataFrame) -> DataFrame:
    """T18 per tree: depth (a lone root has depth 0), leaves, nodes."""
    return nodes.groupBy("tree_id").agg(
        F.max("depth").alias("depth"),
        F.count_if(F.col("is_leaf")).alias("n_leaves"),
        F.count(F.lit(1)).alias("n_nodes"))


def forest_stats(nodes: DataFrame) -> DataFrame:
    """T18 forest: average depth and leaves, approximate total nodes as
    sum(2 * leaves - 1) (exact for binary trees)."""
    ts = tree_stats(nodes)
    return ts.agg(F.count(F.lit(1)).alias("n_trees"),
                  F.avg("depth").alias("avg_depth"), F.avg("n_leaves").alias("avg_leaves"),
                  F.max("depth").alias("max_depth"),
                  F.sum(2 * F.col("n_leaves") - 1).alias("total_nodes"))


def tree_rules(nodes: DataFrame, feature_names=None) -> DataFrame:
    """T19 re-aimed: one row per leaf with its path predicate.

    With heap ids the ancestors of a node are its id shifted right, and the
    bit shifted out says which side the path takes: each leaf lists its
    ancestors, one equi-join fetches their tests, one grouped collect (at
    most the depth) puts them in order.  The plan is the same at any depth.
    """
    names = list(feature_names or [])
    name = (F.element_at(F.array(*[F.lit(n) for n in names]), F.col("feature") + 1) if names
            else F.concat(F.lit("x"), F.col("feature").cast("string")))
    tests = nodes.where(~F.col("is_leaf")).select(
        "tree_id", F.col("node_id").alias("up"), name.alias("fn"),
        F.format_string("%.9f", F.col("threshold")).alias("ts"))
    leaves = nodes.where(F.col("is_leaf")).select("tree_id", "node_id", "depth", "n", "value")
    steps = leaves.where(F.col("depth") > 0).select(
        "tree_id", "node_id", "depth", F.explode(F.sequence(F.lit(1), F.col("depth"))).alias("k"))
    steps = steps.select("tree_id", "node_id", (F.col("depth") - F.col("k")).alias("at"),
                         F.expr("shiftright(node_id, k)").alias("up"),
                         (F.expr("shiftright(node_id, k - 1)") % 2 == 1).alias("right"))
    side = F.when(F.col("right"), F.lit(" > ")).otherwise(F.lit(" <= "))
    paths = (steps.join(tests, ["tree_id", "up"])
             .select("tree_id", "node_id", F.struct("at", F.concat("fn", side, "ts").alias("test")).alias("s"))
             .groupBy("tree_id", "node_id").agg(F.sort_array(F.collect_list("s")).alias("s"))
             .select("tree_id", "node_id", F.concat_ws(" AND ", F.col("s.test")).alias("rule")))
    return leaves.join(paths, ["tree_id", "node_id"], "left").select(
        "tree_id", "node_id", "depth", F.coalesce("rule", F.lit("TRUE")).alias("rule"), "n", "value")


def get_tree(model: ForestModel, tree_id: int) -> ForestModel:
    """One tree of the forest as a one-tree model."""
    if tree_id < 0 or tree_id >= model.n_trees:
        raise IndexError(f"the forest has {model.n_trees} trees; there is no tree {tree_id}")
    nd = model.nodes[model.nodes["tree_id"] == tree_id].copy()
    nd["tree_id"] = 0
    p = ForestParams(**{**model.params.as_dict(), "n_trees": 1})
    return ForestModel(params=p, feature_names=model.feature_names, nodes=nd.reset_index(drop=True),
                       n_samples=model.n_samples, y_mean=model.y_mean, model_id=model.model_id)


# ---- S8: save / load ---------------------------------------------------------
#
# A save writes everything of one version into folders of its own
# (``versions/<model>/<version>/nodes`` and ``state``) and then one row, with
# the metadata, into ``commits``.  Readers look for the newest commit first,
# so a save that failed, or one still going on, is never seen in part.

_COMMIT = ("model_id string, version string, created_at timestamp, params string, feature_names array<string>, "
           "n_features int, n_samples bigint, y_mean double, importances array<double>, oob_score double, "
           "training_score double, metadata string, n_trees bigint, avg_depth double, avg_leaves double, "
           "total_nodes bigint, has_state boolean")


def _version_folder(store: str, model_id: str, version: str) -> str:
    return f"{store}/versions/{model_id}/{version}"


def save_model(spark: SparkSession, model: ForestModel, store: str, metadata: dict | None = None,
               state=None) -> str:
    """Write a new version of the model: its nodes and the fitted preprocessing
    (``state``, see :mod:`sylvan.operators.fitted_state`), then the commit
    record.  Saving a model again replaces what readers see."""
    mid = model.model_id
    version = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    home = _version_folder(store, mid, version)
    model.nodes_df(spark).write.parquet(f"{home}/nodes")
    if state is not None:
        from sylvan.operators.fitted_state import save_state
        save_state(spark, f"{home}/state", state)
    size = tree_stats(model.nodes_df(spark)).agg(
        F.count(F.lit(1)), F.avg("depth"), F.avg("n_leaves"), F.sum(2 * F.col("n_leaves") - 1)).first()
    commit = (mid, version, datetime.now(), json.dumps(model.params.as_dict(), default=splitter_name), list(model.feature_names), model.n_features,
              int(model.n_samples), float(model.y_mean), [float(v) for v in (model.importances or [])],
              model.oob_score, model.training_score, json.dumps(metadata or {}), *size, state is not None)
    spark.createDataFrame([commit], _COMMIT).coalesce(1).write.mode("append").parquet(f"{store}/commits")
    return mid


def _commits(spark: SparkSession, store: str) -> DataFrame:
    """The newest commit of every model."""
    rows = spark.read.schema(_COMMIT).parquet(f"{store}/commits")
    newest = rows.groupBy("model_id").agg(F.max("version").alias("version"))
    return rows.join(newest, ["model_id", "version"], "left_semi")


def committed(spark: SparkSession, store: str, model_id: str):
    """The newest commit record of a model and its folder."""
    rows = (spark.read.schema(_COMMIT).parquet(f"{store}/commits").where(F.col("model_id") == model_id)
            .orderBy(F.desc("version")).limit(1).collect())
    if not rows:
        raise KeyError(f"model {model_id} not found")
    return rows[0], _version_folder(store, model_id, rows[0]["version"])


def load_model(spark: SparkSession, store: str, model_id: str) -> ForestModel:
    """Read a model's newest version back; the node table (model-sized) comes to the driver."""
    m, home = committed(spark, store, model_id)
    nd = spark.read.schema(NODE_SCHEMA).parquet(f"{home}/nodes").toPandas()
    nd = nd.astype({"feature": "Int64", "left_id": "Int64", "right_id": "Int64"})
    params = ForestParams(**json.loads(m["params"]))
    return ForestModel(params=params, feature_names=list(m["feature_names"]), nodes=nd,
                       n_samples=m["n_samples"], y_mean=m["y_mean"], model_id=model_id,
                       oob_score=m["oob_score"], training_score=m["training_score"],
                       importances=list(m["importances"] or []))


def list_models(spark: SparkSession, store: str) -> DataFrame:
    """Model inventory with tree counts and average depth/leaves."""
    return _commits(spark, store).select(
        "model_id", "created_at", "n_features", "n_samples", "n_trees", "avg_depth",
        "avg_leaves", "total_nodes", "oob_score", "training_score")

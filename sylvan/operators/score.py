"""Scoring with a fitted forest.

Rows stay in their partitions (no shuffle): ``mapInArrow`` walks each
Arrow batch through every tree with vectorised gathers; the flattened
model ships once per executor as a broadcast variable whose size is the
model's node count, checked against ``max_model_nodes``; a larger model
is scored in bounded tree groups chained as separate passes.  Mean and
population standard deviation over trees come from the same per-tree
matrix, so uncertainty costs no second prediction pass.
"""

from __future__ import annotations

import uuid
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sylvan.functions import traverse
from sylvan.functions.exprs import unused
from sylvan.operators.forest import ForestModel
from sylvan.operators.split import bag_weight_array
from sylvan.session import ship

MAX_MODEL_NODES = 50_000_000


def _model_broadcast(spark, model: ForestModel, max_model_nodes: int):
    if len(model.nodes) > max_model_nodes:
        raise ValueError(f"model has {len(model.nodes)} nodes, above the broadcast bound "
                         f"{max_model_nodes}")
    return spark.sparkContext.broadcast(model.flat_arrays())


def _tree_chunks(model: ForestModel, limit: int) -> list[list[int]]:
    """Consecutive tree groups of at most ``limit`` nodes each."""
    sizes = model.nodes.groupby("tree_id").size().reindex(range(model.n_trees), fill_value=0)
    chunks, cur, tot = [], [], 0
    for t, n in enumerate(sizes.to_numpy()):
        if n > limit:
            raise ValueError(f"tree {t} has {n} nodes, above the broadcast bound {limit}")
        if cur and tot + n > limit:
            chunks.append(cur)
            cur, tot = [], 0
        cur.append(t)
        tot += n
    if cur:
        chunks.append(cur)
    return chunks


def _sub_model(model: ForestModel, trees: list[int]) -> ForestModel:
    nd = model.nodes[model.nodes["tree_id"].isin(trees)].copy()
    nd["tree_id"] = nd["tree_id"] - trees[0]
    return ForestModel(params=model.params, feature_names=model.feature_names,
                       nodes=nd.reset_index(drop=True), n_samples=model.n_samples,
                       y_mean=model.y_mean, model_id=model.model_id)


def _predict_chunked(df: DataFrame, model: ForestModel, uncertainty: bool, per_tree: bool,
                     oob: bool, key: str, limit: int) -> DataFrame:
    """Scoring beyond one broadcast: tree groups of bounded size are applied
    as chained passes, each adding its trees' predictions; one projection
    combines them.  Rows still never move."""
    tag = uuid.uuid4().hex[:8]                 # no column of the caller has such a name
    d, arrays = df, []
    for i, trees in enumerate(_tree_chunks(model, limit)):
        arrays.append(f"_trees_{tag}_{i}")
        d = (predict(d, _sub_model(model, trees), per_tree=True, key=key, max_model_nodes=limit)
             .drop("prediction").withColumnRenamed("tree_predictions", arrays[-1]))
    every, nt = f"_every_{tag}", model.n_trees
    total = lambda col, f: F.aggregate(col, F.lit(0.0), lambda a, v: a + f(v))
    out = d.withColumn(every, F.concat(*arrays)).withColumn("prediction", total(every, lambda v: v) / nt)
    if uncertainty:       # squared deviations from the mean over all trees
        out = out.withColumn("uncertainty", F.sqrt(
            total(every, lambda v: (v - F.col("prediction")) * (v - F.col("prediction"))) / nt))
    if per_tree:
        out = out.withColumn("tree_predictions", F.col(every))
    if oob:
        left_out = F.filter(F.arrays_zip(F.col(every).alias("p"), bag_weight_array(
            key, model.params.seed, nt, model.params.bootstrap).alias("w")), lambda z: z["w"] == 0)
        out = (out.withColumn(every, left_out).withColumn("oob_count", F.size(every))
               .withColumn("oob_prediction", F.when(F.col("oob_count") > 0, total(
                   every, lambda z: z["p"]) / F.col("oob_count"))))
    return out.drop(every, *arrays)


def predict(df: DataFrame, model: ForestModel, uncertainty: bool = False,
            per_tree: bool = False, oob: bool = False, key: str = "row_key",
            max_model_nodes: int = MAX_MODEL_NODES, features_col: str | None = None) -> DataFrame:
    """T11 (+T12 with ``uncertainty``): adds ``prediction`` (mean over
    trees) and ``uncertainty`` (population std over trees).

    ``oob`` adds ``oob_prediction`` / ``oob_count`` (T14): the mean over
    the trees whose bootstrap sample left the row out, with the same
    hash weights as the fit (needs the fit's row key).  Features are
    read by name, in the model's order; a missing name raises.  All
    columns of ``df`` stay, but for those named like an added one, which
    are replaced.
    """
    missing = [c for c in model.feature_names if c not in df.columns] if not features_col else []
    if missing:
        raise ValueError(f"Expected features {model.feature_names}; missing {missing}")
    if len(model.nodes) > max_model_nodes and not features_col:
        return _predict_chunked(df, model, uncertainty, per_tree, oob, key, max_model_nodes)
    spark = df.sparkSession
    ship(spark)
    bc = _model_broadcast(spark, model, max_model_nodes)
    nf, nt = model.n_features, model.n_trees
    x = F.col(features_col) if features_col else F.array(*[F.col(c).cast("double")
                                                          for c in model.feature_names])
    x_name, w_name = unused(df, "_x", "_w")
    d = df.withColumn(x_name, x)
    if oob:
        seed = model.params.seed
        # the fit's bag weights (same hash rule)
        d = d.withColumn(w_name, bag_weight_array(key, seed, nt, model.params.bootstrap))
    extra = [T.StructField("prediction", T.DoubleType())]
    if uncertainty:
        extra.append(T.StructField("uncertainty", T.DoubleType()))
    if per_tree:
        extra.append(T.StructField("tree_predictions", T.ArrayType(T.DoubleType())))
    if oob:
        extra += [T.StructField("oob_prediction", T.DoubleType()),
                  T.StructField("oob_count", T.IntegerType())]
    d = d.drop(*(f.name for f in extra))
    schema = T.StructType(d.schema.fields + extra)
    arrow_extra = [pa.field(f.name, {"double": pa.float64(), "integer": pa.int32()}.get(
        f.dataType.typeName(), pa.list_(pa.float64()))) for f in extra]

    def fn(batches):
        fm = bc.value
        for rb in batches:
            xm = traverse.list_matrix(rb.column(x_name), nf, np.float64)
            p = traverse.predict_trees(xm, fm) if nt else np.zeros((len(xm), 0))
            mean = p.mean(axis=1) if nt else np.full(len(xm), np.nan)
            cols = list(rb.columns) + [pa.array(mean, pa.float64())]
            if uncertainty:
                cols.append(pa.array(p.std(axis=1), pa.float64()))
            if per_tree:
                cols.append(traverse.matrix_list(p, pa.float64()))
            if oob:
                wm = traverse.list_matrix(rb.column(w_name), nt, np.int32)
                out = wm == 0
                cnt = out.sum(axis=1)
                tot = np.where(out, p, 0.0).sum(axis=1)
                with np.errstate(invalid="ignore", divide="ignore"):
                    op = np.where(cnt > 0, tot / np.maximum(cnt, 1), np.nan)
                cols.append(pa.array(op, pa.float64(), mask=cnt == 0))
                cols.append(pa.array(cnt.astype(np.int32), pa.int32()))
            yield pa.RecordBatch.from_arrays(
                cols, schema=pa.schema(list(rb.schema) + arrow_extra))

    return d.mapInArrow(fn, schema).drop(x_name, *([w_name] if oob else []))


def predict_blocks(df: DataFrame, model: ForestModel, block: str, size: int, out: str = "prediction",
                   max_model_nodes: int = MAX_MODEL_NODES) -> DataFrame:
    """Each row scored by its own block of trees: the mean of the trees
    ``block * size`` to ``block * size + size - 1`` of the forest.

    A batch's rows are sorted by block and walk that block's trees only.  A
    null block, or one the forest does not have, gives a null prediction.
    """
    spark = df.sparkSession
    ship(spark)
    bc = _model_broadcast(spark, model, max_model_nodes)
    nf, blocks = model.n_features, model.n_trees // size
    x_name, b_name = unused(df, "_x", "_block")
    d = df.drop(out) if out not in (block, *model.feature_names) else df
    d = d.withColumns({x_name: F.array(*[F.col(c).cast("double") for c in model.feature_names]),
                       b_name: F.coalesce(F.col(block).cast("int"), F.lit(-1))})
    schema = T.StructType(d.schema.fields + [T.StructField(out, T.DoubleType())])

    def fn(batches):
        fm = bc.value
        for rb in batches:
            x = traverse.list_matrix(rb.column(x_name), nf, np.float64)
            own = rb.column(b_name).to_numpy(zero_copy_only=False)
            got = np.full(len(own), np.nan)
            for b in np.unique(own[(own >= 0) & (own < blocks)]):
                at = np.flatnonzero(own == b)
                some = slice(b * size, (b + 1) * size)
                trees = {**fm, "off": fm["off"][some], "depth": fm["depth"][some]}
                got[at] = traverse.predict_trees(x[at], trees).mean(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*rb.columns, pa.array(got, mask=(own < 0) | (own >= blocks))],
                schema=pa.schema([*rb.schema, pa.field(out, pa.float64())]))
    return d.mapInArrow(fn, schema).drop(x_name, b_name)


def predict_tree(df: DataFrame, model: ForestModel, tree_id: int, **kw) -> DataFrame:
    """Prediction of one tree (IndexError outside the forest)."""
    from sylvan.operators.model_store import get_tree
    return predict(df, get_tree(model, tree_id), **kw)


def z_value(confidence_level: float = 0.95) -> float:
    """z = inverse normal CDF at 1 - alpha/2 (computed on the driver)."""
    if not 0.0 < confidence_level < 1.0:
        raise ValueError("confidence_level must be in (0, 1)")
    return NormalDist().inv_cdf(1.0 - (1.0 - confidence_level) / 2.0)


def prediction_interval(df: DataFrame, pred: str = "prediction", std: str | None = "uncertainty",
                        confidence_level: float = 0.95) -> DataFrame:
    """``interval`` STRUCT<lower, upper> = pred -+ z * std.  Without a
    std column the population std of all predictions is used (one
    aggregation)."""
    z = z_value(confidence_level)
    if std is None:
        sd = df.agg(F.stddev_pop(pred)).first()[0] or 0.0
        margin = F.lit(z * sd)
    else:
        margin = F.lit(z) * F.col(std)
    return df.withColumn("interval", F.struct((F.col(pred) - margin).alias("lower"),
                                              (F.col(pred) + margin).alias("upper")))


def oob_score(df: DataFrame, model: ForestModel, target: str, key: str = "row_key"):
    """OOB R^2 over rows with at least one out-of-bag tree; None
    (with a warning) when no row has one.  Returns (score, coverage)."""
    import warnings

    from sylvan.operators.metrics import regression_metrics
    p = predict(df.select(key, target, *model.feature_names), model, oob=True, key=key)
    covered = p.where(F.col("oob_count") > 0)
    m = regression_metrics(covered, target, "oob_prediction", with_median=False).first()
    if m is None or not m["n"]:
        warnings.warn("every row is in every bag: there is nothing to score out of bag")
        return None, 0
    return m["r2_score"], m["n"]


def score(df: DataFrame, model: ForestModel, target: str) -> float:
    """R^2 of the model on a frame."""
    from sylvan.operators.metrics import regression_metrics
    p = predict(df, model)
    return regression_metrics(p, target, "prediction", with_median=False).first()["r2_score"]

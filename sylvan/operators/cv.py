"""Cross-validation (M18) and grid search (G1).

K-fold CV grows all folds in ONE level-wise fit: fold k owns trees
[k*T, (k+1)*T) and its rows get weight 0 in those trees, so every level
is a single pass for all folds; each row then walks the trees of its own
fold only.  Grid search grows one forest per
(min_samples_split, min_samples_leaf) pair at the largest depth and tree
count and scores smaller settings as tree prefixes and depth cuts --
exact, because every tree's randomness is a hash of (seed, tree, node).
These forests share one prepared state, and a node that two of them have is
searched once.
"""

from __future__ import annotations

import itertools

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sylvan.functions.exprs import unused
from sylvan.operators import metrics as M
from sylvan.operators import score as SC
from sylvan.operators.forest import ForestParams, fit_forest, fit_forests
from sylvan.operators.protocol import Estimator
from sylvan.operators.split import kfold


def cross_validate(df: DataFrame, feature_cols, target: str, params: ForestParams | Estimator, k: int = 5,
                   seed=42, key: str = "row_key", metrics=("r2_score", "rmse", "mae")) -> DataFrame:
    """(fold, metric, value) for K folds: one fit for all folds of a
    ``ForestParams``, one fit a fold of any other estimator."""
    if not isinstance(params, ForestParams):
        return _cross_validate_any(df, list(feature_cols), target, params, k, seed, key, metrics)
    t = params.n_trees
    d = kfold(df, key, k, seed, "fold")
    p = ForestParams(**{**params.as_dict(), "n_trees": t * k})
    model = fit_forest(d, feature_cols, target, p, key=key,
                       tree_mask=lambda tree: F.when((tree / t).cast("int") == F.col("fold"), 0)
                       .otherwise(1), mask_cols=["fold"])
    pred = SC.predict_blocks(d.select(key, target, "fold", *feature_cols), model, "fold", t)
    m = M.regression_metrics(pred, target, "prediction", ["fold"])
    return M.metrics_long(m, ["fold"], list(metrics))


def _cross_validate_any(df: DataFrame, feature_cols: list, target: str, estimator: Estimator, k: int, seed,
                        key: str, metrics) -> DataFrame:
    """Folds one after the other; each is predicted by a fit on all others."""
    if not isinstance(estimator, Estimator):
        raise ValueError(f"{type(estimator).__name__} has no fit method")
    (fold,) = unused(df, "fold")
    d = kfold(df, key, k, seed, fold)
    scored = None
    for i in range(k):
        fitted = estimator.fit(d.where(F.col(fold) != i).drop(fold), feature_cols, target)
        one = (fitted.predict(d.where(F.col(fold) == i).drop(fold))
               .select(F.lit(i).alias("fold"), F.col(target), "prediction"))
        scored = one if scored is None else scored.unionByName(one)
    return M.metrics_long(M.regression_metrics(scored, target, "prediction", ["fold"]), ["fold"], list(metrics))


def param_grid(spark: SparkSession, grid: dict) -> DataFrame:
    """G1 settings: the cross product of a few short parameter lists
    (built on the driver: it is parameter metadata, a handful of rows)."""
    names = list(grid)
    rows = [(i, *combo) for i, combo in enumerate(itertools.product(*[sorted(grid[n]) for n in names]))]
    ddl = "setting_id int, " + ", ".join(f"{n} int" for n in names)
    return spark.createDataFrame(rows, ddl)


def _prefix_scores(valid: DataFrame, model, target: str, counts, depths) -> list[tuple]:
    """(trees, depth, R^2) of every tree prefix and depth cut of a forest, in
    one job: one scoring pass per depth, all prefixes from its predictions."""
    y, *per_depth = unused(valid, "_y", *(f"_trees{depth}" for depth in depths))
    d = valid.withColumn(y, F.col(target).cast("double"))
    errors = []
    for depth, col in zip(depths, per_depth):
        d = (SC.predict(d, model.truncated(max(counts), depth), per_tree=True).drop("prediction")
             .withColumnRenamed("tree_predictions", col))
        for n in counts:
            p = F.aggregate(F.slice(col, 1, n), F.lit(0.0), lambda a, v: a + v) / n
            errors.append(F.avg((F.col(y) - p) * (F.col(y) - p)).alias(f"e{n}_{depth}"))
    row = d.agg(F.var_pop(y).alias("v"), *errors).first()

    def r2(mse: float) -> float:
        if row["v"] is not None and row["v"] > 0:
            return 1.0 - mse / row["v"]
        return 1.0 if mse == 0 else 0.0
    return [(n, depth, float(r2(row[f"e{n}_{depth}"]))) for depth in depths for n in counts]


def grid_search(train: DataFrame, valid: DataFrame, feature_cols, target: str, grid: dict,
                seed=42, key: str = "row_key", max_features="sqrt") -> DataFrame:
    """Validation R^2 of every setting, best first; one forest per (min_samples_split,
    min_samples_leaf) pair, all from one prepared state, and one scoring job per forest."""
    spark = train.sparkSession
    ntr, dep = max(grid["n_trees"]), max(grid["max_depth"])
    counts, depths = sorted(grid["n_trees"]), sorted(grid["max_depth"])
    valid = valid.select(key, target, *feature_cols).persist(StorageLevel.MEMORY_AND_DISK)
    results = []
    try:
        settings = [ForestParams(n_trees=ntr, max_depth=dep, min_samples_split=mss, min_samples_leaf=msl,
                                 max_features=max_features, seed=seed)
                    for mss, msl in itertools.product(sorted(grid["min_samples_split"]), sorted(grid["min_samples_leaf"]))]
        for big in fit_forests(train, feature_cols, target, settings, key=key):
            for n, d, r2 in _prefix_scores(valid, big, target, counts, depths):
                results.append((n, d, big.params.min_samples_split, big.params.min_samples_leaf, r2))
    finally:
        valid.unpersist()
    out = spark.createDataFrame(results, "n_trees int, max_depth int, min_samples_split int, "
                                         "min_samples_leaf int, r2_score double")
    return out.orderBy(F.desc("r2_score"), "n_trees", "max_depth", "min_samples_split", "min_samples_leaf")

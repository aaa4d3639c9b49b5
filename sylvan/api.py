"""Estimator-style facade over the operators.

``ForestRegressor`` keeps the familiar method names (fit / predict /
predict_proba / score / get_tree / feature_importances_ / oob_score_ /
save / load) but takes and returns Spark DataFrames; every call is a
distributed job from :mod:`sylvan.operators`.  ``TreeRegressor`` is a
single unbagged tree over all features.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sylvan.operators import model_store as MS
from sylvan.operators import score as SC
from sylvan.operators.forest import ForestModel, ForestParams, fit_forest


class ForestRegressor:
    def __init__(self, n_trees: int = 100, max_depth: int | None = None, min_samples_split: int = 2,
                 min_samples_leaf: int = 1, max_features="sqrt", bootstrap: bool = True,
                 oob_score: bool = False, random_state: int = 42, splitter: str = "best",
                 criterion: str = "mse", n_jobs: int | None = None, verbose: int = 0, **engine):
        # n_jobs is accepted for compatibility: Spark schedules the work
        if criterion != "mse":
            raise ValueError(f"criterion {criterion!r} is not offered")
        engine.setdefault("verbose", bool(verbose))
        self.params = ForestParams(n_trees=n_trees, max_depth=max_depth,
                                   min_samples_split=min_samples_split,
                                   min_samples_leaf=min_samples_leaf, max_features=max_features,
                                   bootstrap=bootstrap, oob_score=oob_score, seed=random_state,
                                   splitter=splitter, **engine).validate()
        self.model_: ForestModel | None = None
        self.key = "row_key"

    # -- fitting -----------------------------------------------------------
    def fit(self, df: DataFrame, feature_cols, target: str, key: str = "row_key") -> "ForestRegressor":
        self.key = key
        self.model_ = fit_forest(df, feature_cols, target, self.params, key=key)
        if self.params.oob_score:
            self.model_.oob_score, _ = SC.oob_score(df, self.model_, target, key)
        return self

    def _fitted(self) -> ForestModel:
        if self.model_ is None:
            raise ValueError("call fit on this estimator first")
        return self.model_

    # -- scoring -----------------------------------------------------------
    def predict(self, df: DataFrame) -> DataFrame:
        return SC.predict(df, self._fitted())

    def predict_proba(self, df: DataFrame) -> DataFrame:
        """Prediction plus population std over trees (``uncertainty``)."""
        return SC.predict(df, self._fitted(), uncertainty=True)

    def predict_interval(self, df: DataFrame, confidence_level: float = 0.95) -> DataFrame:
        return SC.prediction_interval(self.predict_proba(df), confidence_level=confidence_level)

    def score(self, df: DataFrame, target: str) -> float:
        return SC.score(df, self._fitted(), target)

    # -- inspection --------------------------------------------------------
    @property
    def feature_importances_(self) -> list:
        return list(self._fitted().importances or [])

    @property
    def oob_score_(self):
        return self._fitted().oob_score

    def nodes(self, spark: SparkSession) -> DataFrame:
        return self._fitted().nodes_df(spark)

    def get_tree(self, i: int) -> ForestModel:
        return MS.get_tree(self._fitted(), i)

    def get_depth(self, spark: SparkSession) -> DataFrame:
        return MS.tree_stats(self.nodes(spark))

    def tree_rules(self, spark: SparkSession) -> DataFrame:
        m = self._fitted()
        return MS.tree_rules(m.nodes_df(spark), m.feature_names)

    # -- persistence -------------------------------------------------------
    def save(self, spark: SparkSession, store: str, metadata: dict | None = None) -> str:
        return MS.save_model(spark, self._fitted(), store, metadata)

    @classmethod
    def load(cls, spark: SparkSession, store: str, model_id: str) -> "ForestRegressor":
        m = MS.load_model(spark, store, model_id)
        est = cls.__new__(cls)
        est.params, est.model_, est.key = m.params, m, "row_key"
        return est


class TreeRegressor(ForestRegressor):
    """One tree on all rows and all features (``max_features=None``)."""

    def __init__(self, max_depth: int | None = None, min_samples_split: int = 2,
                 min_samples_leaf: int = 1, max_features=None, splitter: str = "best",
                 random_state: int = 42, **engine):
        super().__init__(n_trees=1, max_depth=max_depth, min_samples_split=min_samples_split,
                         min_samples_leaf=min_samples_leaf, max_features=max_features,
                         bootstrap=False, random_state=random_state, splitter=splitter, **engine)

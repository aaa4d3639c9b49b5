"""Extension points: splitters and estimators written outside the library.

A splitter is any object with ``best_splits(level)``.  It is called once per
level and pass with a :class:`LevelRows` and returns a DataFrame ``(slot,
feature, threshold)`` with at most one row for an open node; rows whose
value is at most the threshold go left.  A node without a row becomes a
leaf, as does one whose split leaves too few rows on a side.  Child sums,
size limits, node ids and scoring stay with the library, so every model
operator works on the result.

An estimator is any object with ``fit(df, feature_cols, target)`` that
returns something with ``predict(df)``: the frame plus a column
``prediction``.  :func:`sylvan.operators.cv.cross_validate` takes either a
``ForestParams`` (all folds in one fit) or an estimator (one fit a fold).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property
from typing import Protocol, runtime_checkable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sylvan.operators import levels


@runtime_checkable
class Splitter(Protocol):
    def best_splits(self, level: "LevelRows") -> DataFrame: ...


@runtime_checkable
class Fitted(Protocol):
    def predict(self, df: DataFrame) -> DataFrame: ...


@runtime_checkable
class Estimator(Protocol):
    def fit(self, df: DataFrame, feature_cols: list, target: str) -> Fitted: ...


def splitter_name(splitter) -> str:
    """How a splitter is named in a stored model."""
    return splitter if isinstance(splitter, str) else type(splitter).__name__


@dataclass
class LevelRows:
    """What a splitter sees of the open nodes of one pass.

    ``rows``: ``slot, w, yc, x`` -- a training row in an open node with its
    bag weight, its target less the node's mean and its features (null:
    missing).  ``ranges``: ``slot, feature, vmin, vmax`` over the features a
    node may use.  ``nodes``: ``slot, tree_id, node_id, depth, n, sse,
    features`` (one row per open node).  All are lazy; grouping ``rows`` by
    slot keeps a node's rows spread until they are aggregated.
    """

    spark: SparkSession
    open_nodes: list = field(repr=False)
    state: DataFrame = field(repr=False)
    shared: object = field(repr=False)
    n_features: int
    n_trees: int
    depth: int
    min_samples_leaf: float
    seed: object

    @cached_property
    def rows(self) -> DataFrame:
        return levels.open_rows(self.state, self.shared, self.n_features, self.n_trees)

    @cached_property
    def ranges(self) -> DataFrame:
        return levels.value_ranges(self.state, self.shared, self.n_features, self.n_trees).where("feature >= 0")

    @cached_property
    def nodes(self) -> DataFrame:
        rows = [(slot, tree, node, self.depth, n, sse, list(subset))
                for slot, (tree, _place, subset, n, _mean, sse, node, _room) in enumerate(self.open_nodes)]
        return self.spark.createDataFrame(
            rows, "slot int, tree_id int, node_id long, depth int, n double, sse double, features array<int>")

    def long(self) -> DataFrame:
        """``slot, feature, v, w, yc``: a row per training row and feature its node may use, missing values left out."""
        return levels.open_values(self.state, self.shared, self.n_features, self.n_trees)


def chosen_splits(splitter: Splitter, level: LevelRows) -> dict[int, tuple[int, float]]:
    """The splitter's answer by slot, checked: one row at most a node, known slots and features."""
    answer = splitter.best_splits(level)
    missing = {"slot", "feature", "threshold"} - set(answer.columns)
    if missing:
        raise ValueError(f"{splitter_name(splitter)}.best_splits gives no column {', '.join(sorted(missing))}")
    # one row a node, or the check below fails: the driver takes one row too many at most
    limit = len(level.open_nodes) + 1
    rows = (answer.select(F.col("slot").cast("int"), F.col("feature").cast("int"), F.col("threshold").cast("double"))
            .where("feature is not null and threshold is not null").limit(limit).collect())
    out: dict[int, tuple[int, float]] = {}
    for slot, feature, threshold in rows:
        if slot in out:
            raise ValueError(f"{splitter_name(splitter)}.best_splits gives more than one split for slot {slot}")
        if not (0 <= slot < len(level.open_nodes) and 0 <= feature < level.n_features):
            raise ValueError(f"{splitter_name(splitter)}.best_splits names slot {slot}, feature {feature}: there is none")
        out[slot] = (feature, threshold)
    return out

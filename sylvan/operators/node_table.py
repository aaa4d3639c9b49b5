"""Unlimited trees as a distributed node table.

The upper part of all trees, the nodes of more than ``local_rows`` rows, is
grown level by level as in :mod:`sylvan.operators.forest`; the driver holds
only these, at most a few per ``local_rows`` rows and tree.  A node that fits
the bound leaves that loop: one Arrow pass routes its rows down the upper
trees and one shuffle brings them together, a node per group, where its
whole subtree is grown at once by the same rules (feature subsets by hash,
midpoints, size limits, ties).  Its nodes come out as rows of a table in the
shared folder and never meet the driver.

A group holds at most ``local_rows`` rows, for a bag weight is 1 or more
(:mod:`sylvan.operators.subtree`).  A lost executor's groups are routed again
from the state.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from sylvan.operators import subtree
from sylvan.operators.forest import NODE_SCHEMA, ForestModel, ForestParams, _grow, training_state
from sylvan.operators.split import resolve_max_features
from sylvan.session import scratch_path

@dataclass
class NodeTable:
    """A fitted forest whose nodes stay a table."""

    params: ForestParams
    feature_names: list
    nodes: DataFrame
    n_samples: int
    y_mean: float

    def to_model(self, max_nodes: int = 2_000_000) -> ForestModel:
        """The forest on the driver, if it has at most ``max_nodes`` nodes."""
        n = self.nodes.count()
        if n > max_nodes:
            raise ValueError(f"the forest has {n} nodes, above the bound {max_nodes}")
        pdf = self.nodes.toPandas().astype({"feature": "Int64", "left_id": "Int64", "right_id": "Int64"})
        pdf = pdf.sort_values(["tree_id", "node_id"]).reset_index(drop=True)
        return ForestModel(self.params, self.feature_names, pdf, self.n_samples, self.y_mean)


def fit_node_table(df: DataFrame, feature_cols, target: str, params: ForestParams | None = None,
                   key: str = "row_key", local_rows: int = 50_000) -> NodeTable:
    """As :func:`sylvan.operators.forest.fit_forest`, with nodes of at most ``local_rows``
    rows finished in groups and the nodes kept as a table.

    Exact thresholds of the splitter ``best``; ``max_bins`` and other splitters stay with ``fit_forest``.
    """
    params = (params or ForestParams()).validate()
    if params.splitter != "best" or params.max_bins is not None:
        raise ValueError("a node table is grown with exact thresholds of the splitter 'best'")
    if local_rows < 1:
        raise ValueError("local_rows must be positive")
    feature_cols, spark = list(feature_cols), df.sparkSession
    nf = len(feature_cols)
    m = resolve_max_features(params.max_features, nf)
    home = scratch_path(spark, "node-table")
    with training_state(df, feature_cols, target, params, key) as ready:
        def finish(front, some: list) -> str:
            path = f"{home}/from-{some[0][0]}"
            nodes, held = subtree.grown(ready.state, front, some, params, nf, m, ready.y_mean, NODE_SCHEMA)
            nodes.write.parquet(path)
            for b in held:
                b.destroy()
            return path
        top, paths = _grow(ready.state, params, nf, m, ready.y_mean, ready.buckets, ready.bin_edges, local_rows, finish)
    upper = [tuple(r[f.name] for f in NODE_SCHEMA.fields) for r in top]
    nodes = spark.createDataFrame(upper, NODE_SCHEMA)
    if paths:
        nodes = nodes.unionByName(spark.read.schema(NODE_SCHEMA).parquet(*paths))
    return NodeTable(params, feature_cols, nodes, ready.n_rows, ready.y_mean)

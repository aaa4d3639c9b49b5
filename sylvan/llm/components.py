"""Connected components of an edge table, by alternating star contraction.

Both steps are grouped minima and joins, so no neighbourhood is ever held
in one place; each round cuts its lineage through the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sylvan.llm.common import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's smallest neighbour."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (both.filter("v > u").join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Link every smaller neighbour of a node, and the node, to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``(u, root)`` for every node of ``edges(u, v)`` but the roots themselves.

    Nodes are longs; the root is the smallest node of the component.
    Loops and repeated edges are allowed; no edges give no rows.
    """
    stars = materialize(edges.filter("u <> v").select("u", "v").distinct())
    before = None
    while True:
        stars = materialize(_small_star(_large_star(stars)))
        now = tuple(stars.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            return stars.select("u", F.col("v").alias("root"))
        before = now

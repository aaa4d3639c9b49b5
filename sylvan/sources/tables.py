"""Named tables over a folder of parquet files (one file/folder per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sylvan.session import ship

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of one table; Catalyst prunes columns and pushes filters."""
    if name not in TABLES:
        raise KeyError(f"unknown table {name!r}")
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


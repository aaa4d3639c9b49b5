"""The corpus pipeline: documents through five stages, each a table.

Every stage takes ``(spark, docs, sf_dir)`` and returns the documents it
keeps (the last returns the packed pieces); each result is written as
Parquet and read again as the next stage's input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sylvan.llm import lines, packing, quality, simhash, tiling
from sylvan.llm.common import read
from sylvan.llm.queries import BYTE_IDS, BYTE_RANKS
from sylvan.session import scratch_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the rules or the forest reject."""
    return quality.quality_filter(docs, read(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut the lines found in ten or more documents out of every text."""
    return lines.line_dedup(docs, min_docs=10, min_chars=1, keep="none")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates."""
    return simhash.near_dedup(docs, shingle=3, max_bits=2)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that cover a benchmark item."""
    return tiling.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in sequences of 2048 tokens."""
    return packing.pieces(docs, BYTE_IDS, BYTE_RANKS, closing=1, size=2048)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("pack", pack),
]

#: No SQL for the forest, the fingerprints, the tiling and the tokenizer: tested against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

"""The registered queries of this package: thin derivations of the operators' results."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sylvan.llm import (audit, ftrl, langid, lines, packing, phrases, pii, quality, sharding, simhash, sql,
                        tiling, tokens, toxicity)
from sylvan.llm.common import read

BYTE_IDS = public_tokenizers.path("byte_bpe_50k.json")
BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_personal_data(spark: SparkSession, sf: str) -> DataFrame:
    """Personal data of every document: base spans and those the weak labelers add."""
    return pii.span_digest(pii.find_spans(read(spark, sf, "documents")))


def op2_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Rule statistics of every document and the verdict of rules and forest."""
    judged = quality.judge(read(spark, sf, "documents").select("doc_id", "text"), read(spark, sf, "labels"))
    return judged.select("doc_id", *(f"rules.{c}" for c in (*quality.COUNTS, "base_failed", "kept", "score")))


def op3_simhash(spark: SparkSession, sf: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(read(spark, sf, "documents"), shingle=3, max_bits=2)


def op4_language(spark: SparkSession, sf: str) -> DataFrame:
    """Predicted language of every document; one fifth is kept from learning."""
    got = langid.identify(read(spark, sf, "documents").select("doc_id", "text", "lang"))
    return got.select("doc_id", "held_out", "lang_pred", "score")


def op5_packing(spark: SparkSession, sf: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens."""
    return packing.pieces(read(spark, sf, "documents"), BYTE_IDS, BYTE_RANKS, closing=1, size=2048)


def op6_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's chain of categories: junk, then toxic."""
    docs, labels = read(spark, sf, "documents").select("doc_id", "text"), read(spark, sf, "labels")
    targets = labels.select("doc_id", (1 - F.col("quality")).alias("junk"), "toxic")
    got = toxicity.classify(docs, toxicity.fit(docs, targets, ["junk", "toxic"]))
    return got.select("doc_id", F.col("chain.p_junk").alias("p_junk"), F.col("chain.p_toxic").alias("p_toxic"),
                      F.col("chain.is_toxic").alias("toxic"))


def op7_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Lines dropped from every document and the checksum of what is left."""
    docs = read(spark, sf, "documents").select("doc_id", "text")
    cut = lines.apply_bitmaps(docs, lines.keep_bitmaps(docs, min_docs=10, min_chars=1, keep="none"))
    return cut.select("doc_id", "lines.n_lines", "lines.n_dropped", F.sha2("lines.text", 256).alias("kept_sha256"))


def op8_sharding(spark: SparkSession, sf: str) -> DataFrame:
    """Shard and slot of every document, and its shard among 17."""
    return sharding.shard_manifest(read(spark, sf, "documents"), 16)


def op9_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    """The documents that a benchmark item contaminates."""
    return tiling.contaminated(read(spark, sf, "documents"), read(spark, sf, "benchmark"))


def op10_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Bytes and tokens of every document."""
    got = tokens.count_tokens(read(spark, sf, "documents").select("doc_id", "text"), PIECES, limit=4096)
    return got.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op11_collocations(spark: SparkSession, sf: str) -> DataFrame:
    """Each language's 2000 strongest phrases of two to five words."""
    return phrases.collocations(read(spark, sf, "documents").select("text", "lang"), min_count=100, top=2000)


def op12_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's quality score; one quarter is kept from learning."""
    docs = read(spark, sf, "documents").select("doc_id", "text")
    got = ftrl.score(docs, ftrl.fit(docs, read(spark, sf, "labels")), "score")
    return got.select("doc_id", ftrl.held_out(F.col("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op13_filter_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Losses of five filters in all their orders, by source."""
    labels = read(spark, sf, "labels")
    return audit.audit(spark, f"{sf}/documents.parquet", labels)


QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "op1_personal_data": (op1_personal_data, None),
    "op2_quality_rules": (op2_quality_rules, None),
    "op3_simhash": (op3_simhash, None),
    "op4_language": (op4_language, None),
    "op5_packing": (op5_packing, None),
    "op6_toxicity": (op6_toxicity, None),
    "op7_line_dedup": (op7_line_dedup, sql.LINE_DEDUP),
    "op8_sharding": (op8_sharding, sql.SHARDING),
    "op9_decontamination": (op9_decontamination, None),
    "op10_token_counts": (op10_token_counts, None),
    "op11_collocations": (op11_collocations, sql.COLLOCATIONS),
    "op12_quality_classifier": (op12_quality_classifier, None),
    "op13_filter_audit": (op13_filter_audit, sql.FILTER_AUDIT),
}

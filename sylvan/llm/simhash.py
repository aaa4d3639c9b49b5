"""SimHash near-duplicates by pigeonhole blocks (operator 3).

A text is cut into words of ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased
and into shingles of ``shingle`` words; a fingerprint bit is 1 if it is
set in more than half of the shingles' XXH64 values (seed 42).  A text of
fewer words is one shingle; no word at all (null, empty) gives zero.

Fingerprints at ``max_bits`` or fewer differing bits are linked.  The 64
bits are split into ``max_bits + 2`` blocks: two close fingerprints agree
on at least two of them, so they meet in a join on some pair of blocks,
and the Hamming distance is then verified.  Equal fingerprints are merged
before, so copies cost nothing.  A block pair that many fingerprints share
is split again, exactly: the remaining bits, of which at most ``max_bits``
differ, are cut into finer blocks and joined on all but ``max_bits`` of
those, which bounds what meets there whatever the input.

Rows that repeat a doc_id are linked by their fingerprints like any
others; a null doc_id never names a component unless it has no other.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sylvan.llm.common import columns, fresh, materialize, quoted, utf8
from sylvan.llm.components import connected_components

#: Fingerprints that may meet in one block pair before it is split again.
CROWD = 64
_CHUNK = 1 << 15


def fingerprint(text: bytes, shingle: int = 3) -> int:
    words = text.lower().split()      # bytes: ASCII white space and ASCII case only
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(g, 42) for g in grams), np.uint64)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), _CHUNK):      # long texts in pieces: bounded memory
        bits = np.unpackbits(h[i:i + _CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(h), bitorder="little").tobytes(), "little")


def fingerprints(col: Column, shingle: int = 3) -> Column:
    """The fingerprint of a text column as a (signed) long."""
    @F.arrow_udf("long")
    def run(text: pa.Array) -> pa.Array:
        return pa.array(np.array([fingerprint(t, shingle) for t in text.to_pylist()], np.uint64)
                        .view(np.int64))
    return run(utf8(col))


def _bits(positions: range) -> int:
    mask = sum(1 << p for p in positions)
    return mask - (1 << 64) if mask >> 63 else mask


def _split(start: int, width: int, parts: int) -> list[int]:
    edges = [start + width * i // parts for i in range(parts + 1)]
    return [sum(1 << p for p in range(a, b)) for a, b in zip(edges, edges[1:])]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _pairs(rows: DataFrame, keys: list[str], max_bits: int) -> DataFrame:
    """Verified links among the fingerprints that share a key."""
    a = rows.select(*keys, F.col("fp").alias("u"))
    b = rows.select(*keys, F.col("fp").alias("v"))
    return (a.join(b, keys).filter("u < v")
            .filter(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_bits).select("u", "v"))


def links(fps: DataFrame, max_bits: int = 2, crowd: int = CROWD) -> DataFrame:
    """All pairs ``u < v`` of the distinct long ``fp`` values within ``max_bits`` bits."""
    if not 0 <= max_bits <= 4:
        raise ValueError("max_bits must lie between 0 and 4")
    n = max_bits + 2
    blocks = _split(0, 64, n)
    tables = [a | b for a, b in combinations(blocks, 2)]
    keyed = fps.select("fp", F.explode(F.array(*(
        F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("k"))
        for t, m in enumerate(tables)))).alias("b")).select("fp", "b.t", "b.k")
    crowds = keyed.groupBy("t", "k").agg(F.count("*").alias("n")).filter("n > 1")
    met = materialize(keyed.join(crowds, ["t", "k"]))
    plain = _pairs(met.filter(F.col("n") <= crowd), ["t", "k"], max_bits)
    # the bits outside the table's blocks, cut finer: at most max_bits of those blocks differ
    finer = []
    for t, m in enumerate(tables):
        rest = [p for p in range(64) if not m >> p & 1]
        parts = [sum(1 << p for p in rest[len(rest) * i // 8:len(rest) * (i + 1) // 8]) for i in range(8)]
        whole = (1 << 64) - 1
        masks = [whole & ~sum(left) for left in combinations(parts, max_bits)] if max_bits else [whole]
        finer.append(F.array(*(F.lit(_signed(x)) for x in masks)))
    masks = F.element_at(F.array(*finer), F.col("t") + 1)
    dense = (met.filter(F.col("n") > crowd).select("fp", "t", F.posexplode(masks).alias("s", "m"))
             .select("fp", "t", "s", F.col("fp").bitwiseAND(F.col("m")).alias("k")))
    return plain.union(_pairs(dense, ["t", "s", "k"], max_bits)).distinct()


def components(marked: DataFrame, max_bits: int = 2) -> DataFrame:
    """``(fp, component_id)`` for the rows ``(doc_id, fp)`` of ``marked``."""
    first = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("doc_id")))
    roots = connected_components(links(first.select("fp"), max_bits))
    joined = first.join(roots.withColumnRenamed("u", "fp"), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "doc_id")
    named = joined.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return materialize(joined.join(named, "root").select("fp", "component_id"))


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """One row per document: ``doc_id, fingerprint (hex), component_id``."""
    marked = materialize(docs.select("doc_id", fingerprints(F.col("text"), shingle).alias("fp")))
    named = components(marked, max_bits)
    return (marked.join(named, "fp")
            .select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"))


def near_dedup(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """The rows of ``docs`` that stand for their group: one for each component.

    The smallest doc_id stays (a null one only if the group has no other);
    of rows that repeat it, the one with the smallest fingerprint, and of
    rows equal in both any one.
    """
    marked = materialize(docs.select("doc_id", fingerprints(quoted("text"), shingle).alias("fp")))
    named = components(marked, max_bits)
    rows = marked.groupBy("doc_id", "fp").agg(F.count("*").alias("n"))
    win = (rows.join(named, "fp").groupBy("component_id")
           .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fp")).alias("w"))
           .select("w.doc_id", "w.fp"))
    ids, fp, again, n = fresh(docs, "id", "fp", "again", "n")
    often = rows.groupBy(F.col("doc_id").alias(ids)).agg(F.sum("n").alias(n))
    win = materialize(win.join(often, F.col("doc_id").eqNullSafe(F.col(ids)))
                      .select(ids, F.col("fp").alias(fp), n))
    same_id = quoted("doc_id").eqNullSafe(F.col(ids))
    one = docs.join(win.filter(F.col(n) == 1), same_id).select(*columns(docs.columns))
    many = win.filter(F.col(n) > 1)
    if many.isEmpty():
        return one
    # ids that several rows share: tell the rows apart by their fingerprints
    shared = (docs.join(many, same_id).withColumn(again, fingerprints(quoted("text"), shingle))
              .filter(F.col(again) == F.col(fp)).dropDuplicates([ids, fp]))
    return one.unionByName(shared.select(*columns(docs.columns)))

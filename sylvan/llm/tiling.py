"""Benchmark decontamination by greedy string tiling (operator 9).

Texts and items become words: lower-cased runs of letters and digits.  A
document and an item are compared if they share a seed, ``min_match``
consecutive words (an item shorter than that is one seed as a whole).
Greedy tiling then marks, again and again, the longest common run of words
that are unmarked on both sides, down to the seed's length; among runs of
one length the first in the item, then the first in the document comes
first.  Coverage is the marked share of the item's words; a document is
contaminated by an item at ``threshold`` or more.  Matches may stand in any
order, so reordered passages are caught.

Search.  Seeds are Karp-Rabin hashes.  The benchmark's seeds set bits of a
bitmap of ``2 ** filter_bits`` bits, the only thing that is broadcast, of a
size that no input changes.  One pass over the documents keeps, of those
with a window whose bit is set, the seeds and the runs of words around them
(a small extract on the executors' disks).  Spark joins extract and benchmark on the
seeds' hashes, which leaves pairs of documents and items that share one; each
pair's words meet in a second join, and the tiling runs pair by pair.  Wrong
bits cost time and no result; a seed that many documents or items share is
a skewed join key, which Spark splits.

Tiling.  The longest common run is found by halving its length, each step
one comparison of the hashes of all unmarked windows; all runs of that
length are then marked in one sweep.  No pairs of equal windows are listed,
so a text of one word repeated costs no more than any other.

A null or empty text or item matches nothing.  Repeated rows are judged
alike; repeated items are separate items.  No items: no document matches.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sylvan.llm.common import columns, fresh, quoted
from sylvan.llm.lines import document_key
from sylvan.session import scratch_path

#: Bits of the filter over the benchmark's seeds.
FILTER_BITS = 22
#: Files of the table of contaminated documents.
HIT_FILES = 16
#: Characters of texts whose words are hashed together.
GROUP = 1 << 19
_WORDS = re.compile(r"[^\W_]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[str]:
    return _WORDS.findall(text.lower())


def rolling(ids: np.ndarray, n: int) -> np.ndarray:
    """Karp-Rabin hashes of all windows of ``n`` ids, modulo 2^64."""
    out = np.zeros(max(len(ids) - n + 1, 0), np.uint64)
    if len(out):
        for i in range(n):
            out = out * _BASE + ids[i:i + len(out)]
    return out


class _Windows:
    """Hashes of the windows of any length over ids, from prefix sums."""

    def __init__(self, ids: np.ndarray):
        self.ids = ids
        with np.errstate(over="ignore"):
            self.power = np.cumprod(np.concatenate(([np.uint64(1)], np.full(len(ids), _BASE, np.uint64))), dtype=np.uint64)
            self.sums = np.concatenate(([np.uint64(0)], np.cumsum(ids * self.power[:-1], dtype=np.uint64)))

    def of(self, n: int, free: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and hashes of the unmarked windows of ``n`` ids."""
        if n > len(self.ids):
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        taken = np.concatenate(([0], np.cumsum(~free)))
        at = np.flatnonzero(taken[n:] == taken[:-n])
        with np.errstate(over="ignore"):      # brought to one common power, so equal windows have equal hashes
            return at, (self.sums[at + n] - self.sums[at]) * self.power[len(self.ids) - at]


def tile(doc: np.ndarray, item: np.ndarray, min_match: int) -> int:
    """Words of ``item`` marked by greedy tiling against ``doc`` (arrays of word hashes or numbers)."""
    # one array for both, so that one set of powers hashes both sides
    both = _Windows(np.concatenate((doc, item)).astype(np.uint64))
    free = np.ones(len(doc) + len(item), bool)
    split = len(doc)

    def sides(n: int):
        at, h = both.of(n, free)
        left, right = at + n <= split, at >= split
        return at[left], h[left], at[right], h[right]

    longest = min(len(doc), len(item))
    while True:
        low, high = min_match - 1, longest       # a common run of ``low`` words exists, or is not looked for
        while low < high:
            n = (low + high + 1) // 2
            _, d, _, t = sides(n)
            if len(d) and len(t) and np.isin(t, d).any():
                low = n
            else:
                high = n - 1
        if low < max(min_match, 1):
            return int((~free[split:]).sum())
        longest = low
        at_d, d, at_t, t = sides(longest)
        shared = np.isin(t, d)
        places: dict[int, list[int]] = defaultdict(list)
        wanted = np.isin(d, t[shared])
        for i, h in zip(at_d[wanted].tolist()[::-1], d[wanted].tolist()[::-1]):
            places[h].append(i)                  # the first place last: taken from the end
        for j, h in zip(at_t[shared].tolist(), t[shared].tolist()):
            if not free[j:j + longest].all():
                continue
            here = places[h]
            while here:
                i = here.pop()
                if free[i:i + longest].all():
                    free[i:i + longest] = free[j:j + longest] = False
                    break


# ---- seeds --------------------------------------------------------------------

def word_hashes(words: list[str]) -> np.ndarray:
    """A 64-bit hash of each word; equal words are hashed once."""
    coded = pa.array(words, pa.string()).dictionary_encode()
    own = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.cast(pa.binary()).to_pylist()),
                      np.uint64, len(coded.dictionary))
    return own[coded.indices.to_numpy(zero_copy_only=False)] if len(words) else np.zeros(0, np.uint64)


def _groups(texts: list[str | None]) -> Iterator[tuple[list[str], np.ndarray]]:
    """Words of consecutive texts, about ``GROUP`` characters at a time, and each word's text."""
    words, sizes, held, first = [], [], 0, 0
    for i, t in enumerate(texts):
        found = words_of(t) if t else []
        words += found
        sizes.append(len(found))
        held += len(t or "")
        if held >= GROUP or i + 1 == len(texts):
            yield words, np.repeat(np.arange(first, i + 1), sizes)
            words, sizes, held, first = [], [], 0, i + 1


def _seeds(code: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all windows of ``n`` words; windows of another length hash apart."""
    h = (rolling(code, n) + np.uint64(n)) * _BASE
    return h ^ (h >> np.uint64(32))


_SEEDED = "struct<n: int, words: array<string>, seeds: array<long>>"


def _item_seeds(min_match: int):
    def run(text: pa.Array) -> pa.Array:
        out = []
        for t in text.to_pylist():
            words = words_of(t) if t else []
            n = min(min_match, len(words))
            seeds = np.unique(_seeds(word_hashes(words), n)).view(np.int64).tolist() if n else []
            out.append({"n": n, "words": words, "seeds": seeds})
        return pa.array(out, pa.struct([("n", pa.int32()), ("words", pa.list_(pa.string())), ("seeds", pa.list_(pa.int64()))]))
    return F.arrow_udf(run, _SEEDED)


def _bit(seed: Column, bits: int) -> Column:
    return F.shiftrightunsigned(seed, 64 - bits)


def _filter(items: DataFrame, bits: int) -> np.ndarray:
    """A bitmap of ``2 ** bits`` bits, set at the benchmark's seeds."""
    at = items.select(F.explode("seeds").alias("seed")).select(_bit(F.col("seed"), bits).alias("bit"))
    # Spark's bitmaps number positions from 1, in blocks of 32,768 bits
    rows = (at.groupBy(F.bitmap_bucket_number(F.col("bit") + 1).alias("block"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("bit") + 1)).alias("bitmap")).collect())
    out = np.zeros(max((1 << bits) // 8, 4096), np.uint8)
    for r in rows:
        out[(r["block"] - 1) * 4096:r["block"] * 4096] = np.frombuffer(r["bitmap"], np.uint8)
    return out


_EXTRACT = "struct<seeds: array<long>, body: string>"


def _extract(shared, lengths: list[int], bits: int):
    """Of a text with a possible seed: its seeds, and the runs of words they cover (``\\n`` between runs)."""
    def run(text: pa.Array) -> pa.Array:
        table = np.unpackbits(shared.value, bitorder="little").view(bool)
        out: list[dict | None] = [None] * len(text)
        for words, owner in _groups(text.to_pylist()):
            code = word_hashes(words)
            places, seeds, widths = [], [], []
            for n in lengths:
                if len(code) < n:
                    continue
                h = _seeds(code, n)
                at = np.flatnonzero(table[(h >> np.uint64(64 - bits)).astype(np.int64)] & (owner[:len(h)] == owner[n - 1:]))
                places.append(at)
                seeds.append(h[at])
                widths.append(np.full(len(at), n))
            if not places or not sum(map(len, places)):
                continue
            at, seed, n = (np.concatenate(x) for x in (places, seeds, widths))
            order = np.argsort(at, kind="stable")
            at, seed, n = at[order], seed[order], n[order]
            starts = np.flatnonzero(np.concatenate(([True], owner[at[1:]] != owner[at[:-1]])))
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(at)]):
                low, high = int(at[a]), int((at[a:b] + n[a:b]).max())
                keep = np.zeros(high - low + 1, np.int64)
                np.add.at(keep, at[a:b] - low, 1)
                np.add.at(keep, at[a:b] + n[a:b] - low, -1)
                kept = np.flatnonzero(np.cumsum(keep[:-1]) > 0) + low
                ends = set(np.flatnonzero(np.diff(kept) > 1).tolist())
                body = "".join(words[k] + ("\n" if i in ends else " ") for i, k in enumerate(kept.tolist()))
                out[int(owner[low])] = {"seeds": np.unique(seed[a:b]).view(np.int64).tolist(), "body": body}
        return pa.array(out, pa.struct([("seeds", pa.list_(pa.int64())), ("body", pa.string())]))
    return F.arrow_udf(run, _EXTRACT)


def _coverage(body: pa.Array, words: pa.Array, n: pa.Array) -> pa.Array:
    """Share of each item's words that its document's runs tile."""
    out = []
    for text, item, least in zip(body.to_pylist(), words.to_pylist(), n.to_pylist()):
        words = text.replace("\n", " \n ").split(" ")
        doc = word_hashes(words)                 # a gap is a word that no item has
        out.append(tile(doc, word_hashes(item), least) / len(item))
    return pa.array(out, pa.float64())


# ---- the operator ---------------------------------------------------------------

def _hits(docs: DataFrame, bench: DataFrame, min_match: int, threshold: float,
          filter_bits: int) -> tuple[DataFrame, list[DataFrame]]:
    """``(doc, doc2, item, coverage)`` of every contaminated document and item, ``doc`` and ``doc2``
    hashing (doc_id, text); and the persisted tables it is read from."""
    if min_match < 1:
        raise ValueError("min_match must be at least 1")
    if not 3 <= filter_bits <= 30:
        raise ValueError("filter_bits must be between 3 and 30")
    spark = docs.sparkSession
    seeded = _item_seeds(min_match)(F.col("text").cast("string"))
    items = (bench.select(F.col("item_id").cast("string").alias("item"), seeded.alias("s"))
             .select(F.monotonically_increasing_id().alias("number"), "item", "s.*")
             .filter("n > 0").persist(StorageLevel.DISK_ONLY))
    lengths = sorted(r["n"] for r in items.select("n").distinct().collect())          # at most min_match
    shared = spark.sparkContext.broadcast(_filter(items, filter_bits))
    found = _extract(shared, lengths, filter_bits)(quoted("text").cast("string"))
    # equal rows are one document here; each gets the result back at the end.  Counting fills the
    # kept table once: the two joins below read it side by side
    extract = (docs.select(*document_key(docs, "text", "doc_id"), found.alias("f")).filter("f is not null")
               .select("doc", "doc2", "f.seeds", "f.body").persist(StorageLevel.DISK_ONLY))
    extract.count()
    seeds = extract.select("doc", "doc2", F.explode("seeds").alias("seed")).distinct()
    pairs = (seeds.join(items.select("number", F.explode("seeds").alias("seed")), "seed")
             .select("doc", "doc2", "number").distinct())
    bodies = extract.dropDuplicates(["doc", "doc2"]).select("doc", "doc2", "body")
    hits = (pairs.join(items.select("number", "item", "words", "n"), "number").join(bodies, ["doc", "doc2"])
            .select("doc", "doc2", "item", F.arrow_udf(_coverage, "double")("body", "words", "n").alias("coverage"))
            .filter(F.col("coverage") >= threshold))
    return hits, [items, extract]


def matches(docs: DataFrame, bench: DataFrame, min_match: int = 5, threshold: float = 0.8,
            filter_bits: int = FILTER_BITS, out: str = "hits") -> DataFrame:
    """``docs`` plus ``out``: an array of (coverage, item) at or above ``threshold``, best first."""
    k1, k2, got = fresh(docs, "doc", "doc2", out)
    hits, held = _hits(docs, bench, min_match, threshold, filter_bits)
    lists = hits.groupBy("doc", "doc2").agg(F.sort_array(F.collect_list(F.struct("coverage", "item")), asc=False).alias(got))
    lists = _written(lists.select(F.col("doc").alias(k1), F.col("doc2").alias(k2), quoted(got)))
    for table in held:
        table.unpersist()
    key1, key2 = document_key(docs, "text", "doc_id")
    none = F.expr("cast(array() as array<struct<coverage: double, item: string>>)")
    return (docs.withColumns({k1: key1, k2: key2}).join(lists, [k1, k2], "left")
            .withColumn(got, F.coalesce(quoted(got), none)).select(*columns(docs.columns), quoted(got)))


def _written(rows: DataFrame) -> DataFrame:
    """Rows written and read again: Spark knows their size and broadcasts them only below its own bound."""
    spark: SparkSession = rows.sparkSession
    path = scratch_path(spark, "tiling-hits")
    rows.coalesce(HIT_FILES).write.parquet(path)
    return spark.read.parquet(path)


def contaminated(docs: DataFrame, bench: DataFrame, min_match: int = 5, threshold: float = 0.8,
                 filter_bits: int = FILTER_BITS) -> DataFrame:
    """One row per contaminated document: doc_id, contaminated (true), coverage, item (the best)."""
    docs = docs.select("doc_id", "text")
    (got,) = fresh(docs, "hits")
    return (matches(docs, bench, min_match, threshold, filter_bits, got).filter(F.size(got) > 0)
            .select("doc_id", F.lit(True).alias("contaminated"),
                    F.col(got)[0]["coverage"].alias("coverage"), F.col(got)[0]["item"].alias("item")))


def decontaminate(docs: DataFrame, bench: DataFrame, **limits) -> DataFrame:
    """The rows of ``docs`` that no item contaminates."""
    (got,) = fresh(docs, "hits")
    return (matches(docs, bench, out=got, **limits).filter(F.size(quoted(got)) == 0)
            .select(*columns(docs.columns)))

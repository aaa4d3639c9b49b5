"""Line deduplication by range-partitioned line hashes (operator 7).

Every text is split at ``\\n``; a line's key is the line without ASCII
white space at both ends, A-Z lower-cased.  Keys with at least
``min_chars`` code points that occur in at least ``min_docs`` documents
are repeated: ``keep="none"`` drops all their lines, ``keep="first"``
all but the first occurrence in the order of (document, position).

Plan: each document emits one row per distinct key (128-bit hash, first
position, all positions).  These small rows are kept on the executors'
disks, dealt out by range of (hash, document, position) and sorted within
partitions, so a hot key spreads over many partitions.  Each partition is
read as a stream that holds back at most ``min_docs`` rows of the current
key.  A key that touches a partition's first or last row may go on in its
neighbours: its held-back rows and its capped count come out as boundary
records, which a join over those few records settles.  The rows of repeated
keys are written once, in files of ``FOUND_ROWS`` rows.  The result is one
compressed bitmap per document that loses lines; no text is shuffled to
find it.

Every row is a document: rows equal in doc_id and text count one by one, and
all of them get the same result (with ``keep="first"``, all keep the first
occurrence that one of them has).  A null doc_id is an ordinary value; a
null text is one empty line.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sylvan.llm.common import columns, fresh, materialize, quoted, utf8

SPACE = b" \t\n\x0b\x0c\r"
#: Rows of a file of repeated keys.
FOUND_ROWS = 1_000_000

ROWS = "h1 long, h2 long, doc long, doc2 long, n_lines int, first int, places binary"
FOUND = ("doc long, doc2 long, n_lines int, places binary, h1 long, h2 long, part int, "
         "docs int, settled boolean, leads boolean")


def line_key(line: bytes) -> bytes:
    return line.strip(SPACE).lower()


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _line_rows(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            for text, doc, doc2 in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                       batch.column(2).to_pylist()):
                places: dict[bytes, list[int]] = {}
                lines = text.split(b"\n")
                for i, line in enumerate(lines):
                    places.setdefault(line_key(line), []).append(i)
                for key, at in places.items():
                    # a code point has 1 to 4 bytes: count them only where it matters
                    if len(key) < min_chars or len(key) < 4 * min_chars and \
                            len(key.decode("utf-8", "replace")) < min_chars:
                        continue
                    h = xxhash.xxh3_128_intdigest(key)
                    for col, v in zip(out, (_signed(h >> 64), _signed(h & (1 << 64) - 1), doc, doc2,
                                            len(lines), at[0], np.array(at, "<i4").tobytes())):
                        col.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.int64(),
                                                      pa.int32(), pa.int32(), pa.binary()))],
                ["h1", "h2", "doc", "doc2", "n_lines", "first", "places"])
    return run


def _stream(min_docs: int):
    """Rows of repeated keys from one sorted partition, plus boundary records."""
    schema = pa.schema([("doc", pa.int64()), ("doc2", pa.int64()), ("n_lines", pa.int32()),
                        ("places", pa.binary()), ("h1", pa.int64()), ("h2", pa.int64()),
                        ("part", pa.int32()), ("docs", pa.int32()), ("settled", pa.bool_()),
                        ("leads", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        key, count, held, opening, leader = None, 0, [], True, None

        def record(rows: list[tuple], settled: bool) -> list[tuple]:
            """Found rows; those of the key's first document lead, which an opening key settles at the boundary."""
            return [(*r, *key, part, min(count, min_docs), settled and not (opening and r[:2] == leader), r[:2] == leader)
                    for r in rows]

        def summary() -> tuple:
            """A boundary record that stands for no line, only for a count."""
            return (None, None, None, None, *key, part, min(count, min_docs), False, False)

        for batch in batches:
            out: list[tuple] = []
            h1, h2 = (batch.column(i).to_numpy() for i in (0, 1))
            n = len(h1)
            if not n:
                continue
            starts = np.flatnonzero(np.concatenate(([True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1]))))
            for a, b in zip(starts, [*starts[1:], n]):
                now = (int(h1[a]), int(h2[a]))
                if now != key:
                    if opening and key is not None:   # the partition's first key ends here
                        out += record(held, False) + [summary()]
                        opening = False
                    key, count, held = now, 0, []
                    if b - a < min_docs and b < n and not (opening and a == 0):
                        count = int(b - a)            # rare key, wholly inside: nothing to report
                        continue
                    leader = tuple(batch.column(i)[int(a)].as_py() for i in (2, 3))
                rows = list(zip(*(batch.column(i).slice(a, b - a).to_pylist() for i in (2, 3, 4, 6))))
                count += len(rows)
                if count < min_docs:
                    held += rows
                    continue
                out += record(held + rows, True)
                held = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)],
                                                 schema=schema)
        if key is not None:
            out = record(held, False) + [summary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)],
                                             schema=schema)
    return run


def _bitmap(places: pa.Array, n_lines: pa.Array) -> pa.Array:
    """Compressed keep bitmap: one bit per line, set where the line stays."""
    out = []
    for lists, n in zip(places.to_pylist(), n_lines.to_pylist()):
        keep = np.ones(n, bool)
        for p in lists:
            keep[np.frombuffer(p, "<i4")] = False
        out.append(zlib.compress(np.packbits(keep).tobytes(), 1))
    return pa.array(out, pa.binary())


def keep_bitmaps(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, keep: str = "none",
                 text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``(doc, doc2, n_lines, bitmap)`` for every document that loses a line.

    ``doc`` and ``doc2`` are two hashes of (doc_id, text); ``bitmap`` is
    read by :func:`apply_bitmaps`.  No row: every line stays.
    """
    if keep not in ("none", "first"):
        raise ValueError(f"keep must be 'none' or 'first', not {keep!r}")
    if min_docs < 1 or min_chars < 0:
        raise ValueError("min_docs must be at least 1 and min_chars at least 0")
    rows = (docs.select(utf8(quoted(text)).alias("text"), *document_key(docs, text, doc_id))
            .mapInArrow(_line_rows(min_chars), ROWS)
            .select("h1", "h2", "doc", "doc2", "n_lines", "first", "places").persist(StorageLevel.DISK_ONLY))
    spread = (rows.repartitionByRange("h1", "h2", "doc", "doc2")
              .sortWithinPartitions("h1", "h2", "doc", "doc2", "first"))
    streamed = spread.mapInArrow(_stream(min_docs), FOUND).persist(StorageLevel.DISK_ONLY)
    found = materialize(streamed.coalesce(streamed.count() // FOUND_ROWS + 1))
    streamed.unpersist()
    rows.unpersist()
    open_ = found.filter(~F.col("settled"))
    # at most two keys a partition: a few records, whatever the input's size
    edges = (open_.filter(F.col("doc").isNull()).groupBy("h1", "h2")
             .agg(F.sum("docs").alias("total"), F.min("part").alias("home")))
    late = (open_.filter(F.col("doc").isNotNull()).join(edges, ["h1", "h2"]).filter(F.col("total") >= min_docs)
            .withColumn("leads", F.col("leads") & (F.col("part") == F.col("home"))))
    take = ["doc", "doc2", "n_lines", "places", "leads"]
    lost = found.filter(F.col("settled")).select(*take).unionByName(late.select(*take))
    if keep == "first":      # the leader keeps its first line and loses its later ones
        lost = (lost.withColumn("places", F.when(F.col("leads"), F.expr("substring(places, 5)"))
                                .otherwise(F.col("places"))).filter(F.length("places") > 0))
    # equal rows lose the same lines: a document has at most one list for each of its keys
    return (lost.groupBy("doc", "doc2", "n_lines").agg(F.collect_set("places").alias("places"))
            .select("doc", "doc2", "n_lines", F.arrow_udf(_bitmap, "binary")(F.col("places"), F.col("n_lines")).alias("bitmap")))


def document_key(docs: DataFrame, text: str, doc_id: str):
    body, ident = F.coalesce(quoted(text), F.lit("")), quoted(doc_id)
    return (F.xxhash64(ident, body).alias("doc"), F.xxhash64(body, ident, F.lit(7)).alias("doc2"))


def _cut(text: pa.Array, bitmap: pa.Array) -> pa.Array:
    n_lines, dropped, kept = [], [], []
    for body, bits in zip(text.to_pylist(), bitmap.to_pylist()):
        n = body.count(b"\n") + 1
        n_lines.append(n)
        if bits is None:
            dropped.append(0)
            kept.append(body)
            continue
        keep = np.unpackbits(np.frombuffer(zlib.decompress(bits), np.uint8), count=n).tolist()
        left = [line for line, k in zip(body.split(b"\n"), keep) if k]
        dropped.append(n - len(left))
        kept.append(b"\n".join(left))
    return pa.StructArray.from_arrays([pa.array(n_lines, pa.int64()), pa.array(dropped, pa.int64()),
                                       pa.array(kept, pa.binary())], ["n_lines", "n_dropped", "text"])


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, out: str = "lines",
                  text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` plus a struct column ``out`` of n_lines, n_dropped and the kept text (bytes)."""
    k1, k2, bits = fresh(docs, "doc", "doc2", "bitmap")
    key1, key2 = document_key(docs, text, doc_id)
    keyed = docs.withColumns({k1: key1, k2: key2})
    maps = bitmaps.select(F.col("doc").alias(k1), F.col("doc2").alias(k2), F.col("bitmap").alias(bits))
    return (keyed.join(maps, [k1, k2], "left")
            .withColumn(out, F.arrow_udf(_cut, "struct<n_lines: long, n_dropped: long, text: binary>")(utf8(quoted(text)), F.col(bits)))
            .select(*columns(docs.columns), quoted(out)))


def line_dedup(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, keep: str = "none") -> DataFrame:
    """``docs`` with its repeated lines cut out of ``text``; every row stays.

    A text of which nothing is left becomes empty; a null text without a
    dropped line stays null.  ``n_chars``, where it exists, is recounted
    for the rows that change.
    """
    (got,) = fresh(docs, "lines")
    cut = apply_bitmaps(docs, keep_bitmaps(docs, min_docs, min_chars, keep), got)
    new, changed = quoted(got).getField("text").cast("string"), quoted(got).getField("n_dropped") > 0
    put = {"text": F.when(changed, new).otherwise(quoted("text"))}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        put["n_chars"] = F.when(changed, F.length(new).cast(kind)).otherwise(quoted("n_chars"))
    return cut.withColumns(put).select(*columns(docs.columns))

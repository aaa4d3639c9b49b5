"""Packing by concatenate and cut (operator 5).

Every document becomes its token ids and a closing id; all documents are
laid end to end and cut into windows of ``size`` tokens, so only the very
last window needs padding.

Two passes.  The first tokenizes each partition once, numbers its tokens
from 0 and writes the ids to the shared folder; a grouped sum gives the
total of every partition.  The prefix sums over those totals (one row a
partition) are the partitions' global offsets.  The second pass reads the
ids back and cuts them at the window borders.  Within a partition whole
windows are put together on the spot; the windows at its ends come out as
boundary records, which are merged by window number.

A null text is an empty one (the closing id alone).  Repeated rows are
packed as often as they come; an empty table gives no window.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sylvan.llm.common import materialize, quoted
from sylvan.llm.tokens import byte_ids

SIZE = 2048
_GROUP = 64


def _tokenize(path: str, ranks: str | None, closing: int):
    names = ["doc_id", "ids", "n", "part", "local"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        coder, part, at = byte_ids(path, ranks), TaskContext.get().partitionId(), 0
        kind = "<u2" if max(coder.vocabulary, closing + 1) <= 1 << 16 else "<u4"
        for batch in batches:
            for i in range(0, batch.num_rows, _GROUP):
                some = batch.slice(i, _GROUP)
                ids, n, local = [], [], []
                for text in some.column(1).to_pylist():
                    a = np.append(coder.array(text or "", kind), np.array([closing], kind))
                    ids.append(a.tobytes())
                    n.append(len(a))
                    local.append(at)
                    at += len(a)
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array(ids, pa.binary()), pa.array(n, pa.int64()),
                     pa.array([part] * len(n), pa.int64()), pa.array(local, pa.int64())], names)
    return run


def token_table(docs: DataFrame, path: str, ranks: str | None, closing: int) -> DataFrame:
    """First pass, written: ``doc_id, ids, n, part, local``."""
    rows = docs.select("doc_id", quoted("text").cast("string").alias("text"))
    return materialize(rows.mapInArrow(
        _tokenize(path, ranks, closing),
        f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids binary, n long, part long, local long"))


def offsets(tokens: DataFrame) -> DataFrame:
    """``part, base``: tokens before each partition; one row a partition."""
    totals = tokens.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect()
    base = np.cumsum([0, *(r["n"] for r in totals)])
    return tokens.sparkSession.createDataFrame(
        [(int(r["part"]), int(b)) for r, b in zip(totals, base)], "part long, base long")


def _cuts(start: int, n: int, size: int) -> list[tuple[int, int]]:
    """(first, length) of the pieces of ``n`` tokens that begin at global position ``start``."""
    edges = [0, *range(size - start % size, n, size), n]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _wide(ids: bytes, n: int) -> np.ndarray:
    return np.frombuffer(ids, "<u2" if len(ids) == 2 * n else "<u4").astype("<u4")


def _pieces(size: int, id_type: pa.DataType):
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in names]
            for doc, ids, n, begin in zip(*(batch.column(i).to_pylist() for i in range(4))):
                raw = memoryview(_wide(ids, n).tobytes())
                for first, length in _cuts(begin, n, size):
                    seq, off = divmod(begin + first, size)
                    for col, v in zip(out, (doc, first, length, zlib.crc32(raw[4 * first:4 * (first + length)]),
                                            n, seq, off)):
                        col.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], batch.schema.field(0).type), *(pa.array(c, pa.int64()) for c in out[1:])], names)
    return run


def placed(tokens: DataFrame) -> DataFrame:
    """``doc_id, ids, n, begin`` with the global position of each document."""
    return (tokens.join(F.broadcast(offsets(tokens)), "part")      # a row for each partition
            .select("doc_id", "ids", "n", (F.col("base") + F.col("local")).alias("begin")))


def pieces(docs: DataFrame, path: str, ranks: str | None = None, closing: int = 1,
           size: int = SIZE) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return placed(token_table(docs, path, ranks, closing)).mapInArrow(
        _pieces(size, pa.int64()),
        f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, "
        "sequence_id long, offset long")


def _windows(size: int):
    names = ["sequence_id", "offset", "ids", "whole"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seq, first, held = None, 0, []

        def flush() -> tuple:
            ids = np.concatenate(held)
            return seq, first, ids.tobytes(), len(ids) == size

        for batch in batches:
            out = []
            for _, ids, n, begin in zip(*(batch.column(i).to_pylist() for i in range(4))):
                wide = _wide(ids, n)
                for a, length in _cuts(begin, n, size):
                    s, off = divmod(begin + a, size)
                    if held and not (s == seq and off == first + sum(map(len, held))):
                        out.append(flush())
                        held = []
                    if not held:
                        seq, first = s, off
                    held.append(wide[a:a + length])
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 4,
                                                (pa.int64(), pa.int64(), pa.binary(), pa.bool_()))], names)
        if held:
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(flush(), (pa.int64(), pa.int64(), pa.binary(), pa.bool_()))],
                names)
    return run


def sequences(docs: DataFrame, path: str, ranks: str | None = None, closing: int = 1,
              size: int = SIZE, padding: int = 0) -> DataFrame:
    """The packed windows: ``sequence_id, n_tokens, input_ids``.

    All hold ``size`` tokens but the last, which is padded to ``size``
    unless its length is a power of two.
    """
    cut = materialize(placed(token_table(docs, path, ranks, closing)).mapInArrow(
        _windows(size), "sequence_id long, offset long, ids binary, whole boolean"))

    @F.arrow_udf("array<long>")
    def as_ids(parts: pa.Array) -> pa.Array:
        out = []
        for some in parts.to_pylist():
            ids = np.frombuffer(b"".join(some), "<u4").astype(np.int64)
            if len(ids) < size and len(ids) & (len(ids) - 1):
                ids = np.concatenate([ids, np.full(size - len(ids), padding, np.int64)])
            out.append(ids)
        return pa.array(out, pa.list_(pa.int64()))

    whole = cut.filter("whole").select("sequence_id", F.array("ids").alias("parts"))
    ends = (cut.filter("not whole").groupBy("sequence_id")
            .agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"))   # at most size tokens
            .select("sequence_id", F.col("p.ids").alias("parts")))
    both = whole.unionByName(ends)
    return both.select("sequence_id",
                       F.aggregate("parts", F.lit(0), lambda a, x: a + F.length(x)).cast("long").alias("bytes"),
                       as_ids("parts").alias("input_ids")).select(
        "sequence_id", (F.col("bytes") / 4).cast("long").alias("n_tokens"), "input_ids")

"""Phrase collocation mining (operator 11).

Texts are lower-cased (A-Z), cut into pieces at ``BREAKS`` and those into
words at spaces and tabs.  Per language, every phrase of two to five
words found at least ``min_count`` times is scored by its weakest cut:
``floor(1000 * a * n / (l * r))`` with the phrase's count ``a``, the
counts ``l`` and ``r`` of its two parts and the language's word count
``n``.  A phrase that lies inside a longer one of the same count is dropped.

Counting.  Every word position gives one window: the longest phrase of at
most ``ORDER`` words from there on that may still be frequent.  Two passes
fill ``TABLES`` tables of ``2 ** filter_bits`` saturating counters by hash
(orders 1 and 2, then 3 to 5); a phrase with a counter that stays below
``min_count`` can't reach it, so the windows stop there.  Any table size
gives the same result: it only decides how many rare windows are sorted in
vain.  Tables that don't grow fill up with the input until nothing is rare to
them, so their size follows the bytes of text (``table_bits``) up to a bound
that a task can hold.  Windows are combined within a
task before they leave it.  A frequent window occurs in nearly every task, so
rows and blobs follow the number of tasks: the text is read by as many tasks
as there are cores (``readers``), not by one a split.  A task whose windows
outgrow ``HELD_WINDOWS`` lets the rare ones go and goes on adding to the others.

Estimation uses sorted streams and no hash table.  The windows are range
partitioned and sorted in prefix order; one pass adds up every phrase's
count (a phrase is the run of windows that begin with it) and finds its
most frequent right extension.  Phrases on a partition's first or last path
may go on next door: they come out as boundary records, which are summed.
The frequent phrases are then read in suffix order, where the last row of
each length is the suffix of that length, giving the counts of all right
parts and the phrases that a left extension replaces; and this stream, put
back into prefix order, is merged in lockstep with the replacements and the
counts of all left parts.  What a partition needs from those before it (the
last count of each length) is six numbers per partition.

A null text is empty, a null language is ``und``; phrases of texts with
equal rows count once per row; an empty table gives no row.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sylvan.llm.common import materialize, quoted, utf8

ORDER = 5
#: Phrase lengths counted in the first and in the second filter pass.
SHORT, LONG = (1, 2), tuple(range(3, ORDER + 1))
BREAKS = b".,;:!?\n\x0b\x0c\r"
SPACES = b" \t"
#: Bytes of text worked on at once.
SEGMENT = 1 << 22
#: Tables of counters, each with a hash of its own.
TABLES = 2
#: Table size: bytes of text per counter, the fewest and the most bits of a counter's number.
TEXT_PER_COUNTER, LEAST_BITS, MOST_BITS = 128, 23, 27
#: Counters per shuffled blob of the filter table.
CHUNK = 1 << 16
#: Windows a task combines before it lets them go.
HELD_WINDOWS = 1_000_000
#: Rows that the sorted streams look at together.
STREAM_ROWS = 1 << 16
#: Rows of a partition of frequent phrases.
PHRASES_PER_PARTITION = 500_000

WORDS = [f"w{i}" for i in range(1, ORDER + 1)]
KEY = ["lang", *WORDS]
_KEY_DDL = "lang string, " + ", ".join(f"{w} binary" for w in WORDS)

_KIND = np.zeros(256, np.uint8)
_KIND[list(SPACES)] = 1
_KIND[list(BREAKS)] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MIX = np.uint64(0x9E3779B97F4A7C15)
_OWN = [np.uint64(m) for m in (1, 0xC2B2AE3D27D4EB4F)]          # odd multipliers, one a table


class Segment:
    """The words of a stretch of text: their codes, pieces and languages.

    ``starts`` words belong to the stretch; those after them only complete
    the phrases that begin in it.
    """

    def __init__(self, data: np.ndarray, own: int, lang_of: Callable[[np.ndarray], np.ndarray]):
        kind = _KIND[data]
        word = kind == 0
        edge = np.diff(np.concatenate(([0], word.view(np.int8), [0])))
        begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        offsets = np.zeros(len(begin) + 1, np.int32)
        np.cumsum(end - begin, out=offsets[1:])
        letters = _LOWER[data[word]]
        coded = pa.BinaryArray.from_buffers(pa.binary(), len(begin), [
            None, pa.py_buffer(offsets), pa.py_buffer(letters)]).dictionary_encode()
        self.names: list[bytes] = coded.dictionary.to_pylist()
        self.code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.piece = np.cumsum(kind == 2)[begin] if len(begin) else np.zeros(0, np.int64)
        self.lang = lang_of(begin)
        self.starts = int(np.searchsorted(begin, own))

    def phrase_hashes(self, lang_seed: np.ndarray) -> Iterator[np.ndarray]:
        """For each order the hashes of the phrases from every position on."""
        one = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in self.names), np.uint64, len(self.names))[self.code]
        chain = lang_seed[self.lang]
        for k in range(ORDER):
            chain = chain[:len(one) - k] if len(one) >= k else chain[:0]
            chain = (chain ^ one[k:]) * _MIX
            chain ^= chain >> np.uint64(29)
            yield chain

    def inside(self, k: int) -> np.ndarray:
        """Whether the ``k`` words from a position on exist and lie in one piece."""
        n = len(self.piece) - k + 1
        return self.piece[:n] == self.piece[k - 1:] if n > 0 else np.zeros(0, bool)


def _stretch_end(buf: np.ndarray, at: int) -> int:
    """The first place from ``at`` on that follows a space or break (or the end)."""
    width = 4096
    while at < len(buf):
        found = np.flatnonzero(_KIND[buf[at - 1:at - 1 + width]])
        if len(found):
            return at + int(found[0])
        at, width = min(at + width, len(buf)), 2 * width
    return len(buf)


def _look_ahead(buf: np.ndarray, at: int) -> int:
    """Where the ``ORDER - 1`` words after ``at`` end, at most the piece's end."""
    width = 4096
    while True:
        kind = _KIND[buf[at:at + width]]
        stop = np.flatnonzero(kind == 2)
        kind = kind[:stop[0]] if len(stop) else kind
        ends = np.flatnonzero(np.diff((kind == 0).view(np.int8)) == -1) + 1
        if len(ends) >= ORDER - 1:
            return at + int(ends[ORDER - 2])
        if len(stop) or at + width >= len(buf):
            return at + len(kind)
        width *= 2


def segments(texts: list[bytes], langs: np.ndarray, size: int = SEGMENT) -> Iterator[Segment]:
    """Texts (with the language number of each) as stretches of about ``size`` bytes."""
    buf = np.frombuffer(b"\n".join(texts), np.uint8)
    begins = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])[:-1]))
    lo = 0
    while lo < len(buf):
        hi = _stretch_end(buf, lo + size) if lo + size < len(buf) else len(buf)
        end = _look_ahead(buf, hi) if hi < len(buf) and _KIND[buf[hi - 1]] != 2 else hi
        yield Segment(buf[lo:end], hi - lo,
                      lambda at, lo=lo: langs[np.searchsorted(begins, at + lo, side="right") - 1])
        lo = hi


class Languages:
    """Numbers for the languages a task meets, and a hash seed for each."""

    def __init__(self) -> None:
        self.number: dict[str, int] = {}
        self.seed = np.zeros(0, np.uint64)

    def of(self, names: list[str]) -> np.ndarray:
        before = len(self.number)
        got = np.array([self.number.setdefault(x, len(self.number)) for x in names], np.int64)
        if len(self.number) > before:
            self.seed = np.array([xxhash.xxh3_64_intdigest(x.encode("utf-8", "replace"), seed=1) for x in self.number],
                                 np.uint64)
        return got


def _segments_of(batches: Iterable[pa.RecordBatch], langs: Languages) -> Iterator[Segment]:
    for batch in batches:
        texts = batch.column(0).to_pylist()
        if texts:
            yield from segments(texts, langs.of(batch.column(1).to_pylist()))


def _possible(seg: Segment, langs: Languages, heavy: dict[int, np.ndarray], bits: int,
              upto: int = ORDER) -> Iterator[tuple[int, np.ndarray, list[np.ndarray]]]:
    """For each order: which positions may begin a frequent phrase, and the counters of each position.

    All shorter phrases inside must be possible; where the order's tables are
    known (``heavy``), the phrase's own counters must all have reached the limit.
    """
    ok = None
    for k, h in enumerate(seg.phrase_hashes(langs.seed), 1):
        if k > upto:
            return
        buckets = [((h * own) >> np.uint64(64 - bits)).astype(np.int64) for own in _OWN]
        now = seg.inside(k)
        if ok is not None:
            now &= ok[:-1] & ok[1:]
        if k in heavy:
            for table, bucket in zip(heavy[k], buckets):
                now &= (table[bucket >> 3] >> (bucket & 7).astype(np.uint8) & 1).view(bool)
        yield k, now, buckets
        ok = now


# --- the filter tables -------------------------------------------------------------------------

def table_bits(text_bytes: int) -> int:
    """Bits of a counter's number for this much text: a table's load stays about the same up to ``MOST_BITS``."""
    return min(max(LEAST_BITS, (text_bytes // TEXT_PER_COUNTER - 1).bit_length()), MOST_BITS)


def _kind_of(limit: int):
    return np.uint8 if limit <= 255 else np.uint16 if limit < 1 << 16 else np.uint32


def _counters(orders: tuple[int, ...], known: Callable[[], dict[int, np.ndarray]], bits: int, limit: int):
    """Saturating counters of one task, in blobs: (chunk, salt, counters)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        langs, table, heavy = Languages(), np.zeros((TABLES, 1 << bits), _kind_of(limit)), known()
        waiting: list[list[np.ndarray]] = []

        def settle() -> None:
            for sums, found in zip(table, zip(*waiting)):
                at, more = np.unique(np.concatenate(found), return_counts=True)
                sums[at] = np.minimum(more + sums[at], limit)
            waiting.clear()

        for seg in _segments_of(batches, langs):
            for k, ok, buckets in _possible(seg, langs, heavy, bits, max(orders)):
                if k in orders:
                    at = np.flatnonzero(ok[:seg.starts])
                    waiting.append([b[at].astype(np.uint32) for b in buckets])
            if sum(len(w[0]) for w in waiting) > SEGMENT:
                settle()
        settle()
        salt = TaskContext.get().partitionId() % 16
        flat = table.reshape(-1)
        for c in range(0, len(flat), CHUNK):
            part = flat[c:c + CHUNK]
            if part.any():
                yield _record([[c // CHUNK], [salt], [zlib.compress(part.tobytes(), 1)]], _BLOB)
    return run


_BLOB = pa.schema([("chunk", pa.int32()), ("salt", pa.int32()), ("counters", pa.binary())])
_BLOB_DDL = "chunk int, salt int, counters binary"


def _record(columns: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _add_blobs(limit: int, last: bool):
    """Saturating sums of the blobs of equal chunk; at the end, which counters reached the limit."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        kind = _kind_of(limit)
        for batch in batches:
            for chunk, blob in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                more = np.frombuffer(zlib.decompress(blob), kind).astype(np.int64)
                total[chunk] = np.minimum(total[chunk] + more, limit).astype(kind) if chunk in total else more.astype(kind)
        for chunk, sums in total.items():
            body = np.packbits(sums >= limit, bitorder="little").tobytes() if last else zlib.compress(sums.tobytes(), 1)
            yield _record([[chunk], [0], [body]], _BLOB)
    return run


def _reached(texts: DataFrame, orders: tuple[int, ...], known: Callable[[], dict[int, np.ndarray]], bits: int,
             limit: int) -> np.ndarray:
    """Which counters reach the limit (one bit each comes to the driver)."""
    sums = (texts.mapInArrow(_counters(orders, known, bits, limit), _BLOB_DDL)
            .repartition("chunk", "salt").mapInArrow(_add_blobs(limit, False), _BLOB_DDL)
            .repartition("chunk").mapInArrow(_add_blobs(limit, True), _BLOB_DDL))
    out = np.zeros((TABLES << bits) // 8, np.uint8)
    wide = min(CHUNK, TABLES << bits) // 8
    for row in sums.select("chunk", "counters").collect():
        out[row["chunk"] * wide:(row["chunk"] + 1) * wide] = np.frombuffer(row["counters"], np.uint8)
    return out


# --- windows -----------------------------------------------------------------------------------

def _distinct(lang: np.ndarray, words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct windows (words numbered from 1 on, 0 for none) and their counts."""
    order = np.lexsort((*words.T[::-1], lang))
    lang, words, counts = lang[order], words[order], counts[order]
    new = np.ones(len(lang), bool)
    new[1:] = (lang[1:] != lang[:-1]) | (words[1:] != words[:-1]).any(axis=1)
    at = np.flatnonzero(new)
    return lang[at], words[at], np.add.reduceat(counts, at) if len(at) else counts


def _segment_windows(seg: Segment, length: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Windows of a segment by length: the length, languages, positions of an example, counts."""
    size, lang = max(1, len(seg.names)), seg.lang[:seg.starts]
    none = length == 0
    if none.any():
        u, c = np.unique(lang[none], return_counts=True)
        yield 0, u, np.zeros(len(u), np.int64), c
    at = np.flatnonzero(length >= 1)
    ids = lang[at] * size + seg.code[at]
    for k in range(1, ORDER + 1):
        if k > 1:
            ids = ids * size + seg.code[at + k - 1]
        u, first, inv = np.unique(ids, return_index=True, return_inverse=True)
        c = np.bincount(inv[length[at] == k], minlength=len(u))
        has = c > 0
        if has.any():
            example = at[first[has]]
            yield k, lang[example], example, c[has]
        on = length[at] > k
        at, ids = at[on], inv[on]
        if not len(at):
            return


_WINDOW = pa.schema([("lang", pa.string()), *((w, pa.binary()) for w in WORDS), ("part", pa.int32()), ("n", pa.int64())])
_WINDOW_DDL = f"{_KEY_DDL}, part int, n long"


def _windows(heavy: Callable[[], dict[int, np.ndarray]], bits: int):
    """The longest possibly frequent phrase from every word on, with counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        langs, known, tables = Languages(), {}, heavy()
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        part = TaskContext.get().partitionId()

        def out(keep: int) -> Iterator[pa.RecordBatch]:
            """Let all windows go but the ``keep`` most frequent ones."""
            lang, words, counts = held.pop()
            order = np.argsort(-counts, kind="stable")
            go, stay = np.sort(order[keep:]), np.sort(order[:keep])
            spelled = [b"", *known]
            names = pa.array(spelled, pa.binary())
            titles = pa.array(list(langs.number), pa.string())
            for a in range(0, len(go), STREAM_ROWS):
                b = go[a:a + STREAM_ROWS]
                yield pa.RecordBatch.from_arrays(
                    [titles.take(pa.array(lang[b])), *(names.take(pa.array(words[b, j])) for j in range(ORDER)),
                     pa.array(np.full(len(b), part, np.int32)), pa.array(counts[b])], schema=_WINDOW)
            used = np.unique(words[stay])
            used = used[used > 0]
            anew = np.zeros(len(spelled), np.int32)
            anew[used] = np.arange(1, len(used) + 1)
            known.clear()
            known.update((spelled[u], i) for i, u in enumerate(used.tolist(), 1))
            held.append((lang[stay], anew[words[stay]], counts[stay]))

        for seg in _segments_of(batches, langs):
            length = np.zeros(len(seg.code), np.int64)
            for k, ok, _buckets in _possible(seg, langs, tables, bits):
                length[:len(ok)] += ok
            length = length[:seg.starts]
            number = np.zeros(len(seg.names), np.int64)
            for k, lang, example, counts in _segment_windows(seg, length):
                words = np.zeros((len(lang), ORDER), np.int32)
                for j in range(k):
                    code = seg.code[example + j]
                    for c in np.unique(code[number[code] == 0]):
                        number[c] = known.setdefault(seg.names[c], len(known) + 1)
                    words[:, j] = number[code]
                held.append((lang, words, counts))
            if sum(len(h[0]) for h in held) > HELD_WINDOWS:
                held[:] = [_distinct(*(np.concatenate(x) for x in zip(*held)))]
                if len(held[0][0]) > HELD_WINDOWS // 2:
                    yield from out(HELD_WINDOWS // 4)
        if held:
            held[:] = [_distinct(*(np.concatenate(x) for x in zip(*held)))]
            yield from out(0)
    return run


# --- the sorted streams ------------------------------------------------------------------------

def _larger(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches put together to about ``STREAM_ROWS`` rows, none empty."""
    held, rows = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            rows += batch.num_rows
        if rows >= STREAM_ROWS:
            yield pa.Table.from_batches(held).combine_chunks()
            held, rows = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _differs(column: pa.ChunkedArray, before: object) -> np.ndarray:
    """Whether each value differs from the one before it."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    out = np.ones(len(flat), bool)
    out[1:] = pc.not_equal(flat.slice(1), flat.slice(0, len(flat) - 1)).to_numpy(zero_copy_only=False)
    out[0] = flat[0].as_py() != before
    return out


_NODE = pa.schema([("lang", pa.string()), *((w, pa.binary()) for w in WORDS), ("k", pa.int32()), ("n", pa.int64()),
                   ("ext", pa.int64()), ("open", pa.bool_())])
_NODE_DDL = f"{_KEY_DDL}, k int, n long, ext long, open boolean"


def _add_up(min_count: int):
    """Counts of all phrases that begin a window of the sorted partition.

    ``ext`` is the largest count among a phrase's right extensions.  Phrases
    of the partition's first and last window are ``open``: their counts and
    those of other partitions are still to be added.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the phrase open at each level: its words, count, best closed extension, whether it began the partition
        stack: list[list | None] = [None] * (ORDER + 1)
        last: list = [None] * (ORDER + 1)
        first = True

        def close(k: int, is_open: bool) -> Iterator[tuple]:
            """Close the phrases of level ``k`` and below, deepest first."""
            for j in range(ORDER, k - 1, -1):
                if stack[j] is not None:
                    words, count, ext, opening = stack[j]
                    if j and stack[j - 1] is not None:
                        stack[j - 1][2] = max(stack[j - 1][2], count)
                    if is_open or opening or j == 0 or count >= min_count:
                        yield (*words[:j + 1], *[b""] * (ORDER - j), j, count, ext, is_open or opening)
                    stack[j] = None

        for table in _larger(batches):
            cols = [table.column(c) for c in KEY]
            n = table.column("n").to_numpy()
            change, rows, parts = np.zeros(len(n), bool), [], []
            changes = []
            for j, c in enumerate(cols):
                change = change | _differs(c, last[j])
                changes.append(change)
            filled = [np.ones(len(n), bool)] + [pc.not_equal(c, b"").to_numpy() for c in cols[1:]]
            top = next((j for j in range(ORDER + 1) if changes[j][0]), ORDER + 1)
            rows += close(top, False)
            child: tuple[np.ndarray, np.ndarray] | None = None     # starts and counts of the level below
            for k in range(ORDER, -1, -1):
                begin = changes[k].copy()
                begin[0] = True
                begin = np.flatnonzero(begin)
                count = np.add.reduceat(n, begin)
                ext = np.zeros(len(begin), np.int64)
                real = filled[k][begin]
                if child is not None and len(child[0]):
                    np.maximum.at(ext, np.searchsorted(begin, child[0], side="right") - 1, child[1])
                if not changes[k][0] and stack[k] is not None:
                    count[0] += stack[k][1]
                    ext[0] = max(ext[0], stack[k][2])
                    opening = stack[k][3]
                else:
                    opening = first
                closed = real.copy()
                closed[-1] = False
                child = (begin[closed], count[closed])
                sure = closed & ((count >= min_count) | (k == 0))
                if opening and closed[0]:
                    sure[0] = False
                    rows.append((*(c[0].as_py() for c in cols[:k + 1]), *[b""] * (ORDER - k), k, int(count[0]),
                                 int(ext[0]), True))
                at = pa.array(begin[sure])
                if len(at):
                    none = pa.array([b""] * len(at), pa.binary())
                    parts.append(pa.Table.from_arrays(
                        [*(c.take(at) for c in cols[:k + 1]), *[none] * (ORDER - k), pa.array(np.full(len(at), k, np.int32)),
                         pa.array(count[sure]), pa.array(ext[sure]), pa.array(np.zeros(len(at), bool))], schema=_NODE))
                if real[-1]:
                    single = len(begin) == 1
                    stack[k] = [tuple(c[-1].as_py() for c in cols[:k + 1]), int(count[-1]), int(ext[-1]),
                                opening if single else False]
                else:
                    stack[k] = None
            last = [c[-1].as_py() for c in cols]
            first = False
            for t in parts:
                yield from t.to_batches()
            if rows:
                yield _record(list(zip(*rows)), _NODE)
        rows = list(close(0, True))
        if rows:
            yield _record(list(zip(*rows)), _NODE)
    return run


def _settle(nodes: DataFrame, min_count: int) -> DataFrame:
    """Frequent phrases (and each language's total, of no word): open records of several partitions added up."""
    parts = (nodes.filter("open").groupBy(*KEY, "k").agg(F.sum("n").alias("n"), F.max("ext").alias("ext")))
    parts = parts.persist(StorageLevel.DISK_ONLY)               # at most a dozen rows a partition
    above = parts.filter("k > 0").groupBy("lang", *(
        F.when(F.col("k") > j, F.col(w)).otherwise(F.lit(b"")).alias(w) for j, w in enumerate(WORDS, 1)),
        (F.col("k") - 1).alias("k")).agg(F.max("n").alias("best"))
    whole = (parts.join(above, [*KEY, "k"], "left")
             .withColumn("ext", F.greatest("ext", F.coalesce("best", F.lit(0)))).drop("best"))
    return (nodes.filter("not open").drop("open").unionByName(whole)
            .filter((F.col("n") >= min_count) | (F.col("k") == 0)))


def _in_order(rows: DataFrame, parts: int, by: list[str], then: list[str] = []) -> DataFrame:
    """A sorted stream: partitions by range of ``by``, sorted by ``by`` and ``then``, kept on the executors' disks."""
    return (rows.repartitionByRange(parts, *by).sortWithinPartitions(*by, *then).persist(StorageLevel.DISK_ONLY))


def _last_counts():
    """The last count of each phrase length in a partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        got: dict[int, int] = {}
        for table in _larger(batches):
            k, n = table.column("k").to_numpy(), table.column("n").to_numpy()
            for j in range(ORDER + 1):
                at = np.flatnonzero((k == j) & (n > 0))
                if len(at):
                    got[j] = int(n[at[-1]])
        if got:
            yield _record([[TaskContext.get().partitionId()] * len(got), list(got), list(got.values())], _LAST)
    return run


_LAST = pa.schema([("part", pa.int32()), ("k", pa.int32()), ("n", pa.int64())])


def _entering(stream: DataFrame) -> dict[int, list[int]]:
    """Per partition, the count of the last phrase of each length before it (six numbers a partition)."""
    rows = stream.select("k", "n").mapInArrow(_last_counts(), "part int, k int, n long").collect()
    now, out = [0] * (ORDER + 1), {}
    by_part: dict[int, list] = {}
    for r in rows:
        by_part.setdefault(r["part"], []).append(r)
    for p in range((max(by_part) if by_part else 0) + 1):
        out[p] = list(now)
        for r in by_part.get(p, ()):
            now[r["k"]] = r["n"]
    return out


def _latest(level: np.ndarray, n: np.ndarray, carry: list[int]) -> np.ndarray:
    """For each row and length the count of the last row of that length; ``carry`` is moved on."""
    out = np.empty((ORDER + 1, len(n)), np.int64)
    for j in range(ORDER + 1):
        at = np.maximum.accumulate(np.where(level == j, np.arange(len(n)), -1))
        out[j] = np.where(at >= 0, n[np.maximum(at, 0)], carry[j])
        carry[j] = int(out[j][-1])
    return out


_SUFFIX = pa.schema([("lang", pa.string()), *((w, pa.binary()) for w in WORDS), ("k", pa.int32()), ("n", pa.int64()),
                     ("ext", pa.int64()), *((f"s{j}", pa.int64()) for j in range(1, ORDER)), ("kind", pa.int32())])
_SUFFIX_DDL = f"{_KEY_DDL}, k int, n long, ext long, " + ", ".join(f"s{j} long" for j in range(1, ORDER)) + ", kind int"


def _suffix_counts(entering: dict[int, list[int]]):
    """Phrases with the counts of their suffixes (kind 1), and those a left extension replaces (kind 0)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        carry = list(entering.get(TaskContext.get().partitionId(), [0] * (ORDER + 1)))
        for t in _larger(batches):
            k, n = t.column("k").to_numpy(), t.column("n").to_numpy()
            seen = _latest(k, n, carry)
            suffixes = [pa.array(np.where(k > j, seen[j], 0)) for j in range(1, ORDER)]
            one = pa.array(np.ones(len(n), np.int32))
            yield from pa.Table.from_arrays([*(t.column(c) for c in KEY), t.column("k"), t.column("n"), t.column("ext"),
                                             *suffixes, one], schema=_SUFFIX).to_batches()
            at = np.flatnonzero((k >= 3) & (n == seen[np.maximum(k - 1, 0), np.arange(len(n))]))
            if len(at):
                gone = t.take(pa.array(at))
                zero = pa.array(np.zeros(len(at), np.int64))
                yield from pa.Table.from_arrays(
                    [gone.column("lang"), *(gone.column(w) for w in WORDS[1:]), pa.array([b""] * len(at), pa.binary()),
                     pa.array((k[at] - 1).astype(np.int32)), zero, zero, *[zero] * (ORDER - 1),
                     pa.array(np.zeros(len(at), np.int32))], schema=_SUFFIX).to_batches()
    return run


_SCORED = pa.schema([("lang", pa.string()), ("phrase", pa.string()), *((c, pa.int64()) for c in ("a", "l", "r", "n", "score"))])
_SCORED_DDL = "lang string, phrase string, a long, l long, r long, n long, score long"


def weakest_cut(a: int, n: int, left: list[int], right: list[int]) -> tuple[int, int]:
    """(score, number) of the lowest-scoring cut; ``left[i]`` and ``right[i]`` are the counts of its parts."""
    return min((1000 * a * n // (x * y), i) for i, (x, y) in enumerate(zip(left, right)))


def _score(entering: dict[int, list[int]]):
    """Prefix-order stream: left parts from the rows before, right parts from the suffix stream."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        carry = list(entering.get(TaskContext.get().partitionId(), [0] * (ORDER + 1)))
        replaced_before = False
        for t in _larger(batches):
            kind, k, n, ext = (t.column(c).to_numpy() for c in ("kind", "k", "n", "ext"))
            seen = _latest(np.where(kind == 1, k, -1), n, carry)
            replaced = np.concatenate(([replaced_before], kind[:-1] == 0))
            replaced_before = bool(kind[-1] == 0)
            at = np.flatnonzero((kind == 1) & (k >= 2) & ~replaced & (ext < n))
            if not len(at):
                continue
            prefixes = seen[:, at].T.tolist()
            suffixes = np.array([t.column(f"s{j}").to_numpy()[at] for j in range(1, ORDER)]).T.tolist()
            rows = []
            chosen = t.select(KEY).take(pa.array(at)).to_pydict()
            for i, (size, a, before, after) in enumerate(zip(k[at].tolist(), n[at].tolist(), prefixes, suffixes)):
                left, right = before[1:size], after[size - 2::-1]
                score, cut = weakest_cut(a, before[0], left, right)
                phrase = b" ".join(chosen[w][i] for w in WORDS[:size]).decode("utf-8", "replace")
                rows.append((chosen["lang"][i], phrase, a, left[cut], right[cut], before[0], score))
            yield _record(list(zip(*rows)), _SCORED)
    return run


# --- the operator ------------------------------------------------------------------------------

def scored_phrases(docs: DataFrame, min_count: int = 100, filter_bits: int | None = None,
                   text: str = "text", lang: str = "lang", readers: int | None = None) -> tuple[DataFrame, list[DataFrame]]:
    """All collocations ``(lang, phrase, a, l, r, n, score)``, and the persisted tables they are read from."""
    spark = docs.sparkSession
    texts = docs.select(utf8(quoted(text)).alias("text"),
                        F.coalesce(quoted(lang).cast("string"), F.lit("und")).alias("lang"))
    if filter_bits is None:
        filter_bits = table_bits(texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0)
    texts = texts.coalesce(readers or spark.sparkContext.defaultParallelism)
    # each broadcast is TABLES * 2 ** filter_bits bits
    short = spark.sparkContext.broadcast(_reached(texts, SHORT, dict, filter_bits, min_count))
    long = spark.sparkContext.broadcast(_reached(texts, LONG, lambda: _table(short, SHORT), filter_bits, min_count))
    windows = texts.mapInArrow(_windows(lambda: _table(short, SHORT) | _table(long, LONG), filter_bits), _WINDOW_DDL).persist(StorageLevel.DISK_ONLY)
    ordered = windows.repartitionByRange(*KEY, "part").sortWithinPartitions(*KEY)
    nodes = ordered.select(*KEY, "n").mapInArrow(_add_up(min_count), _NODE_DDL).persist(StorageLevel.DISK_ONLY)
    nodes.count()                       # fills the kept table once: two branches read it side by side
    found = _settle(nodes, min_count)
    parts = found.count() // PHRASES_PER_PARTITION + spark.sparkContext.defaultParallelism
    from_end = [f"r{j}" for j in range(1, ORDER + 1)]
    backwards = found.withColumns({r: F.when(F.col("k") >= j, F.element_at(F.array(*WORDS), F.greatest(F.col("k") - (j - 1), F.lit(1))))
                                   .otherwise(F.lit(b"")) for j, r in enumerate(from_end, 1)})
    by_suffix = _in_order(backwards, parts, ["lang", *from_end])
    suffixes = by_suffix.select(*KEY, "k", "n", "ext").mapInArrow(_suffix_counts(_entering(by_suffix)), _SUFFIX_DDL)
    by_prefix = _in_order(suffixes, parts, KEY, ["kind"])
    return by_prefix.mapInArrow(_score(_entering(by_prefix)), _SCORED_DDL), [windows, nodes, by_suffix, by_prefix]


def _table(bits, orders: tuple[int, ...]) -> dict[int, np.ndarray]:
    """The broadcast bits, eight counters a byte, as the tables that all ``orders`` share."""
    tables = bits.value.reshape(TABLES, -1)
    return {k: tables for k in orders}


def collocations(docs: DataFrame, min_count: int = 100, top: int = 2000, filter_bits: int | None = None,
                 text: str = "text", lang: str = "lang", readers: int | None = None) -> DataFrame:
    """Each language's first ``top`` collocations: ``(lang, rank, phrase, a, l, r, n, score)``.

    ``readers`` tasks at most read the text (the session's cores, if not given);
    ``filter_bits`` follows the bytes of text, if not given.
    """
    if min_count < 1 or top < 1 or filter_bits is not None and not 3 <= filter_bits <= 32:
        raise ValueError("min_count and top must be positive, filter_bits between 3 and 32")
    scored, held = scored_phrases(docs, min_count, filter_bits, text, lang, readers)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # a language may hold most rows: rank within 64 shares first
    share = F.pmod(F.xxhash64("phrase"), F.lit(64))
    some = (scored.withColumn("share", share)
            .withColumn("rank", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order)))
            .filter(F.col("rank") <= top).drop("share", "rank"))
    ranked = (some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
              .filter(F.col("rank") <= top)
              .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
    done = materialize(ranked.coalesce(8))
    for table in held:
        table.unpersist()
    return done

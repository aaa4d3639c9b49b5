"""Split search for one level of all trees: one Arrow pass, one shuffle.

``mapInArrow`` walks each batch of rows down the trees grown so far and
adds up, for every open node and every feature of its subset, the weight,
target and squared-target sums of each distinct value (or bin) the batch
holds.  These partial sums travel as packed blobs, one per (node, feature)
and batch, so the shuffle moves few rows; a grouped collect brings
a key's blobs together, an Arrow function merges them and scores every
threshold, and a grouped minimum leaves one split per node.

A key is a whole feature of a node, so this is for nodes of bounded size (or
for bins); :mod:`sylvan.operators.screened` searches large ones.

Open nodes are numbered by ``slot``.  Equal values are merged before a
threshold is scored; rows whose value is missing belong to the node totals
and go right.  A score is the children's SSE over the node's; scores within
``TIE`` of the best count as equal, and among those the smaller feature, then
the smaller threshold wins.

Sums do not depend on the order of their terms: each term is first rounded to
a whole multiple of a power of two (:func:`quantum`), chosen per node so that
all sums fit 64-bit integers.  Trees are therefore equal to the last bit for
any partitioning and batch size.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sylvan.functions import traverse

#: Scores closer than this are equal: far above rounding noise, far below
#: the step between neighbouring thresholds of a large node.
TIE = 1e-11
#: Heap ids (root 1, children 2k and 2k+1) hold so many levels.
MAX_HEAP_DEPTH = 62


@dataclass
class Frontier:
    """The trees of one pass, flattened, and their open nodes.

    Per tree ``off`` (and one end): its nodes in ``f``, ``t``, ``left``
    (-1: not split) and ``slot`` (-1: not open).  Per slot: ``subset``
    (which features are tried), the weight ``n``, the mean target ``mean``
    and the sum of squared deviations ``sse``.  All sums of a node are taken
    of the target less the node's mean, which keeps their digits, in multiples
    of ``us`` (weighted targets) and ``uq`` (their squares).
    """

    trees: np.ndarray
    off: np.ndarray
    f: np.ndarray
    t: np.ndarray
    left: np.ndarray
    slot: np.ndarray
    depth: int
    subset: np.ndarray
    n: np.ndarray
    mean: np.ndarray
    sse: np.ndarray
    us: np.ndarray
    uq: np.ndarray

    def sums_of(self, slot: np.ndarray, w: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The terms of both sums for rows of the given slots (``y``: target less the node's mean)."""
        return fixed(w * y, self.us[slot]), fixed(w * y * y, self.uq[slot])

    def floats(self, slot, sums: np.ndarray) -> np.ndarray:
        """Columns weight, sum and squared sum of the given slots as doubles."""
        return sums * np.column_stack([np.ones_like(self.us[slot]), self.us[slot], self.uq[slot]])

    def open_rows(self, x: np.ndarray, w: np.ndarray):
        """Yield (row numbers, slots, weights) of each tree's rows in open nodes."""
        flat, width = np.ascontiguousarray(x).ravel(), x.shape[1]
        bags = np.ascontiguousarray(w.T)
        for k, tree in enumerate(self.trees):
            a, b = self.off[k], self.off[k + 1]
            f, t, left, slot = self.f[a:b], self.t[a:b], self.left[a:b], self.slot[a:b]
            if not (slot >= 0).any():
                continue
            at = np.flatnonzero(bags[tree] > 0)
            node, begin = np.zeros(len(at), np.int64), at * width
            for _ in range(self.depth):
                child = left.take(node)
                go = child >= 0
                if not go.any():
                    break
                right = ~(flat.take(begin + f.take(node)) <= t.take(node))          # a missing value goes right
                node = np.where(go, child + right, node)
            s = slot.take(node)
            keep = s >= 0
            at = at[keep]
            yield at, s[keep], bags[tree].take(at).astype(np.float64)


def quantum(bound):
    """The power of two of which 2**60 to 2**61 make up ``bound`` (1 for 0): sums of its multiples
    that stay below four times the bound fit 64 bits.  (Deviations whose squares underflow count as 0.)"""
    exponent = np.frexp(bound)[1]
    return np.where(np.asarray(bound) > 0, np.ldexp(1.0, np.maximum(exponent - 61, -1000)), 1.0)


def quanta(n, room):
    """``(us, uq)`` of a node with weight ``n`` and squared deviations of at most ``room`` in all."""
    return quantum(np.sqrt(n * room)), quantum(room)


def fixed(v, unit) -> np.ndarray:
    """``v`` as whole multiples of ``unit``."""
    return np.rint(v / unit).astype(np.int64)


def room_below(n, room, sse):
    """Bound on a child's squared deviations: its computed ``sse`` and what rounding in
    its parent (weight ``n``, bound ``room``) can have hidden."""
    return sse + room * np.maximum(2.0 ** -40, n * 2.0 ** -58)


def sse(n, s, q):
    return np.maximum(q - s * s / n, 0.0)


def score(lw, ls, lq, n, total) -> np.ndarray:
    """SSE of both children over the node's (``total``)."""
    child = sse(lw, ls, lq) + sse(n - lw, -ls, total - lq)
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.where(total > 0, child / total, 0.0)


def _starts(*keys: np.ndarray) -> np.ndarray:
    """First positions of the runs of equal keys."""
    change = np.zeros(len(keys[0]), bool)
    change[:1] = True
    for k in keys:
        change[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(change)


def _columns(rb: pa.RecordBatch, nf: int, nt: int):
    return (traverse.list_matrix(rb.column("x"), nf, np.float64),
            traverse.list_matrix(rb.column("w"), nt, np.int8),
            rb.column("yc").to_numpy(zero_copy_only=False))


_SUMS = pa.schema([("slot", pa.int32()), ("feature", pa.int32()), ("ymin", pa.float64()),
                   ("ymax", pa.float64()), ("sums", pa.binary())])
SUMS = "slot int, feature int, ymin double, ymax double, sums binary"


def _partial_sums(front, nf: int, nt: int, binned: bool):
    def run(batches):
        fr = front.value
        for rb in batches:
            x, w, y = _columns(rb, nf, nt)
            xb = traverse.list_matrix(rb.column("xb"), nf, np.int32) if binned else None
            parts = []
            # rows in value order, once per feature: a tree then only needs a stable sort by slot
            ordered = [np.argsort(x[:, f], kind="stable") for f in range(nf)]
            known = ~np.isnan(x)
            narrow = np.int16 if len(fr.n) < 1 << 15 else np.int64
            for at, slot, ww in fr.open_rows(x, w):
                yy = y[at] - fr.mean[slot]
                terms = (ww.astype(np.int64), *fr.sums_of(slot, ww, yy))
                order = np.argsort(slot, kind="stable")
                first = _starts(slot[order])
                if not len(first):
                    continue
                k = len(first)               # the node's target range, beside any feature
                parts.append((slot[order][first], np.full(k, -1),
                              np.minimum.reduceat(yy[order], first), np.maximum.reduceat(yy[order], first),
                              np.zeros(k, np.int64), np.zeros((0, 4), np.int64)))
                where = np.full(len(x), -1)
                where[at] = np.arange(len(at))
                for f in range(nf):
                    use = known[at, f] & fr.subset[slot, f]
                    if not use.any():
                        continue
                    wanted = np.zeros(len(x), bool)
                    wanted[at[use]] = True
                    r = ordered[f][wanted[ordered[f]]]
                    mine = where[r]
                    o = np.argsort(slot[mine].astype(narrow), kind="stable")
                    r, mine = r[o], mine[o]
                    sl = slot[mine]
                    v = xb[r, f].astype(np.float64) if binned else x[r, f]
                    cell = _starts(sl, v)
                    sums = np.column_stack([v[cell].view(np.int64),
                                            *(np.add.reduceat(c[mine], cell) for c in terms)])
                    group = _starts(sl[cell])
                    size = np.diff(np.append(group, len(cell)))
                    k = len(group)
                    parts.append((sl[cell[group]], np.full(k, f), np.full(k, np.inf), np.full(k, -np.inf), size, sums))
            if not parts:
                continue
            cols = [np.concatenate(c) for c in zip(*parts)]
            ends = np.concatenate(([0], np.cumsum(cols[4]))).astype(np.int64) * 32
            blob = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cols[0]),
                                                    [None, pa.py_buffer(ends), pa.py_buffer(
                                                        np.ascontiguousarray(cols[5], np.int64))])
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, f.type) for c, f in zip(cols[:4], _SUMS)), blob.cast(pa.binary())], schema=_SUMS)
    return run


_SPLIT = "struct<score: double, threshold: double, lw: double, ls: double, lq: double>"


def _best_of_key(front, min_leaf: float, binned: bool):
    """Arrow function: the best threshold among a key's merged sums."""
    def run(slot: pa.Array, sums: pa.Array) -> pa.Array:
        fr = front.value
        slots = slot.to_numpy(zero_copy_only=False)
        out = np.full((len(slots), 5), np.nan)
        flat = sums.flatten()                 # a key's blobs lie side by side in one buffer
        ends = np.frombuffer(flat.buffers()[1], np.int32)[flat.offset:flat.offset + len(flat) + 1]
        raw = np.frombuffer(flat.buffers()[2] or b"", np.uint8)
        blobs = sums.offsets.to_numpy() - (sums.offsets[0].as_py() if len(sums) else 0)
        for i in range(len(slots)):
            m = raw[ends[blobs[i]]:ends[blobs[i + 1]]].view(np.int64).reshape(-1, 4)
            if not len(m):
                continue
            v, m = np.ascontiguousarray(m[:, 0]).view(np.float64), m[:, 1:]
            if blobs[i + 1] - blobs[i] > 1:
                order = np.argsort(v, kind="stable")
                v = v[order]
                cell = _starts(v)
                v, m = v[cell], np.add.reduceat(m[order], cell)
            following = np.append(v[1:], np.nan)
            if binned:
                cut = v
            else:        # adjacent doubles: their midpoint may be the next value, so stay below it
                with np.errstate(over="ignore"):
                    mid = v / 2 + following / 2
                cut = np.where((mid >= v) & (mid < following), mid, v)
            left = fr.floats(slots[i:i + 1], np.cumsum(m, axis=0))
            tw, total = fr.n[slots[i]], fr.sse[slots[i]]
            ok = np.flatnonzero(~np.isnan(following) & (left[:, 0] >= min_leaf) & (tw - left[:, 0] >= min_leaf))
            if not len(ok):
                continue
            lw, ls, lq = left[ok].T
            r = score(lw, ls, lq, tw, total)
            j = int(np.argmax(r <= r.min() + TIE))       # thresholds ascend: the smallest of the best
            out[i] = r.min(), cut[ok][j], lw[j], ls[j], lq[j]
        bad = np.isnan(out[:, 0])
        return pa.StructArray.from_arrays([pa.array(c) for c in out.T],
                                          ["score", "threshold", "lw", "ls", "lq"], mask=pa.array(bad))
    return run


def best_splits(state: DataFrame, front, nf: int, nt: int, min_leaf: float, binned: bool = False) -> DataFrame:
    """``slot, ymin, ymax, feature, threshold, lw, ls, lq`` of every open node.

    ``feature`` is null where no threshold leaves ``min_leaf`` on both sides.
    """
    cols = ["x", "w", "yc"] + (["xb"] if binned else [])
    part = state.select(*cols).mapInArrow(_partial_sums(front, nf, nt, binned), SUMS)
    merged = part.groupBy("slot", "feature").agg(F.min("ymin").alias("ymin"), F.max("ymax").alias("ymax"),
                                                 F.collect_list("sums").alias("sums"))
    best = F.arrow_udf(_best_of_key(front, float(min_leaf), binned), _SPLIT)
    scored = merged.withColumn("c", best("slot", "sums"))
    keys_best = (scored.groupBy("slot").agg(
        F.min("ymin").alias("ymin"), F.max("ymax").alias("ymax"), F.min("c.score").alias("least"),
        F.collect_list(F.when(F.col("c").isNotNull(), F.struct(
            "feature", "c.threshold", "c.lw", "c.ls", "c.lq", "c.score"))).alias("all")))
    best_of = F.array_min(F.filter("all", lambda c: c["score"] <= F.col("least") + F.lit(TIE)))
    return keys_best.select("slot", "ymin", "ymax", best_of.alias("best")).select(
        "slot", "ymin", "ymax", "best.feature", "best.threshold", "best.lw", "best.ls", "best.lq")


def exact_mean(df: DataFrame, y: str) -> tuple[int, float]:
    """Rows and mean of a column without nulls, the same for any partitioning."""
    g = df.agg(F.count(F.lit(1)).alias("n"), F.max(F.abs(F.col(y))).alias("top")).first()
    n, unit = int(g["n"]), float(quantum(float(g["n"]) * float(g["top"] or 0.0)))
    if not n:
        return n, 0.0
    total = df.agg(F.sum(F.rint(F.col(y) / F.lit(unit)).cast("long")).alias("s")).first()["s"]
    return n, total * unit / n


def tree_sums(state: DataFrame, nt: int) -> list[tuple]:
    """T1 at the roots: ``(tree_id, n, s, q, room)`` of every tree's bag, in two passes
    (weights and the largest target, which fix the rounding; then the sums)."""
    def arrays(rb: pa.RecordBatch):
        return (traverse.list_matrix(rb.column("w"), nt, np.int8).astype(np.float64),
                rb.column("yc").to_numpy(zero_copy_only=False))
    ids = pa.array(np.arange(nt, dtype=np.int32))

    def weights(batches):
        for rb in batches:
            w, y = arrays(rb)
            top = np.abs(np.where(w > 0, y[:, None], 0.0)).max(0, initial=0.0)
            yield pa.RecordBatch.from_arrays([ids, pa.array(w.sum(0)), pa.array(top)], ["tree_id", "n", "top"])
    n, room = np.zeros(nt), np.zeros(nt)
    for r in (state.select("w", "yc").mapInArrow(weights, "tree_id int, n double, top double").groupBy("tree_id")
              .agg(F.sum("n").alias("n"), F.max("top").alias("top")).collect()):
        n[r["tree_id"]], room[r["tree_id"]] = r["n"], r["n"] * r["top"] ** 2
    us, uq = quanta(n, room)

    def sums(batches):
        for rb in batches:
            w, y = arrays(rb)
            terms = w * y[:, None]
            yield pa.RecordBatch.from_arrays(
                [ids, *(pa.array(v.sum(0)) for v in (fixed(terms, us), fixed(terms * y[:, None], uq)))],
                ["tree_id", "s", "q"])
    return [(t, float(n[t]), s * float(us[t]), q * float(uq[t]), float(room[t])) for t, s, q in
            (state.select("w", "yc").mapInArrow(sums, "tree_id int, s long, q long").groupBy("tree_id")
             .agg(F.sum("s").alias("s"), F.sum("q").alias("q")).collect())]


# ---- drawn thresholds -------------------------------------------------------

def _ranges(front, nf: int, nt: int, target_only: bool):
    def run(batches):
        fr = front.value
        for rb in batches:
            x, w, y = _columns(rb, nf, nt)
            parts = []
            for at, slot, _ in fr.open_rows(x, w):
                for f in (-1,) if target_only else (-1, *range(nf)):
                    v = y[at] if f < 0 else x[at, f]
                    use = np.ones(len(at), bool) if f < 0 else fr.subset[slot, f] & ~np.isnan(v)
                    o = np.argsort(slot[use], kind="stable")
                    sl, v = slot[use][o], v[use][o]
                    first = _starts(sl) if len(sl) else []
                    if len(first):
                        parts.append((sl[first], np.full(len(first), f), np.minimum.reduceat(v, first),
                                      np.maximum.reduceat(v, first)))
            if parts:
                a = [np.concatenate(c) for c in zip(*parts)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a[0], pa.int32()), pa.array(a[1], pa.int32()), pa.array(a[2]), pa.array(a[3])],
                    ["slot", "feature", "vmin", "vmax"])
    return run


def value_ranges(state: DataFrame, front, nf: int, nt: int, target_only: bool = False) -> DataFrame:
    """``slot, feature, vmin, vmax`` over each open node; feature -1 stands for the target."""
    return (state.select("x", "w", "yc")
            .mapInArrow(_ranges(front, nf, nt, target_only), "slot int, feature int, vmin double, vmax double")
            .groupBy("slot", "feature").agg(F.min("vmin").alias("vmin"), F.max("vmax").alias("vmax")))


def _left_sums(front, draws, nf: int, nt: int):
    def run(batches):
        fr, (feature, cut) = front.value, draws.value
        width = feature.shape[1]
        for rb in batches:
            x, w, y = _columns(rb, nf, nt)
            total = np.zeros((3, len(feature) * width), np.int64)
            for at, slot, ww in fr.open_rows(x, w):
                terms = (ww.astype(np.int64), *fr.sums_of(slot, ww, y[at] - fr.mean[slot]))
                for c in range(width):
                    f = feature[slot, c]
                    go = np.flatnonzero((f >= 0) & (x[at, np.maximum(f, 0)] <= cut[slot, c]))
                    k = slot[go] * width + c
                    for i, v in enumerate(terms):
                        np.add.at(total[i], k, v[go])
            k = np.flatnonzero(total[0] > 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(k // width, pa.int32()), pa.array(k % width, pa.int32()), *(pa.array(t[k]) for t in total)],
                ["slot", "cand", "lw", "ls", "lq"])
    return run


def left_sums(state: DataFrame, front, draws, nf: int, nt: int) -> list[tuple]:
    """``(slot, cand, lw, ls, lq)``: sums left of each drawn threshold.

    ``draws``: broadcast (feature, threshold) matrices, slots x draws, with
    feature -1 where there is no draw.
    """
    us, uq = front.value.us, front.value.uq
    return [(slot, cand, float(w), s * float(us[slot]), q * float(uq[slot])) for slot, cand, w, s, q in
            state.select("x", "w", "yc")
            .mapInArrow(_left_sums(front, draws, nf, nt), "slot int, cand int, lw long, ls long, lq long")
            .groupBy("slot", "cand").agg(F.sum("lw"), F.sum("ls"), F.sum("lq")).collect()]


# ---- rows of open nodes, for splitters from outside ----------------------------

def _rows_of(front, nf: int, nt: int):
    def run(batches):
        fr = front.value
        for rb in batches:
            x, w, y = _columns(rb, nf, nt)
            for at, slot, ww in fr.open_rows(x, w):
                if len(at):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(slot, pa.int32()), pa.array(ww), pa.array(y[at] - fr.mean[slot]),
                         rb.column("x").take(pa.array(at))], ["slot", "w", "yc", "x"])
    return run


def open_rows(state: DataFrame, front, nf: int, nt: int) -> DataFrame:
    """``slot, w, yc, x``: every training row in every open node it belongs to."""
    return state.select("x", "w", "yc").mapInArrow(_rows_of(front, nf, nt),
                                                   "slot int, w double, yc double, x array<double>")


def _values_of(front, nf: int, nt: int):
    def run(batches):
        fr = front.value
        for rb in batches:
            x, w, y = _columns(rb, nf, nt)
            known = ~np.isnan(x)
            for at, slot, ww in fr.open_rows(x, w):
                yc = y[at] - fr.mean[slot]
                for f in range(nf):
                    k = np.flatnonzero(known[at, f] & fr.subset[slot, f])
                    if len(k):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(slot[k], pa.int32()), pa.array(np.full(len(k), f, np.int32)), pa.array(ww[k]),
                             pa.array(yc[k]), pa.array(x[at[k], f])], ["slot", "feature", "w", "yc", "v"])
    return run


def open_values(state: DataFrame, front, nf: int, nt: int) -> DataFrame:
    """``slot, feature, w, yc, v``: every training row's value of every feature that its open nodes may use."""
    return state.select("x", "w", "yc").mapInArrow(_values_of(front, nf, nt),
                                                   "slot int, feature int, w double, yc double, v double")

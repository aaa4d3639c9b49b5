"""Exact split search over sorted streams (T3): no key's values meet in one cell.

The sums of each distinct (open node, feature, value) leave the Arrow pass as
plain rows, are range partitioned by those three columns and sorted.  A first
pass over a partition notes its ends: first and last key, the first value and
the sums of the last key.  What a partition needs from those before it (the
sums of the key it begins within) and from the next one (the value that
follows its last) are a few numbers a partition.  A second pass streams the
sorted rows with a running prefix sum and scores every threshold; whatever a
node or a feature holds, a task keeps one Arrow batch.

A batch emits, per key, the thresholds whose score is below all before it in
the batch and within ``TIE`` of the batch's best: the first threshold within
``TIE`` of the whole key's best is always among them.  The result is that of
:func:`sylvan.operators.levels.best_splits`, to the bit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sylvan.operators.levels import TIE, _columns, _starts, score

_CELL = pa.schema([("slot", pa.int32()), ("feature", pa.int32()), ("v", pa.float64()), ("w", pa.int64()),
                   ("s", pa.int64()), ("q", pa.int64())])
CELL = "slot int, feature int, v double, w long, s long, q long"
#: Feature id of the rows that carry a node's target range as values.
TARGET = -1


def _table(schema: pa.Schema, cols) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)


def _cells(front, nf: int, nt: int):
    """Rows of ``CELL`` per distinct value of a batch and tree, one batch out per tree and feature."""
    def run(batches):
        fr = front.value
        for rb in batches:
            x, w, y = _columns(rb, nf, nt)
            for at, slot, ww in fr.open_rows(x, w):
                if not len(at):
                    continue
                yy = y[at] - fr.mean[slot]
                terms = (ww.astype(np.int64), *fr.sums_of(slot, ww, yy))
                order = np.lexsort((yy, slot))
                first = _starts(slot[order])
                last = np.append(first[1:], len(order)) - 1
                ends = np.concatenate([order[first], order[last]])
                nothing = np.zeros(len(ends), np.int64)
                yield _table(_CELL, (slot[ends], np.full(len(ends), TARGET), yy[ends], nothing, nothing, nothing))
                for f in range(nf):
                    use = np.flatnonzero(~np.isnan(x[at, f]) & fr.subset[slot, f])
                    if not len(use):
                        continue
                    v = x[at[use], f] + 0.0          # one zero
                    o = np.lexsort((v, slot[use]))
                    use, v = use[o], v[o]
                    cell = _starts(slot[use], v)
                    yield _table(_CELL, (slot[use][cell], np.full(len(cell), f), v[cell],
                                         *(np.add.reduceat(t[use], cell) for t in terms)))
    return run


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Sorted cells with equal (slot, feature, value) added up: (slot, feature, v, sums) with three
    columns of sums; the last cell of a batch waits for the next."""
    held = None
    for rb in batches:
        if not rb.num_rows:
            continue
        slot, feature, v, *sums = (c.to_numpy(zero_copy_only=False) for c in rb.columns)
        cells = (slot, feature, v, np.column_stack(sums))
        if held is not None:
            cells = tuple(np.concatenate(c) for c in zip(held, cells))
        at = _starts(*cells[:3])
        cells = (*(c[at] for c in cells[:3]), np.add.reduceat(cells[3], at))
        if len(at) > 1:
            yield tuple(c[:-1] for c in cells)
        held = tuple(c[-1:] for c in cells)
    if held is not None:
        yield held


_ENDS = pa.schema([("part", pa.int32()), ("slot", pa.int32()), ("feature", pa.int32()), ("v", pa.float64()),
                   ("last_slot", pa.int32()), ("last_feature", pa.int32()), ("w", pa.int64()), ("s", pa.int64()),
                   ("q", pa.int64()), ("one_key", pa.bool_())])
ENDS = ("part int, slot int, feature int, v double, last_slot int, last_feature int, "
        "w long, s long, q long, one_key boolean")


def _ends(batches):
    """One row per partition with rows: its first cell, its last key and that key's sums."""
    from pyspark import TaskContext
    first, key, sums, one = None, None, np.zeros(3, np.int64), True
    for slot, feature, v, m in _merged(batches):
        if first is None:
            first = key = (int(slot[0]), int(feature[0]))
            value = v[0]
        last = (int(slot[-1]), int(feature[-1]))
        mine = m[(slot == last[0]) & (feature == last[1])].sum(0)
        sums = sums + mine if last == key else mine
        one &= last == first
        key = last
    if first is None:
        return
    yield _table(_ENDS, [[c] for c in (TaskContext.get().partitionId(), *first, value, *key, *sums, one)])


def _neighbours(ends: list) -> dict[int, tuple]:
    """Per partition: sums of its first key in those before it, and the cell that follows its last."""
    out, carry, key = {}, np.zeros(3, np.int64), None
    ends = sorted(ends, key=lambda r: r["part"])
    for i, r in enumerate(ends):
        mine = (r["slot"], r["feature"])
        before = carry if mine == key else np.zeros(3, np.int64)
        nxt = ends[i + 1] if i + 1 < len(ends) else None
        out[r["part"]] = (before, None if nxt is None else (nxt["slot"], nxt["feature"], nxt["v"]))
        sums = np.array([r["w"], r["s"], r["q"]], np.int64)
        carry = before + sums if r["one_key"] else sums
        key = (r["last_slot"], r["last_feature"])
    return out


_FOUND = pa.schema([("slot", pa.int32()), ("feature", pa.int32()), ("score", pa.float64()), ("threshold", pa.float64()),
                    ("lw", pa.float64()), ("ls", pa.float64()), ("lq", pa.float64())])
FOUND = "slot int, feature int, score double, threshold double, lw double, ls double, lq double"


def _ahead(batches: Iterator[tuple], after: tuple | None) -> Iterator[tuple[tuple, tuple | None]]:
    """Each batch with the (slot, feature, value) that follows its last cell."""
    held = None
    for m in batches:
        if held is not None:
            yield held, tuple(c[0] for c in m[:3])
        held = m
    if held is not None:
        yield held, after


def _thresholds(front, neighbours, min_leaf: float):
    """Second pass.  For the target rows ``threshold`` is a batch's least value and ``lw`` its largest."""
    def run(batches):
        from pyspark import TaskContext
        fr = front.value
        carry, after = neighbours.value.get(TaskContext.get().partitionId(), (np.zeros(3, np.int64), None))
        key = None                  # the key that ``carry`` belongs to; None: the partition's first
        for (slot, feature, v, m), nxt in _ahead(_merged(batches), after):
            if key is not None and key != (slot[0], feature[0]):
                carry = np.zeros(3, np.int64)
            begin = _starts(slot, feature)
            end = np.append(begin[1:], len(m))
            rows = []
            for a, b in zip(begin, end):
                s, f = int(slot[a]), int(feature[a])
                if f == TARGET:
                    rows.append((s, f, None, v[a], v[b - 1], 0.0, 0.0))
                    summed = np.zeros((1, 3), np.int64)
                    continue
                summed = m[a:b].cumsum(0) + (carry if a == 0 else 0)
                left = fr.floats(slot[a:a + 1], summed)
                following = np.append(v[a + 1:b], np.nan)
                if b == len(m) and nxt is not None and (int(nxt[0]), int(nxt[1])) == (s, f):
                    following[-1] = nxt[2]
                with np.errstate(over="ignore"):
                    mid = v[a:b] / 2 + following / 2
                cut = np.where((mid >= v[a:b]) & (mid < following), mid, v[a:b])
                total = fr.n[s]
                ok = np.flatnonzero(~np.isnan(following) & (left[:, 0] >= min_leaf) & (total - left[:, 0] >= min_leaf))
                if len(ok):
                    lw, ls, lq = left[ok].T
                    r = score(lw, ls, lq, total, fr.sse[s])
                    lowest = np.minimum.accumulate(r)
                    new = np.concatenate(([True], r[1:] < lowest[:-1])) & (r <= lowest[-1] + TIE)
                    rows += [(s, f, r[j], cut[ok[j]], lw[j], ls[j], lq[j]) for j in np.flatnonzero(new)]
            carry, key = summed[-1], (int(slot[-1]), int(feature[-1]))
            if rows:
                yield _table(_FOUND, list(zip(*rows)))
    return run


def best_splits(state: DataFrame, front, nf: int, nt: int, min_leaf: float, partitions: int | None = None) -> list:
    """Rows ``slot, ymin, ymax, feature, threshold, lw, ls, lq`` of every open node, as
    :func:`sylvan.operators.levels.best_splits` gives them."""
    spark = state.sparkSession
    width = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cells = (state.select("x", "w", "yc").mapInArrow(_cells(front, nf, nt), CELL)
             .repartitionByRange(width, "slot", "feature", "v").sortWithinPartitions("slot", "feature", "v")
             .persist(StorageLevel.DISK_ONLY))
    shared = None
    try:
        shared = spark.sparkContext.broadcast(_neighbours(cells.mapInArrow(_ends, ENDS).collect()))
        found = cells.mapInArrow(_thresholds(front, shared, float(min_leaf)), FOUND)
        one = F.struct("threshold", "lw", "ls", "lq", "score")
        by_key = found.groupBy("slot", "feature").agg(
            F.min("score").alias("least"), F.min("threshold").alias("low"), F.max("lw").alias("high"),
            F.collect_list(one).alias("all"))       # per batch the few thresholds within TIE of its best
        first = F.array_min(F.filter("all", lambda c: c["score"] <= F.col("least") + F.lit(TIE)))
        target = F.col("feature") == F.lit(TARGET)
        by_key = by_key.select("slot", F.when(target, F.col("low")).alias("low"), F.when(target, F.col("high")).alias("high"),
                               F.when(~target, F.struct("feature", first.alias("c"), "least")).alias("best"))
        by_slot = by_key.groupBy("slot").agg(F.max("low").alias("ymin"), F.max("high").alias("ymax"),
                                             F.min("best.least").alias("least"),
                                             F.collect_list("best").alias("all"))       # one per feature
        best = F.array_min(F.filter("all", lambda c: c["least"] <= F.col("least") + F.lit(TIE)))
        return (by_slot.withColumn("best", best)
                .select("slot", "ymin", "ymax", "best.feature", "best.c.threshold", "best.c.lw", "best.c.ls", "best.c.lq")
                .collect())
    finally:
        cells.unpersist()
        if shared is not None:
            shared.destroy()

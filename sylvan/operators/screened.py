"""Exact split search of large nodes: sums per bin first, single values only where they can matter.

:func:`sylvan.operators.levels.best_splits` ships the sums of every distinct
value.  Here a first pass over the rows adds up, per open node and feature,
the sums of at most ``CELLS`` quantile bins in all (a table of bounded size);
from it the driver knows the exact score of every threshold between two bins
and a bound on those within a bin.  The children's squared error is the
node's less ``ls**2 / lw + ls**2 / (n - lw)``, which is convex in the left
weight and sum, so within a bin it is at most its value at a corner of what
these can be: the sums below the bin plus none to all of the bin's weight and
of its positive or negative targets.  Bins that can't hold a threshold within
``TIE`` of the best are done with.  The values of all others are shuffled by a
second pass, in groups of about ``GROUP_ROWS`` rows (or one bin), and searched
exactly.  No threshold is left out that could win: a bin is only passed over
when its bound proves it, and all bins are searched where none can be.

Sums are those of :mod:`sylvan.operators.levels`, in 64-bit fixed point, so
splits do not depend on bins, partitions or batches.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sylvan.functions import traverse
from sylvan.operators import levels

#: Bins of all open nodes and their features together, at most about.
CELLS = 1 << 17
#: Rows of a group of searched bins, at most about (one bin may have more).
GROUP_ROWS = 200_000
#: Rows a task holds before it merges equal values.
HELD_ROWS = 200_000
#: Far above the rounding of a score, in shares of the node's squared error.
MARGIN = 1e-9


@dataclass
class Layout:
    """Where the bins of a node and feature lie: ``features`` (slots x tried features, -1: none),
    ``bins`` per slot, ``base`` (first cell per slot), ``fine`` (bins of the state's column ``xb``)."""

    features: np.ndarray
    bins: np.ndarray
    base: np.ndarray
    fine: int
    size: int

    @property
    def tried(self) -> int:
        return self.features.shape[1]

    def cells(self, slot: np.ndarray, j: int, xb: np.ndarray) -> np.ndarray:
        bins = self.bins.take(slot)
        shift = self.fine.bit_length() - 1
        part = xb * bins
        return self.base.take(slot) + j * bins + (part >> shift if self.fine == 1 << shift else part // self.fine)


def layout(front: levels.Frontier, fine: int, cells: int = CELLS) -> Layout:
    """Bins in proportion to the nodes' rows, one at least and ``fine`` at most."""
    tried = max(int(front.subset.sum(1).max()), 1)
    order = np.argsort(~front.subset, axis=1, kind="stable")[:, :tried]
    features = np.where(np.take_along_axis(front.subset, order, 1), order, -1)
    bins = np.clip((front.n / max(front.n.sum(), 1.0) * (cells / tried)).astype(np.int64), 1, fine)
    ends = np.concatenate([[0], np.cumsum(bins * tried)])
    return Layout(features, bins, ends[:-1], fine, int(ends[-1]))


def _placed(fr, la: Layout, rb: pa.RecordBatch, nf: int, nt: int):
    """Per tree: slots, weights and targets of its rows, and for each tried feature
    (which rows have a value, the values, their cells)."""
    x, w, y = levels._columns(rb, nf, nt)
    values, bins = np.ascontiguousarray(x).ravel(), traverse.list_matrix(rb.column("xb"), nf, np.int32).ravel()
    for at, slot, ww in fr.open_rows(x, w):
        if not len(at):
            continue
        places = []
        for j in range(la.tried):
            f = la.features[:, j].take(slot)
            tried = np.flatnonzero(f >= 0)
            place = at * nf + f if len(tried) == len(at) else at[tried] * nf + f[tried]
            v = values.take(place)
            known = np.flatnonzero(~np.isnan(v))
            if len(known) < len(v):
                tried, place, v = tried[known], place[known], v[known]
            if len(tried):
                places.append((tried, v, la.cells(slot[tried], j, bins.take(place).astype(np.int64))))
        yield slot, ww, y[at] - fr.mean.take(slot), places


_BINS = pa.schema([("cell", pa.int32()), *((c, pa.int64()) for c in ("w", "s", "q", "up")),
                   ("low", pa.float64()), ("high", pa.float64())])


def _bin_sums(front, plan, nf: int, nt: int):
    """Sums and value range per bin, then (cells from ``size`` on) the target range per slot."""
    def run(batches):
        fr, la = front.value, plan.value
        cells = la.size + len(fr.n)
        sums = np.zeros((4, cells), np.int64)
        low, high = np.full(cells, np.inf), np.full(cells, -np.inf)
        for rb in batches:
            for slot, ww, yy, places in _placed(fr, la, rb, nf, nt):
                terms = (ww.astype(np.int64), *fr.sums_of(slot, ww, yy))
                np.minimum.at(low, la.size + slot, yy)
                np.maximum.at(high, la.size + slot, yy)
                parts = (*terms, np.maximum(terms[1], 0))
                for use, v, cell in places:
                    for total, part in zip(sums, parts):
                        np.add.at(total, cell, part if len(use) == len(part) else part[use])
                    np.minimum.at(low, cell, v)
                    np.maximum.at(high, cell, v)
        seen = np.flatnonzero(low < np.inf)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip((seen, *(t[seen] for t in sums), low[seen], high[seen]), _BINS)],
            schema=_BINS)
    return run


def _cut(v: np.ndarray, following: np.ndarray) -> np.ndarray:
    """The threshold between neighbouring values: the midpoint, or the lower one if they are adjacent doubles."""
    with np.errstate(over="ignore"):
        mid = v / 2 + following / 2
    return np.where((mid >= v) & (mid < following), mid, v)


def _scores(left: np.ndarray, n: np.ndarray, sse: np.ndarray, ok: np.ndarray) -> np.ndarray:
    """Scores of left sums (weight, sum, squares), infinite where not ``ok``."""
    r = np.full(len(left), np.inf)
    r[ok] = levels.score(*left[ok].T, n[ok], sse[ok])
    return r


@dataclass
class Bins:
    """The filled bins in order: their cell, slot and feature, sums below and own, and value range."""

    cell: np.ndarray
    slot: np.ndarray
    feature: np.ndarray
    below: np.ndarray
    own: np.ndarray
    up: np.ndarray
    low: np.ndarray
    high: np.ndarray
    following: np.ndarray       # the next bin's least value (none: NaN)


def _bins(la: Layout, t: pa.Table) -> Bins:
    t = t.filter(pc.less(t["cell"], la.size)).sort_by("cell")
    cell, w, s, q, up, low, high = (t[c].to_numpy() for c in _BINS.names)
    cell = cell.astype(np.int64)
    slot = np.searchsorted(la.base, cell, side="right") - 1
    j = (cell - la.base[slot]) // la.bins[slot]
    own = np.column_stack([w, s, q])
    run = np.cumsum(own, axis=0) - own          # wraps around between nodes, which differences undo
    key = slot * la.tried + j
    first = levels._starts(key)
    below = run - np.repeat(run[first], np.diff(np.append(first, len(key))), axis=0)
    following = np.full(len(key), np.nan)
    same = np.flatnonzero(key[1:] == key[:-1])
    following[same] = low[same + 1]
    return Bins(cell, slot, la.features[slot, j], below, own, up, low, high, following)


def _may_hold(fr, b: Bins, least: np.ndarray, min_leaf: float) -> np.ndarray:
    """Bins within which a threshold may score as well as the node's best between bins (``least``)."""
    n, total = fr.n[b.slot], fr.sse[b.slot]
    lo = np.maximum(b.below[:, 0] + 1.0, min_leaf)
    hi = np.minimum(b.below[:, 0] + b.own[:, 0] - 1.0, n - min_leaf)
    unit = fr.us[b.slot]
    top, bottom = (b.below[:, 1] + b.up) * unit, (b.below[:, 1] + b.own[:, 1] - b.up) * unit
    with np.errstate(invalid="ignore", divide="ignore"):
        gain = np.maximum(top ** 2, bottom ** 2) * np.maximum(n / (lo * (n - lo)), n / (hi * (n - hi)))
        close = gain >= total * (1.0 - least[b.slot] - levels.TIE - MARGIN)
    return (b.low < b.high) & (lo <= hi) & ((total <= 0) | close)


_ROWS = pa.schema([("g", pa.int32()), ("cell", pa.int32()), ("v", pa.float64()), *((c, pa.int64()) for c in "wsq")])


def _kept_rows(front, plan, group, nf: int, nt: int):
    """Sums per value of the bins that have a group."""
    def merged(held):
        cell, v, *terms = (np.concatenate(c) for c in zip(*held))
        order = np.lexsort((v, cell))
        cell, v = cell[order], v[order]
        first = levels._starts(cell, v)
        cols = (group.value[cell[first]], cell[first], v[first], *(np.add.reduceat(t[order], first) for t in terms))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _ROWS)], schema=_ROWS)

    def run(batches):
        fr, la, held, n = front.value, plan.value, [], 0
        # features of a node without a kept bin are not tried again
        begin = (la.base[:, None] + np.arange(la.tried) * la.bins[:, None]).ravel()
        kept = np.logical_or.reduceat(group.value >= 0, begin).reshape(-1, la.tried)
        la = replace(la, features=np.where(kept, la.features, -1))
        for rb in batches:
            for slot, ww, yy, places in _placed(fr, la, rb, nf, nt):
                for use, v, cell in places:
                    k = np.flatnonzero(group.value.take(cell) >= 0)
                    if len(k):
                        use = use[k]
                        held.append((cell[k], v[k], ww[use].astype(np.int64), *fr.sums_of(slot[use], ww[use], yy[use])))
                        n += len(k)
            if n >= HELD_ROWS:
                yield merged(held)
                held, n = [], 0
        if held:
            yield merged(held)
    return run


_FOUND = pa.schema([("slot", pa.int32()), ("feature", pa.int32()),
                    *((c, pa.float64()) for c in ("score", "threshold", "lw", "ls", "lq"))])


def _search_group(front, kept, min_leaf: float):
    """The best threshold within each bin of a group."""
    def run(table: pa.Table) -> pa.Table:
        fr, (number, slot, feature, below) = front.value, kept.value
        cell, v, *terms = (table[c].to_numpy() for c in ("cell", "v", "w", "s", "q"))
        order = np.lexsort((v, cell))
        cell, v = cell[order], v[order]
        first = levels._starts(cell, v)
        own = np.column_stack([np.add.reduceat(t[order], first) for t in terms])
        cell, v = cell[first], v[first]
        start = levels._starts(cell)
        size = np.diff(np.append(start, len(cell)))
        at = np.repeat(np.searchsorted(number, cell[start]), size)
        run_ = np.cumsum(own, axis=0)
        left = fr.floats(slot[at], below[at] + run_ - np.repeat((run_ - own)[start], size, axis=0))
        following = np.full(len(v), np.nan)
        same = np.flatnonzero(cell[1:] == cell[:-1])
        following[same] = v[same + 1]
        n, sse = fr.n[slot[at]], fr.sse[slot[at]]
        r = _scores(left, n, sse, ~np.isnan(following) & (left[:, 0] >= min_leaf) & (n - left[:, 0] >= min_leaf))
        best = np.repeat(np.minimum.reduceat(r, start), size)
        hit = np.flatnonzero((r <= best + levels.TIE) & np.isfinite(r))
        hit = hit[levels._starts(cell[hit])] if len(hit) else hit     # thresholds ascend: the smallest of the best
        return pa.Table.from_arrays(
            [pa.array(c, f.type) for c, f in zip((slot[at[hit]], feature[at[hit]], best[hit],
                                                  _cut(v[hit], following[hit]), *left[hit].T), _FOUND)], schema=_FOUND)
    return run


def best_splits(state: DataFrame, front, nf: int, nt: int, min_leaf: float, fine: int,
                cells: int | None = None) -> list[tuple]:
    """``(slot, all targets equal, (feature, threshold, lw, ls, lq) or None)`` of every open node.

    ``state`` has the rows' bins 0 to ``fine - 1`` in ``xb``."""
    sc, fr = state.sparkSession.sparkContext, front.value
    la = layout(fr, fine, cells or CELLS)
    plan = sc.broadcast(la)
    shared = [plan]
    rows = state.select("x", "w", "yc", "xb")
    try:
        t = (rows.mapInArrow(_bin_sums(front, plan, nf, nt), "cell int, w long, s long, q long, up long, low double, "
                             "high double").groupBy("cell")
             .agg(*(F.sum(c).alias(c) for c in ("w", "s", "q", "up")), F.min("low").alias("low"),
                  F.max("high").alias("high")).toArrow())
        nodes = t.filter(pc.greater_equal(t["cell"], la.size))
        equal = dict(zip((nodes["cell"].to_numpy() - la.size).tolist(),
                         (nodes["low"].to_numpy() == nodes["high"].to_numpy()).tolist()))
        b = _bins(la, t)
        mixed = np.array([not equal.get(i, True) for i in range(len(fr.n))])
        left = fr.floats(b.slot, b.below + b.own)
        n = fr.n[b.slot]
        r = _scores(left, n, fr.sse[b.slot],
                    ~np.isnan(b.following) & (left[:, 0] >= min_leaf) & (n - left[:, 0] >= min_leaf))
        least = np.full(len(fr.n), np.inf)
        np.minimum.at(least, b.slot, r)
        ends = np.flatnonzero(np.isfinite(r) & mixed[b.slot])
        found = list(zip(b.slot[ends], b.feature[ends], r[ends], _cut(b.high[ends], b.following[ends]), *left[ends].T))
        keep = np.flatnonzero(_may_hold(fr, b, least, min_leaf) & mixed[b.slot])
        if len(keep):
            group = np.full(la.size, -1, np.int32)
            group[b.cell[keep]] = np.cumsum(b.own[keep, 0]) // GROUP_ROWS
            shared += [sc.broadcast(group), sc.broadcast((b.cell[keep], b.slot[keep], b.feature[keep], b.below[keep]))]
            inside = (rows.mapInArrow(_kept_rows(front, plan, shared[1], nf, nt),
                                      "g int, cell int, v double, w long, s long, q long").groupBy("g")
                      .applyInArrow(_search_group(front, shared[2], min_leaf), "slot int, feature int, score double, "
                                    "threshold double, lw double, ls double, lq double").toArrow())
            found += zip(*(inside[c].to_numpy() for c in _FOUND.names))
    finally:
        for one in shared:
            one.destroy()
    for slot, _, score, *_ in found:
        least[slot] = min(least[slot], score)
    best: dict[int, tuple] = {}
    for slot, feature, score, *split in found:
        if score <= least[slot] + levels.TIE:
            one = (int(feature), *(float(v) for v in split))
            best[int(slot)] = min(best.get(int(slot), one), one)
    return [(slot, same, best.get(slot)) for slot, same in equal.items()]

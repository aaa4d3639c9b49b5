"""The lower part of the trees, a node's whole subtree at once.

A node of few rows need not meet every row of the table again at each level below it.
One Arrow pass walks the rows down the trees grown so far and packs those of the nodes to finish,
a blob per node and about ``HELD_ROWS`` rows; one shuffle brings a node's blobs together, and its
subtree is grown there by the rules of the level-wise search (feature subsets by hash, midpoints,
size limits, ties, sums in 64-bit fixed point), all nodes of a depth together.  Nodes are equal to the
last bit.  A group holds no more rows than the node that its caller lets through.
"""

from __future__ import annotations

import math
from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sylvan.functions import traverse
from sylvan.functions.hashing import subset_for
from sylvan.operators import levels
from sylvan.operators.levels import MAX_HEAP_DEPTH

#: Rows of all trees that a task holds before it packs them, about.
HELD_ROWS = 262_144
#: Bytes that a task of the shuffle reads, about.
TASK_BYTES = 1 << 26

_PACKED = pa.schema([("slot", pa.int32()), ("x", pa.binary()), ("y", pa.binary()), ("w", pa.binary())])
PACKED = "slot int, x binary, y binary, w binary"
NODES = pa.schema([("tree_id", pa.int32()), ("node_id", pa.int64()), ("depth", pa.int32()), ("feature", pa.int32()),
                   ("threshold", pa.float64()), ("left_id", pa.int64()), ("right_id", pa.int64()), ("value", pa.float64()),
                   ("n", pa.float64()), ("mse", pa.float64()), ("is_leaf", pa.bool_())])


def row_bytes(nf: int) -> int:
    """Bytes of a packed row: features, target and weight."""
    return 8 * nf + 9


def _pack(front, nf: int, nt: int):
    """The rows of the open nodes, packed per node: features one after the other, targets and bag weights."""
    def packed(slot, row, w, x, y):
        order = np.argsort(slot, kind="stable")
        slot, row, w = slot[order], row[order], w[order]
        x, y = x.take(row, axis=1), y[row]
        first = levels._starts(slot)
        ends = np.append(first, len(slot))[1:]
        cols = ([int(v) for v in slot[first]], *([part[..., a:b].tobytes() for a, b in zip(first, ends)] for part in (x, y, w)))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _PACKED)], schema=_PACKED)

    def run(batches):
        fr, tables, held, n, rows = front.value, [], [], 0, 0

        def all_held():
            return packed(*(np.concatenate(c) for c in zip(*held)),
                          *(np.concatenate(c, axis=-1) for c in zip(*tables)))
        for rb in batches:
            x, w, y = levels._columns(rb, nf, nt)
            tables.append((np.ascontiguousarray(x.T), y))
            for at, slot, ww in fr.open_rows(x, w):
                held.append((slot.astype(np.int32), at + rows, ww.astype(np.int8)))
                n += len(at)
            rows += len(y)
            if n >= HELD_ROWS:
                yield all_held()
                tables, held, n, rows = [], [], 0, 0
        if n:
            yield all_held()
    return run


def _ranks(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per feature: each row's rank among the distinct values (-1: missing); all values in order; where a feature's begin."""
    ranks, values, begin = np.full(x.shape, -1, np.int32), [], [0]
    for f, v in enumerate(x):
        known = np.flatnonzero(~np.isnan(v))
        order = known[np.argsort(v[known])]
        v = v[order]
        first = levels._starts(v)
        ranks[f, order] = np.repeat(np.arange(len(first), dtype=np.int32), np.diff(np.append(first, len(v))))
        values.append(v[first])
        begin.append(begin[-1] + len(first))
    return ranks, np.concatenate([*values, [np.nan]]), np.array(begin)


def _best_cuts(rank, at, f, terms, units, n, sse, least, values, begin) -> np.ndarray:
    """Per node the best threshold of its feature ``f``: score (infinite: none), threshold, left sums and the rank
    of the value below it.  ``rank``: of the rows, by which ``at`` tells the node; ``terms``: their sums' terms."""
    out = np.full((6, len(f)), np.inf)
    known = np.flatnonzero(rank >= 0)
    if not len(known):
        return out
    low, middle = len(rank).bit_length(), int(rank.max()).bit_length()
    key = (at << middle) | rank
    if low + middle + len(f).bit_length() < 63:          # node, rank and row in one number: its sort carries the row
        key = (key << low) | np.arange(len(key))
        key = np.sort(key[known] if len(known) < len(key) else key)
        order = key & ((1 << low) - 1)
        key >>= low
    else:
        order = known[np.argsort(key[known], kind="stable")]
        key = key[order]
    last = np.flatnonzero(key[1:] != key[:-1])           # of a value's rows, but for the very last
    node, after = key[last] >> middle, key[last + 1]
    same = node == after >> middle                       # else another node's values follow
    within, ends = last[same], last[~same]
    value, following = (v[same] & ((1 << middle) - 1) for v in (key[last], after))
    into, node = after[~same] >> middle, node[same]
    sums = []
    for term, unit in zip(terms, units):
        run = np.cumsum(term.take(order))                # wraps around between nodes, which differences undo
        start = np.zeros(len(f), np.int64)
        start[into] = run[ends]
        left = (run.take(within) - start.take(node)).astype(np.float64)
        sums.append(left if unit is None else left * unit.take(node))
    lw = sums[0]
    ok = np.flatnonzero((lw >= least) & (n.take(node) - lw >= least))
    if not len(ok):
        return out
    node, value, following = node[ok], value[ok], following[ok]
    lw, ls, lq = (s[ok] for s in sums)
    r = levels.score(lw, ls, lq, n.take(node), sse.take(node))
    first = levels._starts(node)
    best = np.minimum.reduceat(r, first)
    hit = np.flatnonzero(r <= np.repeat(best, np.diff(np.append(first, len(r)))) + levels.TIE)
    hit = hit[levels._starts(node[hit])]                 # thresholds ascend: the smallest of the best
    k = node[hit]
    v, after = values[begin[f[k]] + value[hit]], values[begin[f[k]] + following[hit]]
    with np.errstate(over="ignore"):                     # adjacent doubles: their midpoint may be the next value
        mid = v / 2 + after / 2
    out[:, k] = best, np.where((mid >= v) & (mid < after), mid, v), lw[hit], ls[hit], lq[hit], value[hit]
    return out


def grow(x: np.ndarray, w: np.ndarray, y: np.ndarray, root: tuple, params, m: int, ybar: float = 0.0) -> pa.Table:
    """The nodes below and with ``root`` (tree, node id, depth, n, mean, sse, room).

    ``x``: a line per feature; ``w``: bag weights; ``y``: targets less ``ybar``."""
    tree, ident, depth, n, mean, sse, room = root
    nf, least = len(x), float(params.min_samples_leaf)
    limit = params.max_depth if params.max_depth is not None else MAX_HEAP_DEPTH + 1
    ident = np.array([ident], np.int64)
    n, mean, sse, room = (np.array([v], float) for v in (n, mean, sse, room))
    rows, at, w = np.arange(len(y)), np.zeros(len(y), np.int64), w.astype(np.int64)
    ranks, values, begin = _ranks(x)
    out = []
    while len(ident):
        can = (depth < limit) & (n >= params.min_samples_split) & (n >= 2 * least)
        dev = y[rows] - mean[at]
        low, high = np.full(len(n), np.inf), np.full(len(n), -np.inf)
        np.minimum.at(low, at, dev)
        np.maximum.at(high, at, dev)
        equal = can & (low == high)
        mse = np.where(equal | (n <= 0), 0.0, sse / np.where(n > 0, n, 1.0))
        open_ = np.flatnonzero(can & ~equal & (nf > 0))
        feature, cut = np.full(len(n), -1), np.full(len(n), np.nan)
        split = np.zeros(0, np.int64)
        if len(open_):
            if depth >= MAX_HEAP_DEPTH:
                raise ValueError(f"a tree would need more than {MAX_HEAP_DEPTH} levels; set max_depth or "
                                 "min_samples_leaf")
            place = np.full(len(n), -1)
            place[open_] = np.arange(len(open_))
            keep = np.flatnonzero(place[at] >= 0)
            rows, at, dev = rows[keep], place[at[keep]], dev[keep]
            on, osse, oroom = n[open_], sse[open_], room[open_]
            us, uq = levels.quanta(on, oroom)
            ww = w[rows]
            terms = (ww, levels.fixed(ww * dev, us[at]), levels.fixed(ww * dev * dev, uq[at]))
            tried = np.array([subset_for(params.seed, tree, node, nf, m) for node in ident[open_].tolist()])
            found = np.stack([_best_cuts(ranks.ravel().take(tried[:, j].take(at) * len(y) + rows), at, tried[:, j], terms, (None, us, uq), on, osse,
                                         least, values, begin) for j in range(tried.shape[1])])
            lowest = found[:, 0].min(0)
            j = np.argmax(found[:, 0] <= lowest + levels.TIE, axis=0)      # features ascend
            _, where, lw, ls, lq, rank = found[j, :, np.arange(len(open_))].T
            f = tried[np.arange(len(open_)), j]
            split = np.flatnonzero(np.isfinite(lowest))
            feature[open_[split]], cut[open_[split]] = f[split], where[split]
        inner = feature >= 0
        out.append((ident, np.full(len(n), depth), feature, cut, mean + ybar, n, mse, ~inner))
        if not len(split):
            break
        lw, ls, lq = lw[split], ls[split], lq[split]
        pn, pm, psse, proom = on[split], mean[open_[split]], osse[split], oroom[split]
        rw = pn - lw                                     # the node's deviations add up to 0
        lsse, rsse = np.maximum(lq - ls * ls / lw, 0.0), np.maximum(psse - lq - ls * ls / rw, 0.0)
        place = np.full(len(open_), -1)
        place[split] = np.arange(len(split))
        keep = np.flatnonzero(place[at] >= 0)
        rows, at = rows[keep], at[keep]
        r = ranks.ravel().take(f.take(at) * len(y) + rows)
        at = 2 * place[at] + ((r < 0) | (r > rank[at]))   # a missing value goes right
        ident = np.repeat(2 * ident[open_[split]], 2) + np.tile([0, 1], len(split))
        n, mean, sse, room = (np.column_stack(c).ravel() for c in (
            (lw, rw), (pm + ls / lw, pm - ls / rw), (lsse, rsse),
            (levels.room_below(pn, proom, lsse), levels.room_below(pn, proom, rsse))))
        depth += 1
    ident, depths, feature, cut, value, n, mse, leaf = (np.concatenate(c) for c in zip(*out))
    cols = (np.full(len(ident), tree), ident, depths, feature, cut, 2 * ident, 2 * ident + 1, value, n, mse, leaf)
    none = {"feature", "threshold", "left_id", "right_id"}
    return pa.Table.from_arrays([pa.array(c, f.type, mask=leaf if f.name in none else None) for c, f in zip(cols, NODES)],
                                schema=NODES)


def _grow_groups(roots, params, m: int, nf: int, ybar: float):
    def run(group: pa.Table) -> pa.Table:
        x, y, w = (group.column(c).to_pylist() for c in ("x", "y", "w"))
        x = np.concatenate([np.frombuffer(b, np.float64).reshape(nf, -1) for b in x], axis=1)
        y, w = (np.frombuffer(b"".join(c), d) for c, d in ((y, np.float64), (w, np.int8)))
        return grow(x, w, y, roots.value[group.column("slot")[0].as_py()], params, m, ybar)
    return run


def grown(state: DataFrame, front: levels.Frontier, open_: list, params, nf: int, m: int, ybar: float,
          schema) -> tuple[DataFrame, list]:
    """The nodes of the subtrees of ``open_`` (open nodes as of ``_Trees.frontier``), and the broadcasts
    to release when they have been computed."""
    sc = state.sparkSession.sparkContext
    roots = sc.broadcast([(t, node, node.bit_length() - 1, n, mean, sse, room)
                          for t, _place, _subset, n, mean, sse, node, room in open_])
    shared = sc.broadcast(replace(front, mean=np.zeros(len(open_))))          # targets as they are
    size = float(front.n.sum()) * row_bytes(nf)
    parts = max(2 * sc.defaultParallelism, math.ceil(size / TASK_BYTES))
    rows = state.select("x", "w", "yc").mapInArrow(_pack(shared, nf, params.n_trees), PACKED)
    nodes = (rows.repartition(parts, "slot").groupBy("slot")
             .applyInArrow(_grow_groups(roots, params, m, nf, ybar), schema))
    return nodes, [roots, shared]

"""Vectorised tree traversal over Arrow record batches.

Routing rows through trees (training) and scoring rows (prediction)
need a per-row lookup into a model-sized structure.  Attaching that
structure to every row as a column would copy it once per row inside
generated code, so instead the arrays ship once per executor as a
Spark broadcast variable and ``mapInArrow`` walks a whole batch of rows
through all trees at once with NumPy gathers (O(depth) vector steps
per batch).  These helpers are the only per-batch Python in the
library; Spark partitions, schedules and retries the work.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def list_matrix(arr: pa.Array, width: int, dtype) -> np.ndarray:
    """Fixed-width list column -> (rows, width) matrix (NULL -> NaN/0).

    Also of a column of :func:`matrix_bytes`, whose numbers are of ``dtype``."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if pa.types.is_binary(arr.type) or pa.types.is_large_binary(arr.type):
        arr = arr.cast(pa.large_binary())
        first = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset] if len(arr) else 0
        return np.frombuffer(arr.buffers()[2] or b"", dtype, len(arr) * width, first).reshape(len(arr), width)
    flat = arr.flatten()
    if pa.types.is_floating(flat.type):
        vals = flat.to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    else:
        vals = flat.fill_null(0).to_numpy(zero_copy_only=False).astype(dtype, copy=False)
    if width == 0:
        return np.zeros((len(arr), 0), dtype=vals.dtype)
    return vals.reshape(len(arr), width)


def matrix_list(mat: np.ndarray, pa_type) -> pa.Array:
    n, width = mat.shape
    offsets = pa.array(np.arange(0, n * width + 1, width, dtype=np.int32))
    return pa.ListArray.from_arrays(offsets, pa.array(mat.ravel(), type=pa_type))


def matrix_bytes(mat: np.ndarray) -> pa.Array:
    """A row's numbers as one binary value, which Spark moves at once and not number by number."""
    n, width = mat.shape
    ends = np.arange(n + 1, dtype=np.int32) * (width * mat.itemsize)
    return pa.BinaryArray.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(mat))])


def route_level(nid: np.ndarray, x: np.ndarray, lv: dict) -> np.ndarray:
    """One level of routing for all trees (heap node ids).

    ``lv``: per tree ``off`` / ``cnt`` into flat arrays of the nodes split
    at this level -- ``ids`` (ascending per tree), ``f`` (feature), ``t``
    (threshold), ``l`` (left child id).  Left when x[f] <= t; NaN goes
    right; rows in nodes not split at this level keep their id.
    """
    out = nid.copy()
    rows = np.arange(nid.shape[0])
    for tree in range(nid.shape[1]):
        c = int(lv["cnt"][tree])
        if c == 0:
            continue
        o = int(lv["off"][tree])
        seg = lv["ids"][o:o + c]
        k = nid[:, tree]
        pos = np.clip(np.searchsorted(seg, k), 0, c - 1)
        found = seg[pos] == k
        g = o + pos
        v = x[rows, lv["f"][g]] if x.shape[1] else np.full(len(k), np.nan)
        child = np.where(v <= lv["t"][g], lv["l"][g], lv["l"][g] + 1)
        out[:, tree] = np.where(found, child, k)
    return out


def predict_trees(x: np.ndarray, fm: dict) -> np.ndarray:
    """Per-tree predictions (rows, trees) for a flattened forest.

    ``fm``: per tree ``off`` and ``depth``; flat ``f``, ``t``, ``l``,
    ``r`` (local child ids, -1 for leaves) and ``v`` (node value).
    """
    n = x.shape[0]
    n_trees = len(fm["off"])
    node = np.zeros((n, n_trees), dtype=np.int64)
    off = fm["off"][None, :]
    steps = int(fm["depth"].max()) if n_trees else 0
    if x.shape[1] == 0:
        x = np.full((n, 1), np.nan)
    for _ in range(steps):
        g = off + node
        left = fm["l"][g]
        leaf = left < 0
        if leaf.all():
            break
        feat = np.clip(fm["f"][g], 0, x.shape[1] - 1)
        v = np.take_along_axis(x, feat, axis=1)
        nxt = np.where(v <= fm["t"][g], left, fm["r"][g])
        node = np.where(leaf, node, nxt)
    return fm["v"][off + node]

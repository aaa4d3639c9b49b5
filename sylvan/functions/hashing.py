"""Portable, partition-independent randomness.

Every random decision (train/test membership, fold id, bootstrap
weight, feature subset, random thresholds, synthetic noise) is a pure
function of a row key and a seed string, computed as the first eight
hex digits of an MD5 digest.  The same expression runs in Spark and in
DuckDB (``md5``, ``concat_ws``, ``substr``), so results do not depend on
partitioning, executor count or retries, and every oracle can reproduce
them byte for byte.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

TWO32 = 4294967296.0


def hash8(*parts) -> Column:
    """First 8 lowercase hex digits of md5(parts joined by '|').

    ``parts`` are column names, Columns, or Python literals (ints /
    strings) -- literals are rendered with ``str`` exactly as DuckDB's
    ``cast(.. as varchar)`` renders integers.
    """
    cols = []
    for p in parts:
        if isinstance(p, Column):
            cols.append(p.cast("string"))
        elif isinstance(p, str):
            cols.append(F.col(p).cast("string"))
        else:
            cols.append(F.lit(str(p)))
    return F.substring(F.md5(F.concat_ws("|", *cols)), 1, 8)


def hex_threshold(p: float) -> str:
    """8-digit hex string t such that P(hash8 < t) = p for uniform hashes."""
    p = min(max(p, 0.0), 1.0)
    if p >= 1.0:
        return "~"  # sorts above every hex digit
    return format(int(p * TWO32), "08x")


def uniform(h: Column) -> Column:
    """Uniform in [0, 1) from an 8-hex-digit hash."""
    return F.conv(h, 16, 10).cast("bigint") / F.lit(TWO32)


def uniform_open(h: Column) -> Column:
    """Uniform in (0, 1), safe for ``ln``."""
    return (F.conv(h, 16, 10).cast("bigint") + F.lit(0.5)) / F.lit(TWO32)


def poisson1_thresholds(max_k: int = 12) -> list[str]:
    """Cumulative Poisson(1) probabilities for k = 0..max_k-1 as hex cut points.

    Inverse-CDF sampling: a hash below cut[k] (and not below cut[k-1])
    gives weight k; a hash above every cut gives ``max_k``.
    """
    cuts, cum, term = [], 0.0, math.exp(-1.0)
    for k in range(max_k):
        cum += term
        cuts.append(format(int(cum * TWO32), "08x"))
        term /= (k + 1)
    return cuts


def poisson1_weight(h: Column, max_k: int = 12) -> Column:
    """Bootstrap multiplicity ~ Poisson(1) from a hash (weight column)."""
    expr = F.lit(max_k)
    for k, cut in reversed(list(enumerate(poisson1_thresholds(max_k)))):
        expr = F.when(h < F.lit(cut), F.lit(k)).otherwise(expr)
    return expr.cast("int")


def normal(h1: Column, h2: Column) -> Column:
    """Standard normal by Box-Muller over two independent hashes."""
    u1 = uniform_open(h1)
    u2 = uniform(h2)
    return F.sqrt(F.lit(-2.0) * F.ln(u1)) * F.cos(F.lit(2.0 * math.pi) * u2)


# ---- the same on the driver or in a task, for the nodes of a tree ----------

def py_hash8(*parts) -> str:
    """:func:`hash8` of plain values."""
    return hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()[:8]


def py_uniform(*parts) -> float:
    return int(py_hash8(*parts), 16) / TWO32


def subset_for(seed, tree: int, node: int, n_features: int, m: int) -> list[int]:
    """SP7: the m features with the smallest md5(seed|tree|node|feature), ascending."""
    if m >= n_features:
        return list(range(n_features))
    return sorted(f for _, f in sorted((py_hash8(seed, tree, node, f), f) for f in range(n_features))[:m])


#: MD5's rotations and constants, and the word of the message that each of its 64 steps takes.
_ROTATE = np.repeat([[7, 12, 17, 22], [5, 9, 14, 20], [4, 11, 16, 23], [6, 10, 15, 21]], 4, axis=0).reshape(-1)
_ADD = np.array([int(abs(math.sin(i + 1)) * TWO32) for i in range(64)], np.uint32)
_WORD = [((1, 5, 3, 7)[i // 16] * i + (0, 1, 5, 0)[i // 16]) % 16 for i in range(64)]
#: Messages hashed together: their columns of one step stay in a core's cache.
_LANES = 8192
#: Fewer messages of a length go through hashlib one by one.
_FEW = 256


def _md5_heads(words: list) -> np.ndarray:
    """First four bytes, as a number, of the MD5 of messages of one padded block each; ``words``: the block's
    16 words, an array with one per message (or a number for all, None for 0)."""
    n = max(len(w) for w in words if isinstance(w, np.ndarray))
    first = [np.uint32(v) for v in (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)]
    a, b, c, d = (np.full(n, v, np.uint32) for v in first)
    t, u = np.empty(n, np.uint32), np.empty(n, np.uint32)
    for i in range(64):
        if i < 16:
            np.bitwise_xor(c, d, out=t), np.bitwise_and(t, b, out=t), np.bitwise_xor(t, d, out=t)
        elif i < 32:
            np.bitwise_xor(b, c, out=t), np.bitwise_and(t, d, out=t), np.bitwise_xor(t, c, out=t)
        elif i < 48:
            np.bitwise_xor(b, c, out=t), np.bitwise_xor(t, d, out=t)
        else:
            np.bitwise_not(d, out=t), np.bitwise_or(t, b, out=t), np.bitwise_xor(t, c, out=t)
        word, add = words[_WORD[i]], _ADD[i]
        np.add(t, a, out=t)
        if isinstance(word, np.ndarray):
            np.add(t, word, out=t)
        elif word is not None:
            add = np.uint32((int(add) + word) & 0xFFFFFFFF)
        np.add(t, add, out=t)
        np.left_shift(t, np.uint32(_ROTATE[i]), out=u), np.right_shift(t, np.uint32(32 - _ROTATE[i]), out=t)
        np.bitwise_or(t, u, out=t), np.add(t, b, out=t)
        a, b, c, d, t = d, t, b, c, a
    return (a + first[0]).byteswap()


def hash_numbers(starts: pa.Array, ends: list[bytes]) -> np.ndarray:
    """:func:`hash8` of each start (a string) followed by each end, as numbers: an array with a line per end."""
    n = len(starts)
    out = np.empty((len(ends), n), np.uint32)
    if not n:
        return out
    starts = starts.cast(pa.large_binary())
    offsets = np.frombuffer(starts.buffers()[1], np.int64)[starts.offset:starts.offset + n + 1]
    data = np.frombuffer(starts.buffers()[2] or b"", np.uint8)
    lengths = np.diff(offsets)
    for length in np.unique(lengths).tolist():
        same = np.flatnonzero(lengths == length)
        if len(same) < _FEW or length + max(map(len, ends)) > 55:
            texts = [data[offsets[i]:offsets[i] + length].tobytes() for i in same]
            for k, end in enumerate(ends):
                out[k, same] = np.frombuffer(b"".join(hashlib.md5(t + end).digest()[:4] for t in texts), ">u4")
            continue
        for part in np.array_split(same, -(-len(same) // _LANES)):
            block = np.zeros((len(part), 64), np.uint8)
            block[:, :length] = data[offsets[part][:, None] + np.arange(length)]
            before = length // 4                       # the words that no end changes
            begin = [np.ascontiguousarray(block[:, 4 * w:4 * w + 4]).view("<u4")[:, 0] for w in range(before)]
            for k, end in enumerate(ends):
                last = length + len(end)
                block[:, length:56] = 0
                block[:, length:last] = np.frombuffer(end, np.uint8)
                block[:, last] = 0x80
                rest = [np.ascontiguousarray(block[:, 4 * w:4 * w + 4]).view("<u4")[:, 0] for w in range(before, last // 4 + 1)]
                words = begin + rest + [None] * (16 - len(begin) - len(rest))
                words[14] = 8 * last
                out[k, part] = _md5_heads(words)
    return out


# ---- SQL twins (DuckDB) used by the oracles -------------------------------

def sql_hash8(*parts: str) -> str:
    """DuckDB text of :func:`hash8`; ``parts`` are SQL expressions."""
    inner = ", ".join(f"cast({p} as varchar)" for p in parts)
    return f"substr(md5(concat_ws('|', {inner})), 1, 8)"


def sql_uniform(h: str) -> str:
    return f"(cast(concat('0x', {h}) as bigint) / {TWO32!r})"


def sql_uniform_open(h: str) -> str:
    return f"((cast(concat('0x', {h}) as bigint) + 0.5) / {TWO32!r})"


def sql_poisson1_weight(h: str, max_k: int = 12) -> str:
    whens = " ".join(f"when {h} < '{cut}' then {k}"
                     for k, cut in enumerate(poisson1_thresholds(max_k)))
    return f"cast(case {whens} else {max_k} end as integer)"


def sql_normal(h1: str, h2: str) -> str:
    return (f"(sqrt(-2.0 * ln({sql_uniform_open(h1)})) * "
            f"cos({2.0 * math.pi!r} * {sql_uniform(h2)}))")

"""Quality classifier: hashed word n-grams, follow-the-regularised-leader (operator 12).

Features.  Words are the stretches between ASCII white space.  Each word
gives two symbols: itself and its shape (letters as ``A`` or ``a``, digits
as ``0``, runs cut to one, marks kept); the n-grams of one and two words
and of one to three shapes are hashed to ``2 ** bits`` slots.  Equal
neighbours are the bigram "the same word again", whatever the word.  A
slot's value is its share of the text's n-grams of that kind, times
``SCALE``, so long and short texts weigh alike.

Training is FTRL-proximal: one example after the other, with a learning
rate of its own per slot and an L1 bound that leaves rare slots at zero.
It reads a bounded sample of labelled rows, about ``per_class`` of each
label (all of a rarer one), in hash order, ``epochs`` times; the examples
are made by the executors, the updates run on the driver, whose memory the
sample's bound limits.  A text of the sample gives at most its distinct
slots.  Class weights undo the unequal sampling, so a score estimates the
share of label 1 among all labelled rows of that kind.

Scoring is one pass: the sparse dot product of each text's slots with the
weights (a broadcast of at most ``2 ** bits`` numbers), through the logistic
function.  Whole texts are read; n-grams don't cross from one stretch of
``STRETCH`` bytes to the next.

A null or empty text has no slot and gets the bias's score; without any
labelled row every score is 0.5; with one label only, the score is that
label's smoothed share.  Repeated labels of a document count as 1 only if
all of them are 1.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sylvan.llm.common import fresh, quoted, utf8

BITS = 20
#: Bytes of a text whose words are looked at together.
STRETCH = 1 << 20
#: Bytes of short texts looked at together.
GROUP = 1 << 21
#: Factor of all values: the learner's rates suit values of this size.
SCALE = 10.0
_SHAPE = bytes(ord("A") if 65 <= b <= 90 else ord("a") if 97 <= b <= 122 or b >= 128 else
               ord("0") if 48 <= b <= 57 else b for b in range(256))
_RUN = re.compile(rb"(.)\1+", re.DOTALL)
_GAP = re.compile(rb"[ \t-\r]")
_WHITE = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SAME = np.uint64(0xD6E8FEB86659FD93)
#: Kinds of n-gram: words of one and two, shapes of one to three.
KINDS = 5


def shape_of(word: bytes) -> bytes:
    """``Word,`` becomes ``Aa,``; runs of equal symbols are cut to one."""
    return _RUN.sub(rb"\1", word.translate(_SHAPE))


def _stretches(text: bytes) -> Iterator[bytes]:
    """Parts of about ``STRETCH`` bytes, cut at white space where there is some."""
    at = 0
    while len(text) - at > STRETCH:
        cut = _GAP.search(text, at + STRETCH)
        end = cut.start() if cut else len(text)
        yield text[at:end]
        at = end
    yield text[at:]


def _groups(texts: Iterable[bytes]) -> Iterator[tuple[list[int], list[bytes]]]:
    """Stretches of consecutive texts, with the number of each one's text, about ``GROUP`` bytes at a time."""
    owner, parts, held = [], [], 0
    for i, t in enumerate(texts):
        for part in _stretches(t):
            owner.append(i)
            parts.append(part)
            held += len(part) + 1
            if held >= GROUP:
                yield owner, parts
                owner, parts, held = [], [], 0
    if parts:
        yield owner, parts


class Hasher:
    """The n-grams of texts as slots; the hashes of words met before are remembered."""

    def __init__(self, bits: int = BITS, remembered: int = 300_000):
        self.bits, self.remembered = bits, remembered
        self.known: dict[bytes, tuple[int, int]] = {}

    def _hashes(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > self.remembered:
            known.clear()
        for w in words:
            if w not in known:
                known[w] = (xxhash.xxh3_64_intdigest(w), xxhash.xxh3_64_intdigest(shape_of(w), seed=1))
        return np.array([known[w] for w in words], np.uint64).reshape(-1, 2)

    def _slots(self, h: np.ndarray, kind: int) -> np.ndarray:
        h = (h + np.uint64(kind)) * _MIX
        return ((h ^ (h >> np.uint64(31))) * _MIX >> np.uint64(64 - self.bits)).astype(np.int32)

    def grams(self, parts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each kind of n-gram: its slots, and the number of the part each one is from."""
        data = np.frombuffer(b"\n".join(parts), np.uint8)
        word = ~_WHITE[data]
        edge = np.diff(np.concatenate(([0], word.view(np.int8), [0])))
        begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        offsets = np.zeros(len(begin) + 1, np.int32)
        np.cumsum(end - begin, out=offsets[1:])
        coded = pa.BinaryArray.from_buffers(pa.binary(), len(begin), [
            None, pa.py_buffer(offsets), pa.py_buffer(data[word])]).dictionary_encode()
        code = coded.indices.to_numpy(zero_copy_only=False)
        hashes = self._hashes(coded.dictionary.to_pylist())
        one, form = hashes[:, 0][code], hashes[:, 1][code]
        first = np.concatenate(([0], np.cumsum([len(p) + 1 for p in parts])[:-1]))
        part = np.searchsorted(first, begin, side="right") - 1
        yield self._slots(one, 1), part
        yield self._slots(form, 2), part
        near = part[1:] == part[:-1]
        again = code[1:] == code[:-1]
        yield self._slots(np.where(again, _SAME, one[:-1] * _MIX ^ one[1:]), 3)[near], part[1:][near]
        two = np.where(again, _SAME, np.uint64(0)) ^ form[:-1] * _MIX ^ form[1:]
        yield self._slots(two, 4)[near], part[1:][near]
        near = part[2:] == part[:-2]
        yield self._slots(two[:-1] * _MIX ^ form[2:], 5)[near], part[2:][near]

    def slots(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Distinct slots of a text and their values."""
        seen: list[list[np.ndarray]] = [[] for _ in range(KINDS)]
        for _owner, parts in _groups([text]):
            for kind, (slots, _part) in enumerate(self.grams(parts)):
                seen[kind].append(slots)
        at, values = [], []
        for found in map(np.concatenate, seen):
            if len(found):
                u, n = np.unique(found, return_counts=True)
                at.append(u)
                values.append(n * (SCALE / len(found)))
        return (np.concatenate(at), np.concatenate(values)) if at else (np.zeros(0, np.int32), np.zeros(0))


@dataclass(frozen=True)
class Model:
    """Weights by slot, the bias and the hash width."""

    weights: np.ndarray
    bias: float
    bits: int

    def score(self, texts: list[bytes], hasher: Hasher) -> np.ndarray:
        """Scores of texts: the dot product of each one's slots, a share of its n-grams, with the weights."""
        sums, sizes = np.zeros((KINDS, len(texts))), np.zeros((KINDS, len(texts)))
        for owner, parts in _groups(texts):
            at = np.array(owner)
            for kind, (slots, part) in enumerate(hasher.grams(parts)):
                np.add.at(sums[kind], at, np.bincount(part, self.weights[slots], len(parts)))
                np.add.at(sizes[kind], at, np.bincount(part, minlength=len(parts)))
        z = self.bias + SCALE * (sums / np.maximum(sizes, 1)).sum(axis=0)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Ftrl:
    """FTRL-proximal logistic regression: per-slot learning rates, L1 and L2 bounds."""

    def __init__(self, size: int, alpha: float = 1.0, beta: float = 1.0, l1: float = 0.05, l2: float = 0.1):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros(size + 1), np.zeros(size + 1)          # the last slot is the bias

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def update(self, slots: np.ndarray, values: np.ndarray, label: int, weight: float) -> None:
        w = self.weights(slots)
        p = 1 / (1 + math.exp(-max(-30.0, min(30.0, float(w @ values)))))
        g = (p - label) * weight * values
        before = self.n[slots]
        self.n[slots] = before + g * g
        self.z[slots] += g - (np.sqrt(self.n[slots]) - np.sqrt(before)) / self.alpha * w


def train(slots: Sequence[np.ndarray], values: Sequence[np.ndarray], labels: np.ndarray, weights: np.ndarray,
          bits: int = BITS, epochs: int = 4) -> Model:
    """A model from the examples in their order; a slot may come twice (of two kinds), which adds up."""
    if len(labels) == 0:
        return Model(np.zeros(1 << bits), 0.0, bits)
    if labels.min() == labels.max():
        share = (labels.sum() + 1) / (len(labels) + 2)
        return Model(np.zeros(1 << bits), math.log(share / (1 - share)), bits)
    size = 1 << bits
    ready = []
    for s, v in zip(slots, values):
        at, back = np.unique(np.append(s, size), return_inverse=True)    # the bias is always on
        ready.append((at, np.bincount(back, np.append(v, 1.0))))
    learner = Ftrl(size)
    for _ in range(epochs):
        for (at, v), y, w in zip(ready, labels.tolist(), weights.tolist()):
            learner.update(at, v, y, w)
    final = learner.weights(slice(None))
    return Model(final[:-1].copy(), float(final[-1]), bits)


def held_out(doc_id: Column, modulus: int = 4, rest: int = 2) -> Column:
    """Whether a row is kept from learning: CRC-32 of its id as text, null ids as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus == rest


_EXAMPLE = "struct<slots: array<int>, vals: array<float>>"


def _examples(bits: int):
    def run(text: pa.Array) -> pa.Array:
        hasher = Hasher(bits)
        got = [hasher.slots(t) for t in text.to_pylist()]
        return pa.StructArray.from_arrays(
            [pa.array([s.astype(np.int32) for s, _ in got], pa.list_(pa.int32())),
             pa.array([v.astype(np.float32) for _, v in got], pa.list_(pa.float32()))], ["slots", "vals"])
    return F.arrow_udf(run, _EXAMPLE)


def fit(docs: DataFrame, labels: DataFrame, target: str = "quality", per_class: int = 2500, bits: int = BITS,
        epochs: int = 4, text: str = "text", doc_id: str = "doc_id") -> Model:
    """A model of ``labels(doc_id, target)`` of 0 and 1 on ``docs``; rows that :func:`held_out` names don't teach."""
    marks = (labels.select(quoted(doc_id).alias("id__"), quoted(target).cast("int").alias("y__"))
             .dropna().filter(~held_out(F.col("id__"))).groupBy("id__").agg(F.min("y__").alias("y__"))
             .filter(F.col("y__").isin(0, 1)))
    sizes = {r["y__"]: r["count"] for r in marks.groupBy("y__").count().collect()}       # two rows
    share = F.lit(0.0)
    for y, n in sizes.items():
        share = F.when(F.col("y__") == y, F.lit(min(1.0, per_class / n))).otherwise(share)
    span = 1 << 32
    place = F.pmod(F.xxhash64("id__", F.lit("sample")), F.lit(span))
    chosen = marks.withColumn("place__", place).filter(F.col("place__") < share * span)   # about 2 * per_class rows
    rows = (docs.select(quoted(doc_id).alias("id__"), utf8(quoted(text)).alias("text__"))
            .join(F.broadcast(chosen), "id__")
            .select("id__", "y__", "place__", _examples(bits)("text__").alias("e")).toArrow())
    rows = rows.sort_by([("place__", "ascending"), ("id__", "ascending")])
    e = rows["e"].combine_chunks() if rows.num_rows else None
    slots, values = ([], []) if e is None else tuple(
        [np.asarray(x) for x in np.split(f.values.to_numpy(), f.offsets.to_numpy()[1:-1])] for f in map(_list_of, (
            e.field("slots"), e.field("vals"))))
    y = rows["y__"].to_numpy()
    total, taken = sum(sizes.values()), np.bincount(y, minlength=2) if len(y) else np.zeros(2)
    weight = np.array([sizes.get(c, 0) / total / max(taken[c], 1) * max(len(y), 1) if total else 1.0 for c in (0, 1)])
    return train(slots, values, y, weight[y] if len(y) else np.zeros(0), bits, epochs)


def _list_of(column: pa.Array) -> pa.ListArray:
    """A list column whose offsets begin at 0."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return pa.ListArray.from_arrays(pa.array(column.offsets.to_numpy() - column.offsets[0].as_py(), pa.int32()),
                                    column.flatten())


def score(docs: DataFrame, model: Model, out: str = "quality_score", text: str = "text") -> DataFrame:
    """``docs`` plus the score of each row's text, 0 to 1."""
    (out,) = fresh(docs, out)
    at = np.flatnonzero(model.weights)
    sent = docs.sparkSession.sparkContext.broadcast((at.astype(np.int32), model.weights[at]))
    bias, bits = model.bias, model.bits

    def run(text: pa.Array) -> pa.Array:
        where, weight = sent.value
        dense = np.zeros(1 << bits)
        dense[where] = weight
        return pa.array(Model(dense, bias, bits).score(text.to_pylist(), Hasher(bits)))
    return docs.withColumn(out, F.arrow_udf(run, "double")(utf8(quoted(text))))

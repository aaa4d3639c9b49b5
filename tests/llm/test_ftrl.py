"""The quality classifier: updates by the formula, sparse scores, held-out accuracy, edges."""

import math
import random
import zlib

import numpy as np
import pytest

from sylvan.llm import ftrl as T
from sylvan.llm.common import read

from ..conftest import SF01
from .conftest import clash


def test_updates_follow_the_published_formula():
    """Per coordinate, with plain floats: w from (z, n), then z and n from the gradient."""
    rnd = random.Random(2)
    rows = [(sorted(rnd.sample(range(6), 3)), [rnd.random() for _ in range(3)], rnd.randint(0, 1)) for _ in range(40)]
    alpha, beta, l1, l2 = 0.7, 1.3, 0.05, 0.2
    learner = T.Ftrl(6, alpha, beta, l1, l2)
    z, n = [0.0] * 7, [0.0] * 7

    def weight(i):
        if abs(z[i]) <= l1:
            return 0.0
        return -(z[i] - math.copysign(l1, z[i])) / ((beta + math.sqrt(n[i])) / alpha + l2)

    for at, values, y in rows:
        learner.update(np.array(at), np.array(values), y, 1.5)
        w = {i: weight(i) for i in at}
        p = 1 / (1 + math.exp(-sum(w[i] * v for i, v in zip(at, values))))
        for i, v in zip(at, values):
            g = (p - y) * 1.5 * v
            s = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / alpha
            z[i] += g - s * w[i]
            n[i] += g * g
    assert np.allclose(learner.z, z) and np.allclose(learner.n, n)
    assert np.allclose(learner.weights(slice(None)), [weight(i) for i in range(7)])


def test_score_is_the_dot_product_of_the_slots(monkeypatch):
    rnd = np.random.default_rng(1)
    model, hasher = T.Model(rnd.normal(size=1 << 12), 0.1, 12), T.Hasher(12)
    texts = [b"", b"one", b"One two  two\n\tthree!! 42", b" \n ", b"a b " * 5000, "é É ß".encode(), b"x" * 9000]
    for stretch, group in ((1 << 20, 1 << 21), (40, 10), (500, 3000)):
        monkeypatch.setattr(T, "STRETCH", stretch)
        monkeypatch.setattr(T, "GROUP", group)
        got = model.score(texts, hasher)
        for t, s in zip(texts, got):
            slots, values = hasher.slots(t)
            assert s == pytest.approx(1 / (1 + math.exp(-(0.1 + model.weights[slots] @ values))))
        assert got == pytest.approx([model.score([t], T.Hasher(12, 2))[0] for t in texts])


def test_grams_stay_inside_their_text():
    hasher = T.Hasher(30)
    alone = [sorted(np.concatenate([s for s, _ in hasher.grams([t])]).tolist()) for t in (b"a b c", b"c d", b"", b"e")]
    both = [[], [], [], []]
    for slots, part in hasher.grams([b"a b c", b"c d", b"", b"e"]):
        for s, p in zip(slots.tolist(), part.tolist()):
            both[p].append(s)
    assert [sorted(x) for x in both] == alone


def test_shape():
    assert [T.shape_of(w) for w in (b"Word,", b"HELLO!!", b"x", "Été".encode(), b"a1b22", b"")] == [
        b"Aa,", b"A!", b"a", b"a", b"a0a0", b""]


def test_held_out_rows_are_told_well(spark):
    docs, labels = read(spark, SF01, "documents"), read(spark, SF01, "labels")
    model = T.fit(docs, labels)
    marks = {r["doc_id"]: r["quality"] for r in labels.collect()}
    rows = T.score(docs.select("doc_id", "text"), model, "score").collect()
    held = [(r["score"], marks[r["doc_id"]]) for r in rows
            if r["doc_id"] in marks and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    good, bad = ([s for s, y in held if y == c] for c in (1, 0))
    assert len(good) > 40 and len(bad) > 5
    assert np.mean(np.array(good) >= 0.7) >= 0.97 and np.mean(np.array(bad) < 0.7) >= 0.9


def test_held_out_labels_never_teach(spark, make_docs):
    docs = make_docs([(i, f"word{i % 7} text {i}") for i in range(200)])
    labels = [(i, i % 2) for i in range(200)]
    turned = [(i, 1 - y if zlib.crc32(str(i).encode()) % 4 == 2 else y) for i, y in labels]
    one, two = (T.fit(docs, spark.createDataFrame(x, "doc_id long, quality int")) for x in (labels, turned))
    assert np.array_equal(one.weights, two.weights) and one.bias == two.bias
    assert T.fit(docs.repartition(11), spark.createDataFrame(labels, "doc_id long, quality int")).bias == one.bias


def test_edges(spark, make_docs):
    docs = clash(make_docs([(1, None), (2, ""), (None, "some text"), (3, "same"), (3, "same"), (4, "w " * 400_000)]))
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = T.fit(docs, none)
    got = T.score(docs, model, "score").collect()
    assert len(got) == 6 and all(r["score_"] == 0.5 and r["score"] == "own score" for r in got)
    only = T.fit(docs, spark.createDataFrame([(3, 1), (4, 1), (None, 1), (2, None)], "doc_id long, quality int"))
    assert 0.5 < T.score(docs, only, "q").first()["q"] < 1
    assert T.score(docs.limit(0), only).count() == 0
    assert T.fit(docs.limit(0), spark.createDataFrame([(3, 1)], "doc_id long, quality int")).bias == 0

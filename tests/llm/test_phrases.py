"""Phrase collocations against a plain count, whatever the filter, the stretches and the partitions."""

import random
import re
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from sylvan.llm import phrases as P

from .conftest import clash

VOCABULARY = ["a", "b", "É", "the", "of", "x\x01", "q", "Zz", "to", "\x00", *(f"w{i}" for i in range(30))]


def pieces_of(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall("[^ \t]+", p) for p in re.split("[.,;:!?\n-\r]", text)]


def plain(rows, min_count, top):
    by_lang, out = defaultdict(list), []
    for text, lang in rows:
        by_lang["und" if lang is None else lang] += pieces_of(text)
    for lang, pieces in by_lang.items():
        n = sum(map(len, pieces))
        f = Counter(tuple(w[i:i + k]) for w in pieces for k in range(1, 6) for i in range(len(w) - k + 1))
        cand = {p: a for p, a in f.items() if a >= min_count and len(p) > 1}
        gone = {p[i:i + k] for p, a in cand.items() for k in range(2, len(p)) for i in range(len(p) - k + 1)
                if 100 * a >= 100 * cand[p[i:i + k]]}
        got = []
        for p in cand.keys() - gone:
            a = cand[p]
            score, k = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            got.append((score, a, " ".join(p), f[p[:k]], f[p[k:]]))
        got.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        out += [(lang, i, ph, a, left, right, n, s) for i, (s, a, ph, left, right) in enumerate(got[:top], 1)]
    return sorted(out)


def make(seed, rows=60):
    rnd = random.Random(seed)
    out = []
    for _ in range(rows):
        words = VOCABULARY[:rnd.choice([5, 12, 40])]
        text = "".join(rnd.choice(words) + rnd.choice([" ", "  ", "\t", " ", ". ", "\n", ","]) if rnd.random() < .9
                       else "new york city hall " for _ in range(rnd.randint(0, 120)))
        out.append((text, rnd.choice(["en", "en", "de", None])))
    return [*out, (None, "en"), ("", None), ("the of " * 400, "en"), ("the of", "und"), ("the of", "und")]


@pytest.mark.parametrize("bits, least, top", [(4, 1, 50), (16, 3, 50), (6, 7, 10)])
def test_equals_the_plain_count(spark, bits, least, top):
    rows = make(bits)
    docs = clash(spark.createDataFrame(rows, "text string, lang string").repartition(5))
    got = P.collocations(docs, least, top, bits).collect()
    assert sorted(map(tuple, got)) == plain(rows, least, top)


def test_phrases_that_span_many_partitions(spark):
    rows = make(77, 30)
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(7)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    aqe = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert sorted(map(tuple, P.collocations(docs, 2, 1000, 10).collect())) == plain(rows, 2, 1000)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", aqe)


@pytest.mark.parametrize("size", [1, 7, 64, 1 << 20])
def test_stretches_lose_no_phrase(size):
    rows = [t or "" for t, _ in make(3)] + ["word " * 3000, "x" * 20000 + " y", " . ", "a"]
    langs = np.arange(len(rows)) % 3
    got, want = Counter(), Counter()
    for seg in P.segments([r.encode() for r in rows], langs, size):
        for k in range(1, 6):
            ok = np.flatnonzero(seg.inside(k)[:seg.starts])
            for i in ok:
                got[int(seg.lang[i]), tuple(seg.names[c].decode() for c in seg.code[i:i + k])] += 1
    for r, lang in zip(rows, langs):
        for w in pieces_of(r):
            for k in range(1, 6):
                want.update((int(lang), tuple(w[i:i + k])) for i in range(len(w) - k + 1))
    assert got == want


def test_streams_carry_over_batches(monkeypatch):
    """Counts and extensions don't depend on how the sorted rows are cut into batches."""
    rnd = random.Random(1)
    windows = Counter(("en", *(w := [rnd.choice("abc").encode() for _ in range(rnd.randint(0, 5))]), *[b""] * (5 - len(w)))
                      for _ in range(400))
    rows = [(*k, n) for k, n in sorted(windows.items())]
    schema = pa.schema([*((f.name, f.type) for f in P._WINDOW if f.name != "part")])

    def run(size):
        monkeypatch.setattr(P, "STREAM_ROWS", size)
        batches = [P._record(list(zip(*rows[i:i + size])), schema) for i in range(0, len(rows), size)]
        return sorted(tuple(r.values()) for b in P._add_up(3)(iter(batches)) for r in b.to_pylist())
    whole = run(10_000)
    assert all(run(size) == whole for size in (1, 2, 5, 33))
    closed = {r[:6]: r[7:9] for r in whole if not r[9]}
    for key, (n, ext) in closed.items():
        k = sum(w != b"" for w in key[1:])
        inside = Counter()
        for other, c in windows.items():
            if other[:k + 1] == key[:k + 1]:
                inside[other[:k + 2]] += c
        assert n == sum(inside.values())
        assert ext == max((c for o, c in inside.items() if k < 5 and o[-1] != b""), default=0)


def test_scores_beyond_64_bits_are_exact():
    a, n = 9_999_999_967, 10 ** 15 + 37
    assert P.weakest_cut(a, n, [a + 5, a + 3], [a + 7, a + 1])[0] == min(
        1000 * a * n // ((a + 5) * (a + 7)), 1000 * a * n // ((a + 3) * (a + 1)))


def test_empty_table_and_bad_parameters(spark):
    empty = spark.createDataFrame([], "text string, lang string")
    assert P.collocations(empty, 2, 10, 8).count() == 0
    assert P.collocations(spark.createDataFrame([(None, None)], "text string, lang string"), 1, 10, 8).count() == 0
    with pytest.raises(ValueError):
        P.collocations(empty, 0)


def test_windows_follow_the_readers_not_the_splits(spark):
    """The same text in ten times as many splits makes no more windows, and the same phrases."""
    def run(parts):
        docs = spark.createDataFrame(make(5), "text string, lang string").repartition(parts)
        scored, held = P.scored_phrases(docs, 3, 16, readers=4)
        found = sorted(map(tuple, scored.collect()))
        count = held[0].count()
        for table in held:
            table.unpersist()
        return found, count
    (few, rows), (many, more) = run(4), run(40)
    assert many == few and few
    assert more <= 1.3 * rows


def test_a_full_task_lets_rare_windows_go_and_keeps_frequent_ones(monkeypatch):
    rnd = random.Random(8)
    texts = [". ".join(["new york city hall"] * 5 + [f"w{rnd.randrange(500)} v{rnd.randrange(500)}" for _ in range(20)])
             for _ in range(60)]
    schema = pa.schema([("text", pa.binary()), ("lang", pa.string())])
    batches = [P._record([[t.encode()], [lang]], schema) for t, lang in zip(texts, ["en", "de"] * 30)]
    monkeypatch.setattr("pyspark.TaskContext.get", lambda: SimpleNamespace(partitionId=lambda: 0))

    def run(room):
        monkeypatch.setattr(P, "HELD_WINDOWS", room)
        every = {k: np.full((P.TABLES, 2), 255, np.uint8) for k in range(1, P.ORDER + 1)}
        got = [r for b in P._windows(lambda: every, 4)(iter(batches)) for r in b.to_pylist()]
        total, rows = Counter(), Counter()
        for r in got:
            key = tuple(r[c] for c in P.KEY)
            total[key] += r["n"]
            rows[key] += 1
        return total, rows
    (whole, once), (same, rows) = run(1_000_000), run(120)
    assert same == whole and set(once.values()) == {1}
    assert max(rows.values()) > 1                                   # rare windows left the task in parts
    assert {rows[k] for k, n in whole.items() if n == 150} == {1}   # the frequent ones never did
    assert sum(n == 150 for n in whole.values()) == 8


def test_tables_grow_with_the_text_up_to_a_bound(spark, monkeypatch):
    """Eight times the text with as many more phrases: no larger share of the windows is rare ones."""
    assert [P.table_bits(n) for n in (0, 1 << 30, (1 << 30) + 128, 1 << 32, 1 << 60)] == [23, 23, 24, 25, P.MOST_BITS]
    monkeypatch.setattr(P, "LEAST_BITS", 11)
    monkeypatch.setattr(P, "TEXT_PER_COUNTER", 16)

    def run(rows):
        rnd = random.Random(rows)
        docs = [(" ".join(f"w{rnd.randrange(40 * rows)}" for _ in range(200)) + ". " + "the of " * 5, "en") for _ in range(rows)]
        frame = spark.createDataFrame(docs, "text string, lang string").repartition(2)
        scored, held = P.scored_phrases(frame, 20, readers=2)
        scored.count()
        count = held[0].count()
        for table in held:
            table.unpersist()
        return count, frame, docs
    (few, *_), (many, frame, docs) = run(25), run(200)
    assert many <= 8 * few
    assert sorted(map(tuple, P.collocations(frame, 20, 50).collect())) == plain(docs, 20, 50)

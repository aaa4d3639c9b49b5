"""Operators that judge a text by itself, against plain restatements."""

import hashlib
import random
import re
import time
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sylvan.llm import langid, pii, quality, tiling, tokens, toxicity

from ..conftest import SF01
from .conftest import CLASHING, clash

PIECES = public_tokenizers.path("piece_bpe_32k.model")


# ---- personal data ----------------------------------------------------------

def brute_base(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m.group() if c.isdigit()][::-1]
        if 16 <= len(d) <= 19 and sum(d[::2] + [x // 5 * -9 + 2 * x for x in d[1::2]]) % 10 == 0:
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 8 <= sum(c.isdigit() for c in m.group()) <= 15]
    return out


def test_base_spans_match_the_patterns():
    r = random.Random(5)
    bits = ["a", "x.y", "@", ".", "com", "1", "22", "255", "256", " ", "-", "+", "(", ")", "4539578763621486", "é", "0"]
    for _ in range(20000):
        t = "".join(r.choice(bits) for _ in range(r.randint(0, 14)))
        assert pii.base_spans(t) == brute_base(t), t


def test_spans_keep_the_base_and_add_candidates(spark, make_docs):
    texts = ["mail joe.doe@example.com or call +1 (415) 555-2671 now", None, "", "no data in here",
             "write to joe (at) example (dot) org", "call 415-555-2671 or (415) 555-2672 today", "version 4.0.1 only"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(100 + i, f"phone: (415) 555-{1000 + i} ok") for i in range(40)]
    got = {r["doc_id"]: r for r in pii.span_digest(pii.find_spans(clash(make_docs(rows)))).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        base = brute_base(t or "")
        joined = [f"{k}:{a}:{b}" for k, a, b in base]
        assert got[i]["base_sha256"] == hashlib.sha256(",".join(joined).encode()).hexdigest()
        assert set(joined) <= set(got[i]["spans"].split(",")) | {""}
        assert [got[i][f"n_{k}"] for k in pii.KINDS] == [sum(x == k for x, _, _ in base) for k in pii.KINDS]
    assert got[3]["spans"] == "" and got[6]["spans"] == "" and got[1]["spans"] == ""
    assert all(got[100 + i]["spans"] == "phone:7:21" for i in range(40))


def test_reliabilities_find_the_informative_labeler():
    rng = np.random.default_rng(0)
    y = rng.random(4000) < 0.4
    v = np.column_stack([np.where(rng.random(4000) < a, y, ~y) for a in (0.95, 0.9, 0.55)]).astype(int)
    pats, n = np.unique(v, axis=0, return_counts=True)
    p, table = pii.reliabilities(pats, n.astype(float))
    assert table[1, 0, 1] > table[1, 2, 1] and table[1, 0, 1] > 0.85
    right = {tuple(k): q for k, q in zip(pats.tolist(), p)}
    assert np.mean([(right[tuple(a)] > 0.5) == b for a, b in zip(v.tolist(), y)]) > 0.93


def test_spans_of_an_empty_table(make_docs):
    assert pii.span_digest(pii.find_spans(make_docs([]))).collect() == []


# ---- quality ----------------------------------------------------------------

def brute_counts(t):
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    w3 = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    c = Counter(w3)
    rep = {j for i, w in enumerate(w3) if c[w] > 1 for j in range(i, i + 3)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(ch in "#*$%&|<>" for ch in t), dup, len(rep)


def test_rule_counts():
    r = random.Random(2)
    for _ in range(3000):
        t = "".join(r.choice(["a ", "b ", "é", "#", " | ", "\n", "\t", "\x0b", "\x1f", "\xa0", "c d e "])
                    for _ in range(r.randint(0, 40)))
        assert quality.rule_counts(t.encode()) == brute_counts(t), t


def test_forest_rejects_what_the_labels_reject(spark, make_docs):
    r = random.Random(3)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(2, 8)))
    rows, labels = [], []
    for i in range(600):
        w = [word() for _ in range(r.randint(60, 200))]
        junk = i % 6 == 0
        rows.append((i, " ".join(x + "###" if junk else x for x in w)))
        if i % 2 == 0 or i % 3 == 0:
            labels.append((i, int(not junk), 0))
    rows += [(1000, None), (1001, ""), (1002, "too short"), (0, rows[0][1])]
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    docs = clash(make_docs(rows))
    got = quality.judge(docs, lab, out="verdict").select("doc_id", "verdict.*", "stats").collect()
    assert len(got) == len(rows) and {g["stats"] for g in got} == {"own stats"}
    kept = {g["doc_id"]: g["kept"] for g in got}
    good = [kept[i] for i in range(600) if i % 6]
    assert np.mean(good) > 0.98 and not any(kept[i] for i in range(0, 600, 6))
    assert not any(kept[i] for i in (1000, 1001, 1002))
    left = quality.quality_filter(docs, lab)
    assert left.columns == docs.columns and left.count() == sum(g["kept"] for g in got)


def test_forest_and_threshold_come_from_every_labelled_row(spark, make_docs):
    """With ``keep_share`` 1 no accepted row may be lost, however many there are and wherever the odd ones lie."""
    r = random.Random(5)
    words = ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 8))) for _ in range(500)]
    odd = {i * 600 + 7: i + 1 for i in range(20)}                 # accepted, each odder than the one before
    rows = [(i, " ".join(w + ("#" if i in odd and j < 2 * odd[i] or i % 10 == 0 else "")
                         for j, w in enumerate(r.choices(words, k=60)))) for i in range(12000)]
    lab = spark.createDataFrame([(i, int(i % 10 != 0), 0) for i in range(12000)], "doc_id long, quality int, toxic int")
    docs = make_docs(rows)
    kept = {g["doc_id"] for g in quality.judge(docs, lab, keep_share=1.0).filter("rules.kept").collect()}
    assert not [i for i in range(12000) if i % 10 and i not in kept]
    one, other = quality.fit(docs, lab), quality.fit(docs.repartition(11), lab.repartition(5))
    assert one.threshold == other.threshold and (one.cut == other.cut).all() and (one.feature == other.feature).all()


def test_separation_and_ranges_by_brute_force(spark):
    r = np.random.default_rng(4)
    x, good = np.round(r.normal(size=(900, quality.N_FEATURES)), 1), r.random(900) < 0.7
    x[:, 0] += good
    rows = spark.createDataFrame([(bool(g), v.tolist()) for g, v in zip(good, x)],
                                 "good boolean, x array<double>").repartition(7)
    auc = np.array([np.mean((a := x[good, f][:, None] - x[~good, f][None]) > 0) + np.mean(a == 0) / 2
                    for f in range(quality.N_FEATURES)])
    want = (2 * auc - 1) ** 2 + 1e-6
    assert np.allclose(quality.separation(rows), want / want.sum(), rtol=1e-9)
    cut = float(x[5, 0])
    forest = quality.Forest(np.array([0, -1, -1]), np.array([cut, 0, 0]), np.array([1, 0, 0]), np.array([0]), 1, 1.0, 1.0)
    n, low, high = quality._node_ranges(rows, forest, np.array([-1, 0, 1]), 2)
    for k, at in enumerate((x[:, 0] < cut, x[:, 0] >= cut)):
        assert n[k] == (good & at).sum() and (low[k] == x[at].min(0)).all() and (high[k] == x[at].max(0)).all()


def test_quality_without_labels_or_rows(spark, make_docs):
    lab = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    long = " ".join(f"w{i}" for i in range(60))
    got = {r["doc_id"]: r["kept"] for r in quality.judge(make_docs([(1, long), (2, "x")]), lab)
           .select("doc_id", "rules.kept").collect()}
    assert got == {1: True, 2: False}
    assert quality.judge(make_docs([]), lab).count() == 0


# ---- language ---------------------------------------------------------------

def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text", "lang")
    got = langid.identify(docs).filter("held_out and lang_pred <> 'und'").collect()
    assert len(got) > 100
    assert np.mean([g["lang"] == g["lang_pred"] for g in got]) > 0.95
    assert all(0 <= g["score"] <= 1 for g in got)


def test_language_edges(make_docs):
    rows = [(i, "the cat and the dog " * 3, "en") for i in range(20)]
    rows += [(100 + i, "der hund und die katze " * 3, "de") for i in range(20)]
    rows += [(200 + i, "le chat et la souris " * 3, "fr") for i in range(20)]
    rows += [(300, None, "en"), (301, "", None), (302, "123 !!", "en"), (None, "und die katze der hund", None)]
    out = {r["doc_id"]: r for r in langid.identify(make_docs(rows)).collect()}
    assert out[300]["lang_pred"] == out[301]["lang_pred"] == out[302]["lang_pred"] == "und"
    assert out[None]["lang_pred"] == "de" and out[5]["lang_pred"] == "en" and out[205]["lang_pred"] == "fr"
    assert langid.identify(make_docs([])).count() == 0
    nothing = langid.identify(make_docs([(1, "some words", None)])).collect()
    assert nothing[0]["lang_pred"] == "und" and nothing[0]["score"] == 0
    own = langid.identify(clash(make_docs(rows)))
    assert own.select("score").distinct().count() == 1 and "score_" in own.columns


def test_pairwise_machine_separates():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 20)).astype(np.float32)
    y = np.where(x[:, 3] - x[:, 7] > 0, 1, -1)
    w = langid.svm_fit(x, y)
    assert np.mean(np.sign(x @ w) == y) > 0.95


# ---- toxicity ---------------------------------------------------------------

def toxic_rows(n, seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(2, 6)))
    rows, y = [], []
    for i in range(n):
        w = [word() for _ in range(r.randint(20, 60))]
        junk, toxic = r.random() < 0.2, r.random() < 0.3
        if toxic:
            w.insert(r.randint(0, len(w)), r.choice(["zonkard", "zonkly", "vex"]))
        if junk:
            w = [x + " |" for x in w]
        rows.append(" ".join(w))
        y.append((int(junk), int(toxic)))
    return rows, np.array(y)


def test_chain_learns_and_feeds_forward():
    texts, y = toxic_rows(700, 1)
    model = toxicity.train_chain(pa.array([sorted(toxicity.tokens_of(t)) for t in texts]), y, np.arange(700) % 5, ["junk", "toxic"])
    assert len(model.links[0].earlier) == 0 and len(model.links[1].earlier) == 1
    new, z = toxic_rows(400, 2)
    p = model.predict([toxicity.tokens_of(t) for t in new])
    for j in (0, 1):
        assert np.mean((p[:, j] >= model.thresholds[j]) == z[:, j]) > 0.97


def test_toxicity_edges(spark, make_docs):
    texts, y = toxic_rows(300, 4)
    docs = make_docs([(i, t) for i, t in enumerate(texts)] + [(900, None), (901, ""), (None, "vex"), (0, texts[0])])
    labels = spark.createDataFrame([(i, int(a), int(b)) for i, (a, b) in enumerate(y)] + [(5, None, 1), (None, 1, 1)],
                                   "doc_id long, junk int, toxic int")
    model = toxicity.fit(docs, labels, ["junk", "toxic"])
    got = toxicity.classify(clash(docs), model, "verdict").select("doc_id", "verdict.*").collect()
    assert len(got) == 304
    by = {g["doc_id"]: g for g in got}
    assert not by[900]["is_toxic"] and not by[901]["is_toxic"]
    assert np.mean([by[i]["is_toxic"] == bool(y[i][1]) for i in range(300)]) > 0.97
    none = toxicity.fit(docs, labels.limit(0), ["junk", "toxic"])
    taught = toxicity.classify(docs, none).select("chain.*").distinct().collect()
    assert [tuple(r) for r in taught] == [(0.5, False, 0.5, False)]
    assert toxicity.classify(make_docs([]), model).count() == 0


# ---- decontamination --------------------------------------------------------

def brute_tiles(doc, item, least):
    d, t = [True] * len(doc), [True] * len(item)
    while True:
        best = (0, 0, 0)
        for j in range(len(item)):
            for i in range(len(doc)):
                n = 0
                while i + n < len(doc) and j + n < len(item) and d[i + n] and t[j + n] and doc[i + n] == item[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < least:
            return t.count(False)
        for k in range(n):
            d[i + k] = t[j + k] = False


def test_tiling_equals_the_plain_algorithm():
    r = random.Random(9)
    for k in range(400):
        few = 40 if k % 2 else 3                                   # many repeated words
        item = [r.randint(1, few) for _ in range(r.randint(1, 40))]
        doc = [r.randint(1, few + 20) for _ in range(5)]
        for _ in range(r.randint(0, 4)):
            a = r.randint(0, len(item))
            doc += item[a:a + r.randint(1, 20)] + [r.randint(few + 1, few + 20) for _ in range(r.randint(0, 3))]
        got = tiling.tile(np.array(doc, np.uint64), np.array(item, np.uint64), 3)
        assert got == brute_tiles(doc, item, 3), (doc, item)


def test_tiling_of_repeated_words_takes_seconds():
    one, item = np.full(20_000, 7, np.uint64), np.full(400, 7, np.uint64)
    began = time.time()
    assert tiling.tile(one, item, 5) == 400
    assert tiling.tile(np.tile(np.array([1, 2, 3], np.uint64), 7000), np.tile(np.array([1, 2], np.uint64), 300), 2) == 600 - 600 % 2
    assert time.time() - began < 20


def bench_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


@pytest.mark.parametrize("bits", [3, 12, 22])
def test_reordered_passages_are_caught(spark, make_docs, bits):
    item = " ".join(f"alpha{i} beta{i}" for i in range(15))
    words = item.split()
    moved = " ".join(words[20:] + ["filler", "words"] + words[:10] + ["more"] + words[10:20])
    rows = [(1, f"Start. {item.upper()} end"), (2, moved), (3, "nothing of it here at all today"), (4, None), (5, ""),
            (6, " ".join(words[:9])), (None, item), (2, moved), (7, "tiny item")]
    bench = bench_of(spark, [(0, item), (1, None), (2, ""), (3, "tiny item")])
    got = sorted((str(r["doc_id"]), r["item"], r["coverage"])
                 for r in tiling.contaminated(make_docs(rows), bench, filter_bits=bits).collect())
    assert got == [("1", "0", 1.0), ("2", "0", 1.0), ("2", "0", 1.0), ("7", "3", 1.0), ("None", "0", 1.0)]
    left = tiling.decontaminate(clash(make_docs(rows)), bench, filter_bits=bits)
    assert sorted(r["doc_id"] for r in left.collect()) == [3, 4, 5, 6] and set(CLASHING) <= set(left.columns)
    assert tiling.contaminated(make_docs(rows), bench.limit(0)).count() == 0
    assert tiling.contaminated(make_docs([]), bench).count() == 0


def test_search_equals_tiling_every_pair(spark, make_docs):
    """Whole texts against whole items, by the plain algorithm, for every pair that shares a seed."""
    r = random.Random(4)
    vocabulary = [f"w{i}" for i in range(25)]
    items = [[r.choice(vocabulary) for _ in range(r.choice([2, 4, 12, 30]))] for _ in range(12)]
    items.append(list(items[3]))                                   # an item that comes twice
    rows = []
    for i in range(40):
        words = [r.choice(vocabulary) for _ in range(r.randint(0, 30))]
        for _ in range(r.randint(0, 3)):
            it = r.choice(items)
            a = r.randint(0, len(it) // 3)
            words += it[a:] + [r.choice(vocabulary)] + it[:a]
        rows.append((i, ", ".join(words)))
    rows.append((99, "w1 " * 30_000))                              # a very long text of one word
    bench = bench_of(spark, [(i, " ".join(w)) for i, w in enumerate(items)])
    got = {(x["doc_id"], h["item"]): h["coverage"] for x in tiling.matches(make_docs(rows), bench, threshold=0.3).collect() for h in x["hits"]}
    want = {}
    for d, text in rows[:-1]:
        doc = tiling.words_of(text)
        for i, it in enumerate(items):
            n = min(5, len(it))
            share = brute_tiles(doc, it, n) / len(it)
            if share >= 0.3:
                want[d, str(i)] = share
    assert got == want and any(0.3 < v < 1 for v in want.values())


# ---- token counts -----------------------------------------------------------

def test_counts_equal_the_library(spark, make_docs, monkeypatch):
    r = random.Random(1)
    bits = [" ", "  ", "a", "Bc", "é", "\n", "\t", "<s>", "日", "▁", "😀", " the", "."]
    texts = ["".join(r.choice(bits) for _ in range(r.randint(0, 12))) for _ in range(20000)] + ["", " ", "  ", "   "]
    counter = tokens.PieceCounter(PIECES)
    assert counter.safe
    want = [len(x) for x in counter.model.encode(texts, num_threads=1)]
    assert counter.counts(texts) == want
    monkeypatch.setattr(tokens.segments, "__defaults__", (5,))       # every text split at safe boundaries
    assert counter.counts(texts) == want


def test_token_count_columns(make_docs):
    long = "many words here " * 4000
    docs = make_docs([(1, "plain words"), (2, None), (3, ""), (4, long), (1, "plain words"), (None, "é")])
    rows = tokens.count_tokens(docs, PIECES, 4096).select("doc_id", "n_bytes", "n_tokens", "over_limit").collect()
    got = sorted((str(r[0]), *r[1:]) for r in rows)
    model = tokens.PieceCounter(PIECES).model
    n = lambda t: len(model.encode(t))
    assert got == sorted([("1", 11, n("plain words"), False), ("2", 0, 0, False), ("3", 0, 0, False),
                          ("4", len(long), n(long), True), ("1", 11, n("plain words"), False), ("None", 2, n("é"), False)])
    assert "n_tokens_" in tokens.count_tokens(clash(docs), PIECES).columns
    assert tokens.count_tokens(make_docs([]), PIECES).count() == 0


def test_groups_are_balanced_by_bytes():
    groups = list(tokens.groups_by_bytes(["a" * n for n in (5, 5, 30, 1, 1, 1)] + [None], 10))
    assert [sum(map(len, g)) for g in groups] == [10, 30, 3] and sum(map(len, groups)) == 7


@pytest.mark.parametrize("ranks", [True, False])
def test_byte_ids_equal_the_library(ranks):
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    coder = tokens.ByteIds(path, public_tokenizers.path("byte_bpe_50k.tiktoken") if ranks else None)
    lib, r = Tokenizer.from_file(path), random.Random(3)
    bits = [" ", "  ", "a", "Bc", "é", "\n", "\t", "<|endoftext|>", "日", "'s", "’", "12", "\x1c", "\xa0", "　", "ß", "."]
    for _ in range(4000):
        t = "".join(r.choice(bits) for _ in range(r.randint(0, 14)))
        assert coder.ids(t) == lib.encode(t, add_special_tokens=False).ids, t


# ---- edges that the queries meet ------------------------------------------------

def test_queries_on_empty_tables(spark, make_docs, tmp_path):
    """No document, no label or no benchmark item: every query gives its schema and no row (or a row a document)."""
    from sylvan.llm.queries import QUERIES
    docs = make_docs([(1, "Some text, mail a@b.cd and more words."), (2, None), (None, "")])
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1)], "doc_id long, quality int, toxic int")
    bench = bench_of(spark, [(0, "one two three four five six")])
    whole = {"documents": docs, "labels": labels, "benchmark": bench}
    for gone in whole:
        home = tmp_path / gone
        for name, table in whole.items():
            (table.limit(0) if name == gone else table).write.parquet(str(home / f"{name}.parquet"))
        for name, (query, _sql) in QUERIES.items():
            rows = query(spark, str(home)).collect()
            if gone == "documents":
                assert rows == [], name
            elif not name.startswith(("op9_", "op11_", "op13_")):
                assert len({r["doc_id"] for r in rows}) == 3, name


def test_letters_are_letters():
    assert not any(map(langid.has_letter, ("", "12 ²½", "①②", "ⅧⅫ", "_-.", "٣")))
    assert all(map(langid.has_letter, ("a", "² é", "ª", "ⅧÑ", "日", "ʰ")))


def test_a_long_list_of_phones_takes_seconds():
    text = " ".join(f"({i % 900 + 100}) 555-{i % 9000 + 1000}" for i in range(200_000))
    began = time.time()
    got = pii.wide_spans(text, pii.base_spans(text))
    assert len(got) > 100_000 and time.time() - began < 60
    assert all(a[2] <= b[1] for a, b in zip(sorted(got, key=lambda s: s[1]), sorted(got, key=lambda s: s[1])[1:]))


def test_remembered_parts_are_short():
    from sylvan.llm.queries import PIECES
    counter = tokens.PieceCounter(PIECES)
    texts = ["x" * 5000 + f"{i} word" for i in range(20)]
    assert counter.counts(texts) == [len(counter.model.encode(t)) for t in texts]
    assert max(map(len, counter.known)) <= tokens.LONGEST_REMEMBERED
    assert [len(g) for g in tokens.groups_by_bytes(["é" * 600, "a" * 500, None, "b" * 900], 1500)] == [1, 3]


def test_vocabularies_are_compared_when_loaded(tmp_path):
    import base64
    import json
    from sylvan.llm.queries import BYTE_IDS, BYTE_RANKS
    with open(BYTE_RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    assert tokens.same_vocabulary(BYTE_IDS, ranks) and tokens.ByteIds(BYTE_IDS, BYTE_RANKS).fast is not None
    assert sorted(tokens.byte_letters().values()) == list(range(256))
    swapped = {**ranks, b"the": ranks[b" the"], b" the": ranks[b"the"]}
    assert not tokens.same_vocabulary(BYTE_IDS, swapped)
    with open(BYTE_IDS, encoding="utf-8") as f:
        spec = json.load(f)
    for change in (lambda s: s["model"]["merges"].reverse(), lambda s: s["pre_tokenizer"].update(add_prefix_space=True),
                   lambda s: s["added_tokens"][0].update(lstrip=True)):
        other = json.loads(json.dumps(spec))
        change(other)
        path = tmp_path / "other.json"
        path.write_text(json.dumps(other), encoding="utf-8")
        assert not tokens.same_vocabulary(str(path), ranks)


def test_long_texts_are_encoded_in_parts():
    from tokenizers import Tokenizer
    from sylvan.llm.queries import BYTE_IDS, BYTE_RANKS
    r, lib = random.Random(3), Tokenizer.from_file(BYTE_IDS)
    bits = [" a", "b c", "  ", "\n", " x's", "'ll go", "1 2", " é", "日 本", "<|endoftext|>", " the end", "\t q", " \u2028 z"]
    for _ in range(60):
        text = "".join(r.choice(bits) for _ in range(r.randint(0, 120)))
        parts = list(tokens.safe_parts(text, 10))
        assert "".join(parts) == text
        assert [i for p in parts for i in lib.encode(p, add_special_tokens=False).ids] == lib.encode(text, add_special_tokens=False).ids
    text = "some words " * 60_000
    coder = tokens.ByteIds(BYTE_IDS, BYTE_RANKS)
    assert len(list(tokens.safe_parts(text))) > 2 and coder.array(text, "<u4").tolist() == coder.ids(text)

"""Registered queries against their SQL, and the pipeline against its restated stages."""

from collections import defaultdict

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline
from sylvan.llm import quality, tiling
from sylvan.llm.common import read
from sylvan.llm.queries import QUERIES

from ..conftest import SF001
from ..test_entry_and_oracles import _rows
from .test_corpus_operators import brute_fingerprint, brute_lines


def test_all_operators_are_registered():
    names = set(E.queries())
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)) and "pipeline" in names


@pytest.mark.parametrize("name", [n for n, (_, sql) in QUERIES.items() if sql])
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for name_ in ("documents", "labels"):
        con.execute(f"create view {name_} as select * from read_parquet('{SF001}/{name_}.parquet')")
    got = E.queries()[name](spark, SF001).toPandas()
    assert _rows(got) == _rows(con.execute(QUERIES[name][1]).df())


@pytest.mark.parametrize("name", [n for n, (_, sql) in QUERIES.items() if not sql])
def test_query_covers_every_document(spark, name):
    docs = {r[0] for r in read(spark, SF001, "documents").select("doc_id").collect()}
    got = {r[0] for r in E.queries()[name](spark, SF001).select("doc_id").collect()}
    assert got == docs if not name.startswith("op9_") else got < docs


def plain_coverage(doc, item):
    """Greedy tiling by the longest common run of unmarked words, found by dynamic programming."""
    d, t, least = [True] * len(doc), [True] * len(item), min(5, len(item))
    while True:
        best, before = (0, 0, 0), {}
        for j, w in enumerate(item):
            now = {}
            if t[j]:
                for i in [i for i, x in enumerate(doc) if x == w and d[i]]:
                    now[i] = before.get(i - 1, 0) + 1
                    best = max(best, (now[i], -(j - now[i] + 1), -(i - now[i] + 1)))
            before = now
        n, j, i = best[0], -best[1], -best[2]
        if n < least:
            return t.count(False) / len(item)
        d[i:i + n], t[j:j + n] = [False] * n, [False] * n


def test_pipeline_rules_learn_from_every_labelled_row(spark, make_docs, tmp_path):
    """The share of accepted rows to keep holds over all labelled rows, also if the odd ones are 100 of 12,000."""
    share = "pmod(xxhash64(id, 'sample'), 4294967296) / 4294967296"
    odd = {r["id"] for r in spark.range(12000).filter(f"{share} > 0.5 and id % 10 > 0").limit(100).collect()}
    rows = [(i, " ".join(f"w{j}{'x' * ((i * j) % 7)}" + ("###" if i in odd else "#" if i % 10 == 0 and j < 30 else "")
                         for j in range(60))) for i in range(12000)]
    spark.createDataFrame([(i, int(i % 10 > 0), 0) for i in range(12000)], "doc_id long, quality int, toxic int"
                          ).write.parquet(str(tmp_path / "labels.parquet"))
    left = {r["doc_id"] for r in corpus_pipeline.quality_rules(spark, make_docs(rows), str(tmp_path)).collect()}
    good = [i for i in range(12000) if i % 10]
    assert sum(i in left for i in good) >= 0.995 * len(good)


def test_pipeline_stages(spark, tmp_path):
    docs = read(spark, SF001, "documents")
    shape = docs.columns
    tables = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, tables[-1], SF001).write.parquet(path)
        tables.append(spark.read.parquet(path))
    rules, cut, single, clean, packed = ([(r["doc_id"], r["text"]) for r in t.collect()] if "text" in t.columns
                                         else t.collect() for t in tables[1:])
    assert all(t.columns == shape for t in tables[:-1])
    # quality: the verdict column decides
    kept = {r["doc_id"] for r in quality.judge(docs, read(spark, SF001, "labels")).filter("rules.kept").collect()}
    assert {d for d, _ in rules} == kept and 0 < len(kept) < docs.count()
    # lines: by brute force over what quality kept
    want, _ = brute_lines(rules, 10, 1, "none")
    assert sorted(cut) == sorted((d, "\n".join(s for s, x in want[d, t] if not x)) for d, t in rules)
    # near-duplicates: one document of each component
    fp = {d: brute_fingerprint(t) for d, t in cut}
    group = {d: d for d in fp}
    for a in sorted(fp):
        for b in sorted(fp):
            if a < b and bin(fp[a] ^ fp[b]).count("1") <= 2:
                x, y = group[a], group[b]
                group = {k: min(x, y) if v in (x, y) else v for k, v in group.items()}
    assert sorted(d for d, _ in single) == sorted(set(group.values()))
    # benchmark: exactly the covered ones go
    items = [tiling.words_of(r["text"]) for r in read(spark, SF001, "benchmark").collect()]
    seeds = defaultdict(set)
    for i, w in enumerate(items):
        n = min(5, len(w))
        for a in range(len(w) - n + 1 if n else 0):
            seeds[tuple(w[a:a + n])].add(i)
    hit = set()
    for d, t in single:
        w = tiling.words_of(t)
        near = {i for n in range(1, 6) for a in range(len(w) - n + 1) for i in seeds.get(tuple(w[a:a + n]), ())}
        if any(plain_coverage(w, items[i]) >= 0.8 for i in near):
            hit.add(d)
    assert {d for d, _ in clean} == {d for d, _ in single} - hit
    # packing: every token of what is left, once
    length = {}
    for p in packed:
        length[p["doc_id"]] = length.get(p["doc_id"], 0) + p["length"]
        assert p["start"] + p["length"] <= p["doc_tokens"]
    assert length == {p["doc_id"]: p["doc_tokens"] for p in packed} and set(length) == {d for d, _ in clean}
    assert corpus_pipeline.run(spark, SF001).count() == len(packed)

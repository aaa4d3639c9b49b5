"""Operators that compare documents with each other, against brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from sylvan.llm import components, lines, packing, queries, sharding, simhash, sql, tokens

from .conftest import CLASHING, clash

IDS = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


# ---- line dedup -------------------------------------------------------------

def brute_lines(rows, min_docs, min_chars, keep):
    key = lambda s: "".join(c.lower() if "A" <= c <= "Z" else c for c in s.strip(" \t\n\x0b\x0c\r"))
    docs = sorted({(d, t or "") for d, t in rows}, key=repr)
    where = defaultdict(set)
    for i, (_, t) in enumerate(rows):                          # every row is a document
        for line in (t or "").split("\n"):
            where[key(line)].add(i)
    often = {k for k, v in where.items() if len(v) >= min_docs and len(k) >= min_chars}
    return {d: [(line, key(line) in often) for line in d[1].split("\n")] for d in docs}, often


def random_lines(seed, n=120):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        some = [r.choice(["Hot line", " hot LINE\t", f"own {i}", f"rare {i % 50}", f"often {i % 6}", "", "é"])
                for _ in range(r.randint(0, 9))]
        rows.append((i, "\n".join(some) if some else r.choice([None, ""])))
    return rows + [rows[3], (None, "hot line\nx"), (3, "hot line\nother")]


@pytest.mark.parametrize("parts", ["1", "7", "40"])
@pytest.mark.parametrize("min_docs,min_chars", [(10, 1), (2, 3), (1, 0)])
def test_repeated_lines_against_brute_force(spark, make_docs, parts, min_docs, min_chars):
    rows = random_lines(int(parts))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        docs = clash(make_docs(rows))
        cut = lines.apply_bitmaps(docs, lines.keep_bitmaps(docs, min_docs, min_chars), out="cut")
        got = Counter((r[0], r[1] or "", r[2], r[3], bytes(r[4])) for r in
                      cut.select("doc_id", "text", "cut.n_lines", "cut.n_dropped", "cut.text").collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want, _ = brute_lines(rows, min_docs, min_chars, "none")
    assert got == Counter((d, t or "", len(want[d, t or ""]), sum(x for _, x in want[d, t or ""]),
                           "\n".join(s for s, x in want[d, t or ""] if not x).encode()) for d, t in rows)


@pytest.mark.parametrize("parts", ["1", "9"])
def test_first_occurrence_stays(spark, make_docs, parts):
    rows = random_lines(5)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        out = lines.line_dedup(make_docs(rows), min_docs=2, min_chars=1, keep="first")
        left = Counter()
        seen = set()
        for r in out.collect():
            if (r["doc_id"], r["text"]) not in seen:      # equal rows are one document
                seen.add((r["doc_id"], r["text"]))
                left.update(s.strip(" \t").lower() for s in (r["text"] or "").split("\n"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    _, often = brute_lines(rows, 2, 1, "first")
    assert often and all(left[k] == 1 for k in often), {k: left[k] for k in often}


@pytest.mark.parametrize("parts", ["1", "9", "50"])
@pytest.mark.parametrize("keep", ["none", "first"])
def test_equal_rows_are_documents_of_their_own(spark, make_docs, parts, keep):
    rows = [(7, "hot\nmine\nhot")] * 10 + [(8, "hot\nrare"), (9, "rare")] + [(10, "a\nb\na")] * 30
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = Counter((r["doc_id"], r["text"]) for r in lines.line_dedup(make_docs(rows), keep=keep).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    if keep == "none":
        assert got == Counter({(7, ""): 10, (8, "rare"): 1, (9, "rare"): 1, (10, ""): 30})
    else:       # the leading document keeps the first occurrence, in all its equal rows
        assert got[7, "hot\nmine"] + got[7, "mine"] == 10 and got[10, "a\nb"] == 30
        assert got[8, "hot\nrare"] + got[8, "rare"] == 1 and (got[8, "hot\nrare"] == 1) != (got[7, "hot\nmine"] == 10)


def test_line_query_counts_equal_rows_as_its_sql(spark, make_docs, tmp_path):
    rows = [(7, "hot\nmine")] * 10 + [(i, f"hot {i % 3}\n\nx{i}") for i in range(40)] + [(None, None)] * 11
    make_docs(rows).write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = Counter(con.execute(sql.LINE_DEDUP).fetchall())
    got = queries.op7_line_dedup(spark, str(tmp_path)).select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect()
    assert Counter(map(tuple, got)) == want and want[7, 2, 2, hashlib.sha256(b"").hexdigest()] == 10


def test_line_edges(spark, make_docs):
    rows = [(i, "same\nsame") for i in range(12)] + [(50, None), (51, "")]
    out = lines.line_dedup(clash(make_docs(rows)))
    assert {r["doc_id"]: r["text"] for r in out.collect()} == {**{i: "" for i in range(12)}, 50: None, 51: ""}
    assert set(CLASHING) <= set(out.columns) and out.filter("doc_id < 12").agg(F.max("n_chars")).first()[0] == 0
    assert lines.line_dedup(make_docs([])).count() == 0
    with pytest.raises(ValueError):
        lines.keep_bitmaps(make_docs(rows), keep="last")


# ---- fingerprints -----------------------------------------------------------

def brute_fingerprint(text, k=3):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    words = [w for w in low.split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprints():
    r = random.Random(1)
    for _ in range(400):
        t = "".join(r.choice(["A ", "b", "É ", "\n", "\x1c", " c", "\xa0"]) for _ in range(r.randint(0, 25)))
        assert simhash.fingerprint(t.encode()) == brute_fingerprint(t), t


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("crowd", [64, 1])
@pytest.mark.parametrize("bits", [0, 1, 2, 3])
def test_all_links_are_found(spark, crowd, bits):
    r = random.Random(bits)
    values = {r.getrandbits(64) for _ in range(40)}
    for v in list(values):
        for _ in range(6):
            values.add(v ^ sum(1 << b for b in r.sample(range(64), r.randint(1, 4))))
    fps = [signed(v) for v in values]
    got = {(a, b) for a, b in simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long"), bits, crowd).collect()}
    want = {(a, b) for a in fps for b in fps if a < b and bin((a ^ b) & (1 << 64) - 1).count("1") <= bits}
    assert got == want


def test_components_of_long_paths(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 5), (2000, 2001), (2001, 2000), (7, 7)]
    got = dict(components.connected_components(spark.createDataFrame(edges, "u long, v long")).collect())
    assert got == {**{i: 0 for i in range(1, 201)}, 1000: 0, 2001: 2000}
    assert components.connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_near_duplicates_against_brute_force(make_docs):
    r = random.Random(8)
    base = [" ".join(f"w{r.randint(0, 500)}" for _ in range(400)) for _ in range(8)]
    rows = []
    for i in range(60):
        w = base[i % 8].split()
        if i % 3:
            w[r.randint(0, len(w) - 1)] = "changed"
        rows.append((i * 7 % 61, " ".join(w)))
    rows += [(200, None), (201, ""), (202, " \n"), (203, "one"), (204, "ONE"), (None, "one"), (205, base[0]), (205, base[1])]
    fp = {id(x): brute_fingerprint(x[1]) for x in rows}
    group = {v: v for v in fp.values()}

    def root(v):
        while group[v] != v:
            v = group[v]
        return v
    for a in set(fp.values()):
        for b in set(fp.values()):
            if bin(a ^ b).count("1") <= 2:
                group[root(a)] = root(b)
    least = defaultdict(list)
    for x in rows:
        least[root(fp[id(x)])].append(x[0])
    name = {k: min((d for d in v if d is not None), default=None) for k, v in least.items()}
    want = Counter((x[0], f"{fp[id(x)]:016x}", name[root(fp[id(x)])]) for x in rows)
    got = Counter(tuple(r) for r in simhash.near_duplicates(clash(make_docs(rows))).collect())
    assert got == want
    kept = simhash.near_dedup(clash(make_docs(rows)))
    assert kept.count() == len(name) and set(CLASHING) <= set(kept.columns)
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(name.values())


def test_fingerprints_of_an_empty_table(make_docs):
    assert simhash.near_duplicates(make_docs([])).count() == 0
    assert simhash.near_dedup(make_docs([])).count() == 0


# ---- packing ----------------------------------------------------------------

def packing_rows():
    r = random.Random(6)
    return [(i, " ".join(r.choice(["alpha", "beta", "é日", "x"]) for _ in range(r.randint(0, 40)))) for i in range(80)] \
        + [(100, None), (101, ""), (3, "again"), (None, "no id"), (102, "long text " * 900)]


@pytest.mark.parametrize("size", [16, 2048])
def test_pieces_and_windows_round_trip(make_docs, size):
    rows = packing_rows()
    coder = tokens.ByteIds(IDS, None)
    docs = clash(make_docs(rows)).coalesce(3)
    pieces = [r.asDict() for r in packing.pieces(docs, IDS, RANKS, 1, size).collect()]
    by = defaultdict(list)
    for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])):
        by[p["sequence_id"]].append(p)
    total = 0
    for s, (k, some) in enumerate(sorted(by.items())):
        assert k == s and [p["offset"] for p in some] == list(np.cumsum([0, *(p["length"] for p in some)]))[:-1]
        n = sum(p["length"] for p in some)
        assert n == size or k == len(by) - 1 and n <= size
        total += n
    ids = {(d, t): [*coder.ids(t or ""), 1] for d, t in rows}
    assert total == sum(len(ids[r]) for r in rows)
    want = Counter()
    for r in rows:
        want[r[0], len(ids[r])] += len(ids[r])
    got = Counter()
    for p in pieces:
        got[p["doc_id"], p["doc_tokens"]] += p["length"]
        assert any(zlib.crc32(np.array(v[p["start"]:p["start"] + p["length"]], "<u4").tobytes()) == p["ids_crc32"]
                   for (d, _), v in ids.items() if d == p["doc_id"])
    assert got == want
    # the windows hold the same ids in the same order
    windows = packing.sequences(docs, IDS, RANKS, 1, size).sort("sequence_id").collect()
    assert [w["sequence_id"] for w in windows] == list(range(len(by)))
    for w in windows:
        some = by[w["sequence_id"]]
        assert w["n_tokens"] == sum(p["length"] for p in some)
        for p in some:
            part = np.array(w["input_ids"][p["offset"]:p["offset"] + p["length"]], "<u4")
            assert zlib.crc32(part.tobytes()) == p["ids_crc32"]
        n = len(w["input_ids"])
        assert n == size or n & (n - 1) == 0


def test_packing_an_empty_table(make_docs):
    assert packing.pieces(make_docs([]), IDS, RANKS).count() == 0
    assert packing.sequences(make_docs([]), IDS, RANKS).count() == 0


# ---- sharding ---------------------------------------------------------------

def brute_jump(key, n):
    key &= (1 << 64) - 1
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) & (1 << 64) - 1
        j = int((b + 1) * (float(1 << 31) / ((key >> 33) + 1)))
    return b


@pytest.mark.parametrize("n", [1, 2, 16, 17, 100])
def test_jump_hash(spark, n):
    keys = [0, 1, -1, 2**63 - 1, -2**63, *range(2, 200), *(random.Random(n).getrandbits(62) for _ in range(200))]
    got = spark.createDataFrame([(k,) for k in keys], "k long").select("k", sharding.jump_hash(F.col("k"), n)).collect()
    assert all(s == brute_jump(k, n) for k, s in got)


def test_manifest(make_docs):
    rows = [(i, f"text é {i}") for i in range(500)] + [(None, "x"), (7, None), (7, None), (8, ""), (9, "text é 9")]
    got = sharding.shard_manifest(clash(make_docs(rows))).collect()
    assert len(got) == len(rows)
    slots = defaultdict(list)
    for g in sorted(got, key=lambda g: (g["shard"], g["slot"])):
        slots[g["shard"]].append(g["slot"])
        assert g["shard"] == brute_jump(g["doc_id"] or 0, 16) and g["grown_shard"] in (g["shard"], 16)
    assert all(s == list(range(len(s))) for s in slots.values())
    want = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows)
    assert Counter((g["doc_id"], g["size"], g["text_crc32"]) for g in got) == want
    assert sharding.shard_manifest(make_docs([])).count() == 0
    assert sharding.assign_shards(clash(make_docs(rows)), key="source").select("shard_").distinct().count() == 1

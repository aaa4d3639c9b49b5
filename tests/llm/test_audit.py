"""The filter audit against a plain count, in any order of the files, and when a batch runs twice."""

import random
import re
from itertools import permutations

import pytest
from pyspark.sql import types as T

from sylvan.llm import audit as A

from .conftest import DOCS, clash

LABELS = "doc_id long, quality int, toxic int"


def failures(text):
    w = re.findall("[^ \t-\r]+", text)
    return ("A" * (len(w) < 50) + "B" * (100 * len(set(w)) < 65 * len(w))
            + "C" * (100 * len(re.findall("[A-Z]", text)) > 5 * len(text)) + "D" * bool(re.search("[#$%&*|]", text)))


def plain(rows, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    least = {}
    for d, text, _ in rows:
        if d is not None:
            least[text or ""] = min(least.get(text or "", d), d)
    docs = [(s or "", failures(t or "") + "E" * (d is not None and d > least[t or ""]), d in good, d in toxic) for d, t, s in rows]
    out = []
    for part in {d[0] for d in docs}:
        mine, total, lines = [d for d in docs if d[0] == part], dict.fromkeys("ABCDE", 0), []
        for order in permutations("ABCDE"):
            left = mine
            for step, x in enumerate(order, 1):
                lost = [d for d in left if x in d[1]]
                left = [d for d in left if x not in d[1]]
                total[x] += len(lost)
                lines.append((x, part, "".join(order), step, len(left), len(lost), sum(x in d[1] for d in mine) - len(lost),
                              sum(d[1] == x for d in mine), sum(d[2] for d in lost), sum(d[3] for d in lost)))
        out += [(*line[1:], total[line[0]]) for line in lines]
    return sorted(out)


def table(spark, path, rows, parts, keep_order=False):
    df = spark.createDataFrame([(d, t, "en", s, 0) for d, t, s in rows], DOCS)
    df = df.coalesce(1) if parts == 1 else df.repartition(parts, "doc_id")
    clash(df).write.parquet(str(path))
    return str(path)


def make(seed):
    rnd = random.Random(seed)
    texts = ["", None, "A B", "w " * 60, " ".join(f"x{i}" for i in range(70)), " ".join(f"y{i}" for i in range(70)) + " #",
             " ".join(f"Z{i}" for i in range(60)), "LOUD " * 80, "é " * 55, "a b " * 30]
    rows = [(rnd.choice([i, i, None]), rnd.choice(texts), rnd.choice(["s1", "s2", "", None])) for i in rnd.sample(range(-50, 300), 150)]
    rows += rows[:5] + [(rows[7][0], rows[7][1], "other")]
    labels = [(d, rnd.choice([0, 1, None]), rnd.choice([0, 1])) for d, _, _ in rows if rnd.random() < .6] + [(None, 1, 1)]
    return rows, labels + labels[:4]


@pytest.mark.parametrize("parts, batches", [(1, 4), (6, 6), (9, 2)])
def test_equals_the_plain_count(spark, tmp_path, parts, batches):
    rows, labels = make(parts)
    got = A.audit(spark, table(spark, tmp_path / "documents.parquet", rows, parts), spark.createDataFrame(labels, LABELS), batches)
    assert [f.name for f in got.schema] == [f.name for f in A._OUT]
    assert sorted(map(tuple, got.collect())) == plain(rows, labels)


def test_later_files_with_smaller_ids_retract(spark, tmp_path):
    """Three batches, each with a smaller copy in another part, and one of them run twice."""
    labels = spark.createDataFrame([(5, 1, 0)], LABELS)
    batches = [[(9, "same", "p"), (8, "other", "p")], [(5, "same", "q"), (5, "same", "q")], [(7, "same", "p"), (2, "other", "r")]]
    home, rows = str(tmp_path), []
    for i, batch in enumerate(batches):
        rows += batch
        df = A.judged(spark.createDataFrame([(d, t, "en", s, 0) for d, t, s in batch], DOCS))
        for _ in range(2 if i == 1 else 1):
            A.retract(spark, df, labels, i, home)
        now = (spark.read.schema(A._CHANGES).parquet(f"{home}/changes/*").groupBy(*A._COUNTED).sum("n")
               .toDF(*A._COUNTED, "n").filter("n <> 0"))
        assert sorted(map(tuple, A.interactions(now).collect())) == plain(rows, [(5, 1, 0)])
    taken = spark.read.schema(A._CHANGES).parquet(f"{home}/changes/1").collect()
    assert any(r["n"] < 0 for r in taken)


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame([], DOCS).write.parquet(path)
    got = A.audit(spark, path, spark.createDataFrame([], LABELS))
    assert got.count() == 0 and got.schema["shapley"].dataType == T.LongType()


def test_a_very_long_text_and_no_labels(spark, tmp_path):
    rows = [(1, "word " * 500_000, "s"), (2, "word " * 500_000, "s")]
    got = A.audit(spark, table(spark, tmp_path / "documents.parquet", rows, 2), spark.createDataFrame([], LABELS))
    assert sorted(map(tuple, got.collect())) == plain(rows, [])

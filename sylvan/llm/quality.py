"""Quality rules with an isolation forest over their statistics (operator 2).

Words are runs of ``[^\\x20\\x09-\\x0D]``.  The base rule rejects texts of
fewer than ``min_words`` words, or whose words lie to more than
``max_repeat`` percent in three-word windows that occur twice or more.
All other texts are judged by a forest of random splits over rule
statistics: the path from the root to a text's leaf is short where few
accepted texts lie, and a short mean path means an anomaly.

The forest and its threshold are fitted on every labelled row that the base
rule passes; these rows stay distributed.  A tree grows on all accepted rows,
level by level: one pass over the rows counts the accepted ones of each open
node and finds the range of each statistic in it, the driver draws the splits.
All labelled rows set the range a split is drawn from, so that statistics
which accepted rows never vary in can still be split on; a statistic is picked
the more often the better it separates the labels (its exact AUC).  The
threshold is the largest score that keeps ``keep_share`` of all accepted rows
and separates best.  Every text is then scored whole, in one pass over the
table.  Draws are hashes of tree and node: the model does not depend on the
order or the partitions of the rows.

A null text has no words and fails the base rule.  Without labelled rows
of both kinds the base rule alone decides.  Repeated rows are judged alike.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, replace
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sylvan.functions.traverse import list_matrix
from sylvan.llm.common import columns, fresh, quoted, utf8

SYMBOLS = b"#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SPACE = b" \t\n\x0b\x0c\r"
_KEEP_UPPER = bytes(set(range(256)) - set(range(65, 91)))
_KEEP_DIGIT = bytes(set(range(256)) - set(range(48, 58)))
_KEEP_MARKS = bytes(set(range(256)) - set(b"!?;:\"'()[]{}=+/\\_~^@`"))
_CONTINUED = bytes(range(0x80, 0xC0))
#: Labelled rows of a partition, at most about.
ROWS_PER_PARTITION = 200_000
#: Numbers per row that :func:`features` gives.
N_FEATURES = 9


def rule_counts(text: bytes) -> tuple[int, int, int, int, int]:
    """The base statistics of one text, in the order of ``COUNTS``."""
    words = text.split()
    chars = len(text.translate(None, _SPACE + _CONTINUED))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [x for x in text.split(b"\n") if x.strip(_SPACE)]
    windows = list(zip(words, words[1:], words[2:]))
    often = Counter(windows) if len(set(windows)) < len(windows) else None
    repeated = 0
    if often:
        end = 0
        for i, w in enumerate(windows):
            if often[w] > 1:
                repeated += i + 3 - max(end, i)
                end = i + 3
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated


def features(text: bytes, counts: tuple[int, int, int, int, int]) -> list[float]:
    """What the forest looks at: shares, so that length says little."""
    n, chars, symbols, dup, rep = counts
    w, c, b = max(n, 1), max(chars, 1), max(len(text), 1)
    return [symbols / c, len(text.translate(None, _KEEP_UPPER)) / b, len(text.translate(None, _KEEP_DIGIT)) / b,
            len(text.translate(None, _KEEP_MARKS)) / b, chars / w, rep / w,
            dup / (text.count(b"\n") + 1), text.count(b".") / w, text.count(b",") / w]


@dataclass(frozen=True)
class Forest:
    """Trees as flat arrays: ``feature`` < 0 marks a leaf, ``cut`` then holds its path length."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    roots: np.ndarray
    depth: int
    scale: float
    threshold: float

    def places(self, x: np.ndarray):
        """Yield the rows' last nodes, tree by tree."""
        rows = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            for _ in range(self.depth):
                f = self.feature[at]
                go = f >= 0
                if not go.any():
                    break
                right = x[rows, np.maximum(f, 0)] >= self.cut[at]
                at = np.where(go, self.left[at] + right, at)
            yield at

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Anomaly score in 0 to 1 per row; larger is more anomalous."""
        total = np.zeros(len(x))
        for at in self.places(x):
            total += self.cut[at]
        return np.exp2(-total / len(self.roots) / self.scale)


def _mean_path(n: float) -> float:
    """Mean depth of an unsuccessful search among ``n`` points."""
    return 0.0 if n <= 1 else 1.0 if n == 2 else 2 * (log(n - 1) + 0.5772156649) - 2 * (n - 1) / n


def _parts(batches):
    """A partition's rows as one Arrow table (its counts are bounded by the range partitioning)."""
    got = [b for b in batches if b.num_rows]
    return pa.Table.from_batches(got) if got else None


def _counted(rows: DataFrame) -> DataFrame:
    """``f, v, good, bad``: rows per value of each statistic, in order over the partitions."""
    return (rows.groupBy("f", "v").agg(F.sum(F.col("good").cast("long")).alias("good"),
                                       F.sum((~F.col("good")).cast("long")).alias("bad"))
            .repartitionByRange("f", "v").sortWithinPartitions("f", "v"))


def _pieces(batches):
    """``(f, values, good, bad)`` of each statistic in a sorted partition."""
    t = _parts(batches)
    if t is None:
        return
    f, v, good, bad = (t.column(c).to_numpy() for c in ("f", "v", "good", "bad"))
    for k in np.unique(f):
        at = slice(*np.searchsorted(f, [k, k + 1]))
        yield int(k), v[at], good[at], bad[at]


def separation(rows: DataFrame) -> np.ndarray:
    """How often a random split should look at each statistic: the square of its rank
    separation (2 AUC - 1) of accepted and rejected rows, sum 1; exact, from all ``rows``."""
    def run(batches):
        for k, v, good, bad in _pieces(batches):
            twice = good * (2 * np.cumsum(bad) - bad)          # pairs won, ties half, both times two
            yield pa.RecordBatch.from_arrays(
                [pa.array([k], pa.int32()), pa.array([v[0]]), *(pa.array([int(c.sum())]) for c in (good, bad, twice))],
                ["f", "first", "good", "bad", "twice"])
    long = rows.select("good", F.posexplode("x").alias("f", "v"))
    found = (_counted(long).mapInArrow(run, "f int, first double, good long, bad long, twice long").collect())
    out = np.zeros(N_FEATURES)
    for f in range(N_FEATURES):
        won = below = n = 0
        for r in sorted((r for r in found if r["f"] == f), key=lambda r: r["first"]):
            won += r["twice"] + 2 * r["good"] * below
            below += r["bad"]
            n += r["good"]
        out[f] = (won / (n * below) - 1) ** 2
    return (out + 1e-6) / (out + 1e-6).sum()


def _node_ranges(rows: DataFrame, forest: Forest, slot: np.ndarray, slots: int) -> tuple[np.ndarray, ...]:
    """Per slot: accepted rows, and the least and largest value of each statistic among all ``rows``."""
    shared = rows.sparkSession.sparkContext.broadcast((forest, slot))

    def run(batches):
        trees, number = shared.value
        n, low, high = (np.zeros(slots, np.int64), np.full((slots, N_FEATURES), np.inf),
                        np.full((slots, N_FEATURES), -np.inf))
        for rb in batches:
            x = list_matrix(rb.column("x"), N_FEATURES, np.float64)
            good = rb.column("good").to_numpy(zero_copy_only=False).astype(np.int64)
            for at in trees.places(x):
                s = number[at]
                use = np.flatnonzero(s >= 0)
                if not len(use):
                    continue
                use = use[np.argsort(s[use], kind="stable")]
                first = np.flatnonzero(np.diff(s[use], prepend=-1))
                here, xs = s[use[first]], x[use]
                n[here] += np.add.reduceat(good[use], first)
                low[here] = np.minimum(low[here], np.minimum.reduceat(xs, first))
                high[here] = np.maximum(high[here], np.maximum.reduceat(xs, first))
        seen = np.flatnonzero(low[:, 0] < np.inf)
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen, pa.int32()), pa.array(n[seen]),
             *(pa.array(np.ascontiguousarray(m[seen, f])) for m in (low, high) for f in range(N_FEATURES))],
            ["slot", "n", *lows, *highs])
    lows, highs = ([f"{c}{f}" for f in range(N_FEATURES)] for c in ("low", "high"))
    doubles = ", ".join(f"{c} double" for c in lows + highs)
    got = (rows.mapInArrow(run, f"slot int, n long, {doubles}").groupBy("slot")
           .agg(F.sum("n").alias("n"), *(F.min(c).alias(c) for c in lows), *(F.max(c).alias(c) for c in highs))
           .toArrow())
    shared.destroy()
    n, low, high = np.zeros(slots, np.int64), np.zeros((slots, N_FEATURES)), np.zeros((slots, N_FEATURES))
    at = got["slot"].to_numpy()
    n[at] = got["n"].to_numpy()
    for f in range(N_FEATURES):
        low[at, f], high[at, f] = got[lows[f]].to_numpy(), got[highs[f]].to_numpy()
    return n, low, high


def grow_forest(rows: DataFrame, n_good: int, often: np.ndarray, trees: int = 100, depth: int = 10,
                seed: int = 7) -> Forest:
    """Random trees over all accepted ``rows``, split within the range of every row of a
    node; ``often``: the share of splits on each statistic."""
    feature, cut, left = [-1] * trees, [0.0] * trees, [0] * trees
    ids = [(t, 1) for t in range(trees)]                      # tree and heap id of each node
    open_ = list(range(trees))

    def forest(levels: int) -> Forest:
        return Forest(np.array(feature), np.array(cut), np.array(left), np.arange(trees), levels,
                      max(_mean_path(n_good), 1.0), 1.0)
    for d in range(depth + 1):
        if not open_:
            break
        slot = np.full(len(feature), -1)
        slot[open_] = np.arange(len(open_))
        n, low, high = _node_ranges(rows, forest(d), slot, len(open_))
        below = []
        for i, at in enumerate(open_):
            some = np.flatnonzero(high[i] > low[i])
            if n[i] <= 1 or d >= depth or not len(some):
                cut[at] = d + _mean_path(float(n[i]))
                continue
            tree, node = ids[at]
            rng = np.random.default_rng([seed, tree, node])
            f = int(rng.choice(some, p=often[some] / often[some].sum()))
            feature[at], cut[at], left[at] = f, float(rng.uniform(low[i, f], high[i, f])), len(feature)
            for k in (0, 1):
                below.append(len(feature))
                feature.append(-1), cut.append(0.0), left.append(0), ids.append((tree, 2 * node + k))
        open_ = below
    return forest(depth + 1)


def calibrate(rows: DataFrame, forest: Forest, n_good: int, n_bad: int, keep_share: float) -> Forest:
    """Place the threshold where accepted and rejected rows part best, keeping ``keep_share``
    of the accepted; exact, from the scores of all ``rows``."""
    shared = rows.sparkSession.sparkContext.broadcast(forest)

    @F.arrow_udf("double")
    def scored(x: pa.Array) -> pa.Array:
        return pa.array(shared.value.scores(list_matrix(x, N_FEATURES, np.float64)), pa.float64())

    def ends(batches):
        for _, v, good, bad in _pieces(batches):
            yield pa.RecordBatch.from_arrays([pa.array([v[0]]), pa.array([int(good.sum())]), pa.array([int(bad.sum())])],
                                             ["first", "good", "bad"])
    counted = _counted(rows.select("good", F.lit(0).alias("f"), scored("x").alias("v"))).persist(
        StorageLevel.MEMORY_AND_DISK)
    parts = sorted(counted.mapInArrow(ends, "first double, good long, bad long").collect())
    before, after, g, b = {}, {}, 0, 0
    for i, r in enumerate(parts):
        before[r["first"]] = (g, b)
        after[r["first"]] = parts[i + 1]["first"] if i + 1 < len(parts) else 1.0
        g, b = g + r["good"], b + r["bad"]

    def best(batches):
        for _, v, good, bad in _pieces(batches):
            g0, b0 = before[v[0]]
            kept, passed = g0 + np.cumsum(good), b0 + np.cumsum(bad)
            allowed = np.flatnonzero(kept / n_good >= keep_share)
            if len(allowed):
                gain = kept[allowed] / n_good + (1 - passed[allowed] / n_bad)
                j = allowed[np.argmax(gain)]
                upper = v[j + 1] if j + 1 < len(v) else after[v[0]]
                yield pa.RecordBatch.from_arrays([pa.array([float(c)]) for c in (gain.max(), v[j], upper)],
                                                 ["gain", "score", "upper"])
    found = counted.mapInArrow(best, "gain double, score double, upper double").collect()
    counted.unpersist()
    shared.destroy()
    top = min(found, key=lambda r: (-r["gain"], r["score"]))
    return replace(forest, threshold=(top["score"] + top["upper"]) / 2)


_STATS = "struct<" + ", ".join(f"{c}: long" for c in COUNTS) + ", score: double>"


def _statistics(forest: Forest | None):
    @F.arrow_udf(_STATS)
    def run(text: pa.Array) -> pa.Array:
        counts, rows = [], []
        for t in text.to_pylist():
            counts.append(rule_counts(t))
            rows.append(features(t, counts[-1]))
        score = forest.scores(np.array(rows)) if forest is not None and rows else np.zeros(len(rows))
        by = list(zip(*counts)) or [()] * len(COUNTS)
        return pa.StructArray.from_arrays([*(pa.array(c, pa.int64()) for c in by), pa.array(score)],
                                          [*COUNTS, "score"])
    return run


def base_fails(q: Column, min_words: int, max_repeat: int) -> Column:
    return ((q.getField("n_words") < min_words)
            | (100 * q.getField("n_repeat_words") > max_repeat * q.getField("n_words")))


def labelled_rows(docs: DataFrame, labels: DataFrame, min_words: int = 50, max_repeat: int = 50) -> DataFrame:
    """``good, x`` of every labelled row that the base rule passes."""
    marks = (labels.filter("doc_id is not null and quality is not null").groupBy("doc_id")
             .agg((F.min("quality") > 0).alias("good")))

    def stats(batches):
        for rb in batches:
            ids, got = [], []
            for i, t in zip(rb.column("id__").to_pylist(), rb.column("text").to_pylist()):
                c = rule_counts(t)
                if c[0] >= min_words and 100 * c[4] <= max_repeat * c[0]:
                    ids.append(i)
                    got.append(features(t, c))
            yield pa.RecordBatch.from_arrays([pa.array(ids, rb.schema.field("id__").type),
                                              pa.array(got, pa.list_(pa.float64()))], ["id__", "x"])
    key = docs.schema["doc_id"].dataType.simpleString()
    judged = (docs.filter("doc_id is not null").select(F.col("doc_id").alias("id__"), utf8(F.col("text")).alias("text"))
              .mapInArrow(stats, f"id__ {key}, x array<double>"))
    return judged.join(marks, F.col("id__") == F.col("doc_id")).select("good", "x")


def fit(docs: DataFrame, labels: DataFrame, keep_share: float = 0.995,
        min_words: int = 50, max_repeat: int = 50) -> Forest | None:
    """Forest and threshold from all labelled rows."""
    sc = docs.sparkSession.sparkContext
    found = labelled_rows(docs, labels, min_words, max_repeat).persist(StorageLevel.MEMORY_AND_DISK)
    n = found.groupBy("good").count().collect()
    n_good, n_bad = (sum(r["count"] for r in n if r["good"] == k) for k in (True, False))
    if not n_good or not n_bad:
        found.unpersist()
        return None
    parts = max(min(sc.defaultParallelism, ceil((n_good + n_bad) / 1000)), ceil((n_good + n_bad) / ROWS_PER_PARTITION))
    rows = found.repartition(parts).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        forest = grow_forest(rows, n_good, separation(rows))
        return calibrate(rows, forest, n_good, n_bad, keep_share)
    finally:
        rows.unpersist()
        found.unpersist()


def judge(docs: DataFrame, labels: DataFrame, min_words: int = 50, max_repeat: int = 50,
          keep_share: float = 0.995, out: str = "rules") -> DataFrame:
    """``docs`` plus a struct ``out``: the counts, score, base_failed and kept."""
    forest = fit(docs, labels, keep_share, min_words, max_repeat)
    (got,) = fresh(docs, "stats")
    limit = forest.threshold if forest is not None else 2.0
    q = quoted(got)
    marked = docs.withColumn(got, _statistics(forest)(utf8(quoted("text"))))
    failed = base_fails(q, min_words, max_repeat)
    return (marked.withColumn(got, F.struct(*(q.getField(c).alias(c) for c in (*COUNTS, "score")),
                                            failed.alias("base_failed"),
                                            (~failed & (q.getField("score") <= limit)).alias("kept")))
            .select(*columns(docs.columns), q.alias(out)))


def quality_filter(docs: DataFrame, labels: DataFrame, **limits) -> DataFrame:
    """The rows of ``docs`` that the rules and the forest keep."""
    (got,) = fresh(docs, "rules")
    return (judge(docs, labels, out=got, **limits).filter(quoted(got).getField("kept"))
            .select(*columns(docs.columns)))

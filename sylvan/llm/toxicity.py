"""Toxicity categories by a classifier chain (operator 6).

Categories are predicted one after the other; the linear model of each
sees the words of the text and the probabilities of all categories before
it.  In training these probabilities are out of fold: they come from models
that did not see the row, so a later link learns from errors like those it
will meet.  Prediction uses models of the whole sample.

Features are words, runs of marks and word beginnings (``PREFIXES``
characters), present or not; each model picks the ``picked`` that tell its category
best, by the chi-squared statistic over its training rows.  Training uses
a sample of about ``per_group`` labelled rows for each combination of
labels (a documented bound; all rows of a rarer combination).  Prediction
reads whole texts in one pass.

A null or empty text has no word and gets the models' base rates.  Rows
without a label are not trained on; a category with one value only is
predicted as that constant.  Without any labelled row (or document) the
chain gives every probability as 0.5 and no decision.  Repeated rows are
predicted alike.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import chain
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sylvan.llm.common import fresh, quoted

PREFIXES = (4, 5)
FOLDS = 5
_WORDS = re.compile(r"[^\W\d_]+|[^\w\s.,;:'\"()-]+")
_BEGINS = [itemgetter(slice(0, n)) for n in PREFIXES]


def words_of(text: str) -> tuple[set[str], set[str]]:
    """Distinct words and runs of marks, and the distinct beginnings of ``PREFIXES`` characters."""
    words = set(_WORDS.findall(text.lower()))
    return words, set(chain.from_iterable(map(b, words) for b in _BEGINS))


def tokens_of(text: str, among: tuple[set[str], set[str]] | None = None) -> set[str]:
    """Features of a text: words, and word beginnings marked by a dash; all, or those of a vocabulary."""
    words, begins = words_of(text)
    if among is not None:
        words, begins = words & among[0], begins & among[1]
    return words | {b + "-" for b in begins}


def vocabulary_of(links: Sequence["Link"]) -> tuple[set[str], set[str]]:
    names = set().union(*(link.features for link in links))
    return {n for n in names if n[-1] != "-"}, {n[:-1] for n in names if n[-1] == "-"}


@dataclass(frozen=True)
class Link:
    """One category's model: a weight for each picked feature and each earlier category."""

    features: dict[str, float]
    earlier: np.ndarray
    bias: float

    def logit(self, found: list[set[str]], before: np.ndarray) -> np.ndarray:
        get, names = self.features.__getitem__, self.features.keys()
        own = np.array([sum(map(get, names & t)) for t in found], float)
        return own + before @ self.earlier + self.bias


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Sample:
    """Training texts as numbered features; those of fewer than ``least`` rows are left out."""

    def __init__(self, found: pa.ListArray, least: int = 3):
        coded = found.flatten().dictionary_encode()
        ids = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        rows = np.repeat(np.arange(len(found)), found.value_lengths().to_numpy(zero_copy_only=False))
        often = np.bincount(ids, minlength=len(coded.dictionary)) >= least
        number = np.cumsum(often) - 1
        keep = often[ids]
        self.names = np.array(coded.dictionary.filter(pa.array(often)).to_pylist(), dtype=object)
        self.rows, self.ids, self.n = rows[keep], number[ids[keep]], len(found)

    def pick(self, y: np.ndarray, use: np.ndarray, k: int) -> np.ndarray:
        """Features with the largest chi-squared statistic on the rows in ``use``."""
        on = use[self.rows]
        with_, pos = (np.bincount(self.ids[on], w, len(self.names))
                      for w in (None, y[self.rows][on].astype(float)))
        n, p = use.sum(), y[use].sum()
        expected = with_ * p / max(n, 1)
        spread = np.maximum(with_ * (p / n) * (1 - p / n) * (1 - with_ / n), 1e-9)
        score = np.where(with_ > 0, (pos - expected) ** 2 / spread, 0.0)
        best = np.argsort(-score, kind="stable")[:k]
        return best[score[best] > 0]

    def matrix(self, picked: np.ndarray) -> np.ndarray:
        place = np.full(len(self.names), -1)
        place[picked] = np.arange(len(picked))
        at = place[self.ids]
        x = np.zeros((self.n, len(picked)))
        x[self.rows[at >= 0], at[at >= 0]] = 1.0
        return x


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 12) -> tuple[np.ndarray, float]:
    """Ridge logistic regression by Newton steps; weights and bias."""
    x = np.hstack([x, np.ones((len(x), 1))])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    beta = np.zeros(x.shape[1])
    beta[-1] = np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6))
    for _ in range(rounds):
        p = _sigmoid(x @ beta)
        h = (x * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(h, x.T @ (y - p) - penalty * beta)
        beta += step
        if np.abs(step).max() < 1e-5:
            break
    return beta[:-1], float(beta[-1])


def _link(sample: Sample, y: np.ndarray, use: np.ndarray, before: np.ndarray,
          picked: int) -> tuple[Link, np.ndarray]:
    """A category's model from the rows in ``use``, and its probabilities on all rows."""
    if not use.any() or y[use].min() == y[use].max():
        sure = 20.0 if use.any() and y[use].max() else -20.0
        return Link({}, np.zeros(before.shape[1]), sure), np.full(sample.n, float(_sigmoid(np.array(sure))))
    best = sample.pick(y, use, picked)
    x = np.hstack([sample.matrix(best), before])
    w, bias = logistic(x[use], y[use].astype(float))
    names = sample.names[best].tolist()
    return Link(dict(zip(names, w[:len(names)].tolist())), w[len(names):], bias), _sigmoid(x @ w + bias)


@dataclass(frozen=True)
class Chain:
    categories: list[str]
    links: list[Link]
    thresholds: list[float]

    def predict(self, found: list[set[str]]) -> np.ndarray:
        p = np.zeros((len(found), 0))
        for link in self.links:
            p = np.column_stack([p, _sigmoid(link.logit(found, p))])
        return p


def train_chain(found: pa.ListArray, labels: np.ndarray, fold: np.ndarray, categories: Sequence[str],
                picked: int = 200) -> Chain:
    """``found``: the features of each row; ``labels``: rows x categories of 0
    and 1, in chain order; ``fold``: fold number of each row."""
    sample = Sample(found)
    out_of_fold = np.zeros((sample.n, 0))
    links, cuts = [], []
    for j in range(len(categories)):
        y, held = labels[:, j], np.zeros(sample.n)
        for f in np.unique(fold):
            mine = fold == f
            held[mine] = _link(sample, y, ~mine, out_of_fold, picked)[1][mine]
        links.append(_link(sample, y, np.ones(len(y), bool), out_of_fold, picked)[0])
        cuts.append(_best_cut(held, y))
        out_of_fold = np.column_stack([out_of_fold, held])
    return Chain(list(categories), links, cuts)


def untaught(categories: Sequence[str]) -> Chain:
    """The chain of no labelled row."""
    return Chain(list(categories), [Link({}, np.zeros(j), 0.0) for j in range(len(categories))], [1.1] * len(categories))


def _best_cut(p: np.ndarray, y: np.ndarray) -> float:
    """The threshold of the best F1 on out-of-fold probabilities, in the middle of its gap."""
    if not y.any():
        return 1.1
    order = np.argsort(-p, kind="stable")
    hit = np.cumsum(y[order])
    f1 = 2 * hit / (np.arange(1, len(y) + 1) + y.sum())
    last = np.append(p[order][1:] < p[order][:-1], True)
    k = int(np.argmax(np.where(last, f1, -1)))
    below = p[order][k + 1] if k + 1 < len(p) else 0.0
    return float((p[order][k] + below) / 2)


def _tokens(text: pa.Array) -> pa.Array:
    return pa.array([sorted(tokens_of(t)) if t else [] for t in text.to_pylist()], pa.list_(pa.string()))


def fit(docs: DataFrame, labels: DataFrame, categories: Sequence[str], per_group: int = 1500,
        picked: int = 200) -> Chain:
    """A chain from ``docs(doc_id, text)`` and ``labels(doc_id, *categories)`` of 0 and 1."""
    labels = labels.dropna(subset=["doc_id", *categories]).groupBy("doc_id").agg(
        *(F.max(c).cast("int").alias(c) for c in categories))
    sizes = labels.groupBy(*categories).count().collect()       # at most 2^categories rows
    if not sizes:
        return untaught(categories)
    share = F.coalesce(*(F.when(F.expr(" and ".join(f"`{c}` = {r[c]}" for c in categories)),
                                F.lit(min(1.0, per_group / r["count"]))) for r in sizes))
    span = 1 << 32
    chosen = labels.filter(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(span)) < share * span)
    chosen = chosen.select(F.col("doc_id").alias("id__"), *(F.col(c).alias(f"y__{c}") for c in categories),
                           F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS)).alias("fold"))
    rows = (docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("id__"))
            .select("id__", "fold", *(f"y__{c}" for c in categories), F.arrow_udf(_tokens, "array<string>")("text").alias("t")).toArrow())
    if not rows.num_rows:
        return untaught(categories)
    rows = rows.sort_by("id__")                                   # the same model whatever the row order
    y = np.column_stack([rows[f"y__{c}"].to_numpy() for c in categories])
    return train_chain(rows["t"].combine_chunks(), y, rows["fold"].to_numpy(), categories, picked)


def classify(docs: DataFrame, model: Chain, out: str = "chain") -> DataFrame:
    """``docs`` plus a struct ``out``: for each category its probability ``p_*`` and decision ``is_*``."""
    (out,) = fresh(docs, out)
    kind = ", ".join(f"`p_{c}`: double, `is_{c}`: boolean" for c in model.categories)

    @F.arrow_udf(f"struct<{kind}>")
    def run(text: pa.Array) -> pa.Array:
        among = vocabulary_of(model.links)
        found = [tokens_of(t, among) if t else set() for t in text.to_pylist()]
        p = model.predict(found)
        cols, titles = [], []
        for j, c in enumerate(model.categories):
            cols += [pa.array(p[:, j]), pa.array(p[:, j] >= model.thresholds[j])]
            titles += [f"p_{c}", f"is_{c}"]
        return pa.StructArray.from_arrays(cols, titles)
    return docs.withColumn(out, run(quoted("text").cast("string")))

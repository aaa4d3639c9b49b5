"""Language identification in two steps (operator 4).

A softmax model over hashed byte n-grams (two and three bytes, lower case)
predicts the language family; within a family of several languages, linear
support vector machines, one for each pair, vote.  All models are trained
here, on a sample of at most about ``per_lang`` documents of each language
and ``SAMPLE`` in all (documented bounds; the sample is drawn by a hash of
doc_id and covers every document of a rare language); the ``LANGUAGES`` most
frequent values of lang can be learned.  Prediction reads whole texts and
nothing but the text.

A letter is a character of a Unicode letter category; numerals such as a
raised 2 or a Roman twelve are none.  A null text, or one without a letter, is ``und`` with score 0.  Documents
without a language are never learned from.  If nothing can be learned,
every text is ``und``.  Repeated rows are predicted alike.
"""

from __future__ import annotations

import re
from collections import defaultdict
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sylvan.llm.common import fresh, quoted

UND = "und"
DIMS = 1 << 12
_PIECE = 1 << 20
#: Training documents in all, and languages that can be learned.
SAMPLE = 6400
LANGUAGES = 400
_MAYBE_LETTER = re.compile(r"[^\W\d_]")

#: Language families by ISO 639-1 code; other codes form one family of their own.
FAMILIES = {
    "germanic": "en de nl af sv da no nb nn is fy lb yi",
    "romance": "fr es pt it ro ca gl oc",
    "slavic": "ru uk be bg mk sr hr bs sl cs sk pl",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz ky tk tt",
    "indic": "hi ur bn mr gu pa ne",
    "semitic": "ar he fa",
    "sinitic": "zh ja ko",
}
_FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes.split()}


def has_letter(text: str) -> bool:
    """Whether a character is of a letter category (word characters also hold raised and Roman numerals)."""
    return any(m.group().isalpha() for m in _MAYBE_LETTER.finditer(text))


def family(lang: str) -> str:
    return _FAMILY.get(lang.lower().split("-")[0], "other")


def vector(text: str) -> np.ndarray:
    """Square roots of hashed n-gram counts, scaled to length 1."""
    counts = np.zeros(DIMS)
    for i in range(0, len(text), _PIECE):                # long texts in pieces: bounded memory
        a = np.frombuffer(b" " + text[i:i + _PIECE].lower().encode("utf-8", "replace") + b" ",
                          np.uint8).astype(np.uint32)
        two = a[:-1] * np.uint32(257) + a[1:]
        three = two[:-1] * np.uint32(263) + a[2:]
        for h in (two * np.uint32(2654435761), three * np.uint32(2246822519)):
            counts += np.bincount(h >> np.uint32(20), minlength=DIMS)
    root = np.sqrt(counts)
    return (root / max(np.sqrt(counts.sum()), 1.0)).astype(np.float32)


@dataclass(frozen=True)
class Model:
    families: list[str]
    weights: np.ndarray                                   # DIMS + 1 x families
    members: list[list[str]]
    pairs: dict[int, tuple[np.ndarray, list[tuple[int, int]]]]   # family -> (DIMS + 1 x pairs, pairs)

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        x = np.hstack([x, np.ones((len(x), 1), np.float32)])
        z = x @ self.weights
        z = np.exp(z - z.max(axis=1, keepdims=True))
        p = z / z.sum(axis=1, keepdims=True)
        best = p.argmax(axis=1)
        langs, score = [""] * len(x), p[np.arange(len(x)), best]
        for f, members in enumerate(self.members):
            rows = np.flatnonzero(best == f)
            if not len(rows):
                continue
            share = np.ones((len(rows), 1))
            if f in self.pairs:
                w, pairs = self.pairs[f]
                margin = x[rows] @ w
                sure = 1 / (1 + np.exp(-np.clip(3 * margin, -30, 30)))
                share = np.zeros((len(rows), len(members)))
                for k, (a, b) in enumerate(pairs):         # a vote each, ties settled by the margins
                    share[:, a] += (margin[:, k] > 0) + 1e-3 * sure[:, k]
                    share[:, b] += (margin[:, k] <= 0) + 1e-3 * (1 - sure[:, k])
                pick = share.argmax(axis=1)
                belief = np.ones(len(rows))
                for k, (a, b) in enumerate(pairs):
                    belief = np.where(pick == a, belief * sure[:, k],
                                      np.where(pick == b, belief * (1 - sure[:, k]), belief))
                score[rows] *= belief
            else:
                pick = share.argmax(axis=1)
            for r, k in zip(rows, pick):
                langs[r] = members[k]
        return langs, np.clip(score, 0.0, 1.0)


def softmax_fit(x: np.ndarray, y: np.ndarray, k: int, rounds: int = 150, rate: float = 8.0) -> np.ndarray:
    w = np.zeros((x.shape[1], k), np.float32)
    speed = np.zeros_like(w)
    one = np.eye(k, dtype=np.float32)[y]
    share = 1 / np.maximum(np.bincount(y, minlength=k), 1)[y]     # families weigh alike
    share = (share / share.sum()).astype(np.float32)[:, None]
    for _ in range(rounds):
        z = x @ w
        z = np.exp(z - z.max(axis=1, keepdims=True))
        g = x.T @ (share * (z / z.sum(axis=1, keepdims=True) - one)) + 1e-5 * w
        speed = 0.9 * speed - rate * g
        w = w + speed
    return w


def svm_fit(x: np.ndarray, y: np.ndarray, c: float = 1.0, epochs: int = 12, seed: int = 3) -> np.ndarray:
    """Linear SVM with squared hinge loss, by dual coordinate descent; ``y`` is 1 or -1."""
    rng = np.random.default_rng(seed)
    cost = np.where(y > 0, c * len(y) / (2 * max((y > 0).sum(), 1)), c * len(y) / (2 * max((y < 0).sum(), 1)))
    alpha, w = np.zeros(len(y)), np.zeros(x.shape[1], np.float32)
    norm = (x * x).sum(axis=1) + 1 / (2 * cost)
    for _ in range(epochs):
        for i in rng.permutation(len(y)):
            g = y[i] * float(x[i] @ w) - 1 + alpha[i] / (2 * cost[i])
            new = max(alpha[i] - g / norm[i], 0.0)
            if new != alpha[i]:
                w += np.float32((new - alpha[i]) * y[i]) * x[i]
                alpha[i] = new
    return w


def _vectors(text: pa.Array) -> pa.Array:
    return pa.array([vector(t or "").tobytes() for t in text.to_pylist()], pa.binary())


def fit(train: DataFrame, per_lang: int = 800) -> Model | None:
    """Models from ``train(doc_id, text, lang)``; None without a language to learn."""
    train = train.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    often = train.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).collect()
    sizes = {r["lang"]: r["count"] for r in often}
    if not sizes:
        return None
    per_lang = min(per_lang, SAMPLE // len(sizes))
    share = F.coalesce(*(F.when(F.col("lang") == lang, F.lit(min(1.0, per_lang / n)))
                         for lang, n in sorted(sizes.items())))
    span = 1 << 32
    sample = train.filter(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(span)) < share * span)
    rows = sample.select("doc_id", "lang", F.arrow_udf(_vectors, "binary")("text").alias("x")).toArrow()
    if not rows.num_rows:
        return None
    x = np.frombuffer(b"".join(rows["x"].to_pylist()), np.float32).reshape(-1, DIMS)
    y = np.array(rows["lang"].to_pylist())
    order = np.lexsort((x[:, 0], np.array(rows["doc_id"].to_pylist(), dtype=object).astype(str), y))
    x, y = np.hstack([x[order], np.ones((len(x), 1), np.float32)]), y[order]
    members = defaultdict(list)
    for lang in sorted(set(y.tolist())):
        members[family(lang)].append(lang)
    names = sorted(members)
    group = np.array([names.index(family(v)) for v in y])
    pairs = {}
    for f, name in enumerate(names):
        some = list(combinations(range(len(members[name])), 2))
        if some:
            w = []
            for a, b in some:
                m = (y == members[name][a]) | (y == members[name][b])
                w.append(svm_fit(x[m], np.where(y[m] == members[name][a], 1, -1)))
            pairs[f] = (np.column_stack(w), some)
    return Model(names, softmax_fit(x, group, len(names)), [members[n] for n in names], pairs)


def predict(model: Model | None, col: Column) -> Column:
    """Struct of ``lang`` and ``score`` for a text column."""
    @F.arrow_udf("struct<lang: string, score: double>")
    def run(text: pa.Array) -> pa.Array:
        texts = text.to_pylist()
        langs, score = [UND] * len(texts), np.zeros(len(texts))
        known = [i for i, t in enumerate(texts) if t and model is not None and has_letter(t)]
        for a in range(0, len(known), 256):
            at = known[a:a + 256]
            got, s = model.predict(np.array([vector(texts[i]) for i in at]))
            for i, lang, v in zip(at, got, s):
                langs[i], score[i] = lang, v
        return pa.StructArray.from_arrays([pa.array(langs), pa.array(score)], ["lang", "score"])
    return run(col)


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """True for the documents kept from learning; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == 0


def identify(docs: DataFrame, per_lang: int = 800, folds: int = 5) -> DataFrame:
    """``docs`` plus held_out, lang_pred and score, learned from the documents not held out."""
    out, lang, score, got = fresh(docs, "held_out", "lang_pred", "score", "got")
    model = fit(docs.filter(~held_out(quoted("doc_id"), folds)).select("doc_id", "text", "lang"), per_lang)
    return (docs.withColumn(out, held_out(quoted("doc_id"), folds))
            .withColumn(got, predict(model, quoted("text").cast("string")))
            .withColumns({lang: quoted(got).getField("lang"), score: quoted(got).getField("score")}).drop(got))

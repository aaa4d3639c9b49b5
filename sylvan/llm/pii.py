"""Personal data by weak supervision (operator 1).

Base spans come from fixed patterns for four kinds (email, ip, card,
phone), leftmost and non-overlapping per kind; a match that fails its
check is dropped.  The method looks at wider candidates as well (obfuscated
addresses, numbers without a plus sign, cards of 13 to 15 digits or with
dots, IPv6).  Five labelers vote on every candidate: pattern, checksum,
gazetteer, context words and shape.  Expectation-maximisation over the
counts of vote patterns, which cover all candidates of all documents and
are bounded by the number of patterns, estimates each labeler's
reliability without labels.  A logistic span classifier is then trained on
the resulting posteriors; candidates at 0.5 or more become spans.  Base
spans always stay, and a candidate that overlaps one is not added.

Offsets are code points, ends exclusive.  A null text is an empty one.
Each text is read once: candidates are written to the shared folder, and
both the statistics and the result come from there.
"""

from __future__ import annotations

import hashlib
import re
from heapq import merge

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sylvan.llm.common import materialize, quoted

KINDS = ("email", "ip", "card", "phone")

# The patterns of the base spans (the first without its local part).
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Wider candidates.
_WIDE = (
    ("email", re.compile(r"(?<![\w.%+-])[\w%+-]{1,64}+(?:\.[\w%+-]{1,64}+)*+ ?(?:\(at\)|\[at\]|＠) ?"
                         r"[\w-]{1,63}(?: ?(?:\(dot\)|\[dot\]|\.) ?[A-Za-z0-9-]{2,63})+")),
    ("ip", re.compile(r"(?<![\w:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}(?![\w:])")),
    ("card", re.compile(r"(?<![\w.+-])[0-9]{4}[. -]?[0-9]{4,6}[. -]?[0-9]{4,6}(?:[. -]?[0-9]{2,4})?(?![\w-])")),
    ("phone", re.compile(r"(?<![\w.+-])(?:00[ .-]?[0-9]{1,3}[ .-])?(?:\([0-9]{2,4}\) ?|[0-9]{2,4}[ .-])"
                         r"[0-9]{3,4}[ .-][0-9]{3,4}(?![\w-])")),
)
_WIDE_MARK = re.compile(r"\(at\)|\[at\]|＠")

# Short gazetteers and context words.
_DOMAINS = frozenset("com org net edu gov io de fr es it uk eu info".split())
_CUES = {
    "email": re.compile(r"\b(?:e-?mail|mail|contact|write to|correo|courriel)\b", re.I),
    "ip": re.compile(r"\b(?:ip|host|server|address|from|login|adresse)\b", re.I),
    "card": re.compile(r"\b(?:card|visa|mastercard|amex|credit|payment|tarjeta|carte|karte)\b", re.I),
    "phone": re.compile(r"\b(?:phone|tel|telephone|call|mobile|fax|cell|anruf|telefon|telefono)\b", re.I),
}
_OTHER = re.compile(r"\b(?:version|license|licence|token|password|sha|uuid|isbn|issn|order|section|"
                    r"page|chapter|item|build|release|rev)\b", re.I)
_NEAR = 32


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping addresses, found from each ``@`` outwards."""
    out, pos, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > pos and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            out.append((start, m.end()))
            pos = m.end()
        at = text.find("@", max(at + 1, pos))
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The base spans by kind, then start."""
    out = [("email", a, b) for a, b in emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            d = _digits(m.group())
            if 16 <= len(d) <= 19 and luhn(d):
                out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_digits(m.group())) <= 15:
                out.append(("phone", *m.span()))
    return out


def wide_spans(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Further candidates that overlap neither a base span nor each other.

    Taken spans are disjoint and in order, as are a pattern's matches: one
    sweep per pattern tells them apart, one merge adds the new ones.
    """
    taken: list[tuple[int, int]] = []
    for span in sorted((a, b) for _, a, b in base):          # kinds may overlap: join them
        if taken and span[0] < taken[-1][1]:
            taken[-1] = (taken[-1][0], max(taken[-1][1], span[1]))
        else:
            taken.append(span)
    out = []
    for kind, pattern in _WIDE:
        if kind == "email" and not _WIDE_MARK.search(text):
            continue
        if kind == "ip" and ":" not in text:
            continue
        new, k = [], 0
        for m in pattern.finditer(text):
            a, b = m.span()
            while k < len(taken) and taken[k][1] <= a:
                k += 1
            if a < b and (k == len(taken) or b <= taken[k][0]):
                new.append((a, b))
        out += [(kind, a, b) for a, b in new]
        taken = list(merge(taken, new))
    return out


def votes(text: str, kind: str, a: int, b: int, base: bool) -> tuple[int, ...]:
    """Votes of the labelers: 1 for, 0 against, 2 abstains."""
    s = text[a:b]
    d = _digits(s)
    before, around = text[max(0, a - _NEAR):a], text[max(0, a - _NEAR):b + _NEAR]
    pattern = 1 if base else 2
    if kind == "email":
        check = 1 if re.search(r"[A-Za-z]{2,}$", s) else 0
        known = 1 if s.lower().rsplit(".", 1)[-1].rsplit(" ", 1)[-1] in _DOMAINS else 2
    elif kind == "ip":
        check = 1 if base or s.count(":") == 7 else 0
        known = 0 if s.startswith(("0.", "00")) else 2
    elif kind == "card":
        check = 1 if luhn(d) else 0
        known = 1 if d[:1] in "3456" and len(d) >= 13 else 0
    else:
        check = 1 if 8 <= len(d) <= 15 else 0
        known = 1 if s.startswith(("+", "00", "(")) else 2
    cue = _CUES[kind].search(before)
    context = 0 if _OTHER.search(before) and not cue else 1 if cue else 2
    left, right = text[a - 1:a], text[b:b + 1]
    shape = 0 if left.isalnum() or right.isalnum() else 1 if not around or len(s) > 6 else 2
    return pattern, check, known, context, shape


LABELERS = 5


def _code(kind: int, base: bool, v: tuple[int, ...]) -> int:
    """Kind, base flag and votes as one small number."""
    n = 2 * kind + base
    for x in v:
        n = 3 * n + x
    return n


def _decode(n: int) -> tuple[int, int, tuple[int, ...]]:
    v = []
    for _ in range(LABELERS):
        n, x = divmod(n, 3)
        v.append(x)
    return n // 2, n % 2, tuple(reversed(v))


_SPAN = "struct<kind: int, start: int, end: int, code: int>"
_FOUND = f"struct<n: array<long>, base_sha256: string, spans: array<{_SPAN}>>"


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _find(text: pa.Array) -> pa.Array:
    out = []
    for t in text.to_pylist():
        t = t or ""
        base = base_spans(t)
        rows = []
        for is_base, some in ((True, base), (False, wide_spans(t, base))):
            for kind, a, b in some:
                k = KINDS.index(kind)
                rows.append({"kind": k, "start": a, "end": b,
                             "code": _code(k, is_base, votes(t, kind, a, b, is_base))})
        out.append({"n": [sum(k == kind for k, _, _ in base) for kind in KINDS],
                    "base_sha256": hashlib.sha256(_joined(base).encode()).hexdigest(), "spans": rows})
    span = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("code", pa.int32())])
    return pa.array(out, pa.struct([("n", pa.list_(pa.int64())), ("base_sha256", pa.string()),
                                    ("spans", pa.list_(span))]))


def reliabilities(v: np.ndarray, weight: np.ndarray, rounds: int = 200) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of "personal data" per vote pattern, and P(vote | class) per labeler.

    ``v``: patterns x labelers with votes 0, 1, 2; ``weight``: how often
    each pattern occurs.  Starts from the majority of the votes cast.
    """
    cast = (v == 1).sum(1) - (v == 0).sum(1)
    p = 1 / (1 + np.exp(-1.5 * cast.astype(float)))
    table = np.zeros((2, v.shape[1], 3))
    for _ in range(rounds):
        prior = np.clip((weight * p).sum() / weight.sum(), 0.01, 0.99)
        for c, q in enumerate((weight * (1 - p), weight * p)):
            for j in range(v.shape[1]):
                n = np.bincount(v[:, j], q, 3) + np.array([1.0, 1.0, 1.0]) \
                    + (np.array([2.0, 0.0, 0.0]) if c == 0 else np.array([0.0, 2.0, 0.0]))
                table[c, j] = n / n.sum()
        like = np.log(table[:, np.arange(v.shape[1])[None, :], v]).sum(2)
        odds = np.log(prior) + like[1] - np.log1p(-prior) - like[0]
        new = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        if np.abs(new - p).max() < 1e-9:
            break
        p = new
    return new, table


def _design(codes: list[int]) -> np.ndarray:
    rows = []
    for c in codes:
        kind, _, v = _decode(c)
        row = [1.0] + [float(kind == k) for k in range(len(KINDS))]
        for x in v:
            row += [float(x == 0), float(x == 1)]
        rows.append(row)
    return np.array(rows)


def span_classifier(codes: list[int], weight: np.ndarray) -> dict[int, float]:
    """Probability per vote pattern from a logistic model of the EM posteriors."""
    if not codes:
        return {}
    v = np.array([_decode(c)[2] for c in codes])
    kinds = np.array([_decode(c)[0] for c in codes])
    target = np.zeros(len(codes))
    for k in np.unique(kinds):
        m = kinds == k
        target[m], _ = reliabilities(v[m], weight[m])
    x, w = _design(codes), weight / weight.sum()
    beta = np.zeros(x.shape[1])
    for _ in range(30):                                   # Newton steps, ridge penalty
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        g = x.T @ (w * (target - p)) - 1e-4 * beta
        h = (x * (w * p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(len(beta))
        step = np.linalg.solve(h, g)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
    return dict(zip(codes, p.tolist()))


def find_spans(docs: DataFrame) -> DataFrame:
    """``doc_id, n`` (base counts by kind), ``base_sha256, spans`` (all, with kind, start, end).

    ``spans`` are ordered by kind as in ``KINDS``, then start.
    """
    found = materialize(docs.select("doc_id", F.arrow_udf(_find, _FOUND)(quoted("text").cast("string")).alias("f"))
                        .select("doc_id", "f.n", "f.base_sha256", "f.spans"))
    patterns = (found.select(F.explode("spans.code").alias("code")).groupBy("code").count()
                .orderBy("code").collect())       # at most 8 x 3^5 rows
    p = span_classifier([r["code"] for r in patterns], np.array([float(r["count"]) for r in patterns]))
    accepted = [c for c in p if _decode(c)[1] or p[c] >= 0.5]
    yes: Column = F.array(*(F.lit(c) for c in accepted)) if accepted else F.expr("cast(array() as array<int>)")
    return found.withColumn("spans", F.sort_array(F.transform(
        F.filter("spans", lambda s: F.array_contains(yes, s["code"])),
        lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))))


def span_digest(found: DataFrame) -> DataFrame:
    """The contract's columns of :func:`find_spans`."""
    names = F.array(*(F.lit(k) for k in KINDS))
    text = F.transform("spans", lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")))
    return found.select("doc_id", *(F.col("n")[i].alias(f"n_{k}") for i, k in enumerate(KINDS)),
                        "base_sha256", F.concat_ws(",", text).alias("spans"))

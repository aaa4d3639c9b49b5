"""A regression tree grown row by row in plain Python: the tests' restatement
of the learner's rules (hash-drawn subsets and thresholds, weighted sums,
midpoints, missing values to the right)."""

import hashlib
import math
from collections import defaultdict

TWO32 = 4294967296.0


def h8(*parts):
    return hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()[:8]


def uniform(*parts):
    return int(h8(*parts), 16) / TWO32


def subset(seed, tree, node, nf, m):
    return list(range(nf)) if m >= nf else sorted(
        sorted(range(nf), key=lambda f: (h8(seed, tree, node, f), f))[:m])


def poisson(h, top=12):
    cum, term = 0.0, math.exp(-1.0)
    for k in range(top):
        cum += term
        if h < format(int(cum * TWO32), "08x"):
            return k
        term /= k + 1
    return top


def missing(v):
    return v is None or math.isnan(v) or math.isinf(v)


def sse(rows):
    n = sum(w for _, w, _ in rows)
    mu = sum(w * y for _, w, y in rows) / n
    return sum(w * (y - mu) ** 2 for _, w, y in rows)


def grow(rows, nf, m, tree, seed, max_depth, mss=2, msl=1, splitter="best", draws=10, edges=None):
    """``rows``: (x, weight, y); returns {node: (feature, threshold, n)}, leaves with None."""
    out, todo = {}, [(1, 0, [r for r in rows if r[1] > 0])]
    while todo:
        node, depth, some = todo.pop()
        n = sum(r[1] for r in some)
        out[node] = (None, None, n)
        if depth >= max_depth or n < mss or n < 2 * msl or len({r[2] for r in some}) < 2:
            continue
        feats = subset(seed, tree, node, nf, m)
        cands = []
        if splitter == "best":
            for f in feats:
                if edges is not None:
                    bins = sorted({sum(e < r[0][f] for e in edges[f]) for r in some if not missing(r[0][f])})
                    cands += [(f, float(edges[f][b])) for b in bins[:-1]]
                    continue
                vals = sorted({r[0][f] for r in some if not missing(r[0][f])})
                for a, b in zip(vals, vals[1:]):
                    cands.append((f, (a + b) / 2 if (a + b) / 2 < b else a))
        else:
            salt = "r" if splitter == "random" else "x"
            for c in range(min(draws, len(feats)) if splitter == "random" else draws):
                f = feats[int(uniform(seed, salt + "f", tree, node, c) * len(feats))]
                vals = [r[0][f] for r in some if not missing(r[0][f])]
                if vals and max(vals) > min(vals):
                    cands.append((f, min(vals) + uniform(seed, salt + "t", tree, node, c) * (max(vals) - min(vals))))
        valid, whole = [], sse(some)
        for k, (f, t) in enumerate(cands):
            left = [r for r in some if not missing(r[0][f]) and r[0][f] <= t]
            right = [r for r in some if missing(r[0][f]) or r[0][f] > t]
            if sum(r[1] for r in left) >= msl and sum(r[1] for r in right) >= msl:
                valid.append(((sse(left) + sse(right)) / whole, k, f, t, left, right))
        least = min((v[0] for v in valid), default=0.0)
        best = min((v for v in valid if splitter == "extra" or v[0] <= least + 1e-11),
                   key=lambda v: (v[1],) if splitter == "extra" else (v[2], v[3]), default=None)
        best = best and best[1:]
        if best:
            out[node] = (best[1], best[2], n)
            todo += [(2 * node, depth + 1, best[3]), (2 * node + 1, depth + 1, best[4])]
    return out


def same(model_nodes, trees, close=1e-9):
    """Whether a node table holds exactly these trees."""
    by = defaultdict(dict)
    for r in model_nodes.itertuples():
        by[int(r.tree_id)][int(r.node_id)] = (None if r.is_leaf else int(r.feature),
                                             None if r.is_leaf else float(r.threshold), r.n)
    for t, want in trees.items():
        if set(by[t]) != set(want):
            return False
        for k, (f, cut, n) in want.items():
            f2, cut2, n2 = by[t][k]
            if f != f2 or n != n2 or f is not None and abs(cut - cut2) > close * max(1, abs(cut)):
                return False
    return True

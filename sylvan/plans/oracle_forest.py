"""A small bagged forest re-derived in plain DuckDB SQL.

The oracle grows the same forest as :func:`sylvan.operators.forest.fit_forest`
for a few levels, straight from the definition: weighted node sums, the
hash-chosen feature subset, every midpoint candidate with weighted
``min_samples_leaf`` checks (node totals include rows whose value is
missing: they go right), the SSE-ratio score, scores within 1e-11 of the
best tied and settled by (feature, threshold), heap node ids (root 1, children 2k, 2k+1).  Scoring,
importances, tree statistics, rules and out-of-bag scores are then
written over that node table.  It is a test oracle only.
"""

from __future__ import annotations

from sylvan.operators.levels import TIE
from sylvan.plans.sqlkit import h8, poisson, subset_sql, uni



def _xcase(n_features: int, fcol: str = "feature") -> str:
    whens = " ".join(f"when {i} then x{i}" for i in range(n_features))
    return f"(case {fcol} {whens} end)"


def _settle(d: int, order: str, by_score: bool = True) -> str:
    """The winner of each node: the first in ``order`` of the candidates tied for the best score."""
    tied = f"where rk <= least + {TIE!r}" if by_score else ""
    return (f"select tree_id, node_id, feature, threshold from (select *, row_number() over "
            f"(partition by tree_id, node_id order by {order}) as rn from (select *, min(rk) over "
            f"(partition by tree_id, node_id) as least from ca{d}) {tied}) where rn = 1")


def edge_ctes(nf: int, bins: int) -> list:
    """``ed``: the distinct quantile edges of every feature, numbered from 0
    (the value of rank ceil(i * n / bins) for i = 1 .. bins - 1);
    ``bx``: the bin of every value, the number of edges below it."""
    per = " union all ".join(
        f"select {f} as feature, v, row_number() over (order by v) as rn, count(*) over () as n "
        f"from (select x{f} as v from fx where x{f} is not null)" for f in range(nf))
    tall = " union all ".join(f"select row_key, {f} as feature, x{f} as v from fx where x{f} is not null"
                              for f in range(nf))
    return [
        f"rk as ({per})",
        f"ed as (select feature, v as e, row_number() over (partition by feature order by v) - 1 as b from "
        f"(select distinct feature, v from rk join range(1, {bins}) i on rk.rn = ceil(i.range / {bins}.0 * rk.n)))",
        f"bx as materialized (select t.row_key, t.feature, cast(count(ed.e) as double) as v from ({tall}) t "
        f"left join ed on ed.feature = t.feature and ed.e < t.v group by t.row_key, t.feature)",
    ]


def _binned_search(d: int, nf: int, min_leaf: int) -> list:
    """As :func:`_best_search` over bins; the threshold is the bin's upper edge."""
    ctes = _best_search(d, nf, min_leaf)
    ctes[0] = (f"lg{d} as (select r.tree_id, r.node_id, sb.feature, bx.v, r.w, r.dev as yc from r{d} r join sb{d} sb "
               f"on r.tree_id = sb.tree_id and r.node_id = sb.node_id "
               f"join bx on bx.row_key = r.row_key and bx.feature = sb.feature)")
    ctes[3] = ctes[3].replace("case when (v + nv) / 2 < nv then (v + nv) / 2 else v end as threshold",
                              "ed.e as threshold").replace(
        "st.q as tq from cu", "st.q as tq, cu.feature as cf from cu").replace(
        ") where nv is not null", ") c join ed on ed.feature = c.cf and ed.b = c.v where nv is not null").replace(
        "select tree_id, node_id, feature,", "select tree_id, node_id, c.feature,")
    return ctes


def _best_search(d: int, nf: int, min_leaf: int) -> list:
    """Exact search CTEs: every midpoint between consecutive distinct
    values, running sums per (tree, node, feature), node totals."""
    part = "partition by tree_id, node_id, feature"
    run = f"over ({part} order by v rows between unbounded preceding and current row)"
    return [
        f"lg{d} as (select * from (select r.tree_id, r.node_id, sb.feature, "
        f"{_xcase(nf, 'sb.feature')} as v, r.w, r.dev as yc from r{d} r join sb{d} sb "
        f"on r.tree_id = sb.tree_id and r.node_id = sb.node_id) where v is not null)",
        f"ag{d} as (select tree_id, node_id, feature, v, cast(sum(w) as double) as cw, "
        f"sum(w * yc) as cs, sum(w * yc * yc) as cq from lg{d} group by all)",
        f"cu{d} as (select tree_id, node_id, feature, v, lead(v) over ({part} order by v) as nv, "
        f"sum(cw) {run} as lw, sum(cs) {run} as ls, sum(cq) {run} as lq from ag{d})",
        f"ca{d} as (select tree_id, node_id, feature, "
        f"case when (v + nv) / 2 < nv then (v + nv) / 2 else v end as threshold, lw, "
        f"(case when {PARENT} > 0 then {CHILD} / {PARENT} else 0.0 end) as rk "
        f"from (select cu.*, st.n as tw, 0.0 as ts, st.q as tq from cu{d} cu join st{d} st "
        f"on cu.tree_id = st.tree_id and cu.node_id = st.node_id) "
        f"where nv is not null and lw >= {min_leaf} and tw - lw >= {min_leaf})",
        f"bs{d} as ({_settle(d, 'feature, threshold')})",
    ]


def _random_search(d: int, nf: int, min_leaf: int, seed, splitter: str, n_draws: int) -> list:
    """Candidate CTEs of the random / extra-random splitters: hash-drawn
    feature (with replacement from the node's sorted subset) and uniform
    threshold in the node's [min, max] of that feature."""
    salt = "r" if splitter == "random" else "x"
    uf = uni(h8(f"'{seed}'", f"'{salt}f'", "s.tree_id", "s.node_id", "c.range"))
    ut = uni(h8(f"'{seed}'", f"'{salt}t'", "s.tree_id", "s.node_id", "c.range"))
    cap = "where c.range < len(s.fs)" if splitter == "random" else ""
    order = "feature, threshold" if splitter == "random" else "cand, feature, threshold"
    xv = _xcase(nf, "c.feature")
    return [
        f"sl{d} as (select tree_id, node_id, list(feature order by feature) as fs from sb{d} group by all)",
        f"cd{d} as (select s.tree_id, s.node_id, cast(c.range as integer) as cand, "
        f"s.fs[cast(floor({uf} * len(s.fs)) as integer) + 1] as feature, {ut} as u "
        f"from sl{d} s cross join range({n_draws}) c {cap})",
        f"rg{d} as (select r.tree_id, r.node_id, sb.feature, min({_xcase(nf, 'sb.feature')}) as vmin, "
        f"max({_xcase(nf, 'sb.feature')}) as vmax from r{d} r join sb{d} sb "
        f"on r.tree_id = sb.tree_id and r.node_id = sb.node_id group by all)",
        f"ce{d} as (select cd.tree_id, cd.node_id, cd.cand, cd.feature, "
        f"rg.vmin + cd.u * (rg.vmax - rg.vmin) as threshold from cd{d} cd join rg{d} rg "
        f"on cd.tree_id = rg.tree_id and cd.node_id = rg.node_id and cd.feature = rg.feature "
        f"where rg.vmax > rg.vmin)",
        f"ev{d} as (select c.tree_id, c.node_id, c.cand, c.feature, c.threshold, "
        f"cast(sum(case when {xv} <= c.threshold then r.w else 0 end) as double) as lw, "
        f"sum(case when {xv} <= c.threshold then r.w * r.dev else 0.0 end) as ls, "
        f"sum(case when {xv} <= c.threshold then r.w * r.dev * r.dev else 0.0 end) as lq "
        f"from r{d} r join ce{d} c on r.tree_id = c.tree_id and r.node_id = c.node_id group by all)",
        f"ca{d} as (select *, (case when {PARENT} > 0 then {CHILD} / {PARENT} else 0.0 end) as rk "
        f"from (select e.*, st.n as tw, 0.0 as ts, st.q as tq from ev{d} e join st{d} st "
        f"on e.tree_id = st.tree_id and e.node_id = st.node_id) "
        f"where lw >= {min_leaf} and tw - lw >= {min_leaf})",
        f"bs{d} as ({_settle(d, order, splitter == 'random')})",
    ]


def _mean_search(d: int, nf: int, min_leaf: int) -> list:
    """The splitter of the query ``custom_splitter``: in each node the feature that
    correlates best with the target, cut at its mean (down to three decimals)."""
    exact = _best_search(d, nf, min_leaf)[0]
    return [
        exact,
        f"mo{d} as (select tree_id, node_id, feature, floor(sum(w * v) / sum(w) * 1000) / 1000 as threshold, "
        f"-power(sum(w * v * yc) - sum(w * v) * sum(w * yc) / sum(w), 2) / "
        f"(sum(w * v * v) - sum(w * v) * sum(w * v) / sum(w)) as rk from lg{d} group by all having min(v) < max(v))",
        f"ca{d} as (select * from mo{d})",
        f"be{d} as ({_settle(d, 'rk, feature', False)})",
        f"bs{d} as (select b.* from be{d} b join r{d} r using (tree_id, node_id) group by all "
        f"having sum(case when {_xcase(nf, 'b.feature')} <= b.threshold then r.w else 0 end) >= {min_leaf} "
        f"and sum(case when {_xcase(nf, 'b.feature')} <= b.threshold then 0 else r.w end) >= {min_leaf})",
    ]


CHILD = ("(greatest(lq - ls * ls / lw, 0.0) + "
         "greatest((tq - lq) - (ts - ls) * (ts - ls) / (tw - lw), 0.0))")
PARENT = "greatest(tq - ts * ts / tw, 0.0)"


def forest_ctes(feature_exprs: list, target_expr: str, source: str, n_trees: int, depth: int,
                min_split: int, min_leaf: int, m: int, seed, bootstrap: bool = True,
                splitter: str = "best", n_draws: int = 10, mask: str | None = None,
                bins: int | None = None) -> list:
    """CTE list ending in ``nodes`` (the node table) and ``fx`` (rows).

    ``mask``: optional SQL factor on the bag weight, over ``fx`` columns
    and the tree index ``t.range`` (cross-validation folds)."""
    nf = len(feature_exprs)
    xs = ", ".join(f"cast({e} as double) as x{i}" for i, e in enumerate(feature_exprs))
    w = poisson(h8("fx.row_key", f"'{seed}'", "t.range")) if bootstrap else "1"
    if mask:
        w = f"cast(({w}) * ({mask}) as integer)"
    ctes = [
        f"fx as (select row_key, {xs}, cast({target_expr} as double) as y from {source} "
        f"where {target_expr} is not null)",
        "g as (select avg(y) as mu from fx)",
        f"bag as (select * from (select fx.*, cast(t.range as integer) as tree_id, {w} as w, "
        f"fx.y - g.mu as yc from fx cross join range({n_trees}) t cross join g) where w > 0)",
        "p0 as (select tree_id, cast(1 as bigint) as node_id, * exclude (tree_id) from bag)",
    ]
    if bins:
        ctes += edge_ctes(nf, bins)
    node_parts = []
    for d in range(depth + 1):
        # every row's deviation from its node's mean
        ctes.append(f"r{d} as (select *, yc - sum(w * yc) over (partition by tree_id, node_id) / "
                    f"sum(w) over (partition by tree_id, node_id) as dev from p{d})")
        ctes.append(
            f"st{d} as (select tree_id, node_id, cast(sum(w) as double) as n, sum(w * yc) as s, "
            f"sum(w * dev * dev) as q, min(yc) = max(yc) as pure from r{d} group by tree_id, node_id)")
        mse = "q / n"
        if d == depth:
            ctes.append(
                f"nd{d} as (select st{d}.tree_id, node_id, {d} as depth, cast(null as integer) as feature, "
                f"cast(null as double) as threshold, cast(null as bigint) as left_id, "
                f"cast(null as bigint) as right_id, g.mu + s / n as value, n, "
                f"case when pure then 0.0 else {mse} end as mse, true as is_leaf "
                f"from st{d} cross join g)")
            node_parts.append(f"nd{d}")
            break
        ctes.append(
            f"ac{d} as (select st{d}.* from st{d} where n >= {min_split} "
            f"and n >= {2 * min_leaf} and not pure)")
        ctes.append(f"sb{d} as ({subset_sql(f'select tree_id, node_id from ac{d}', nf, m, seed)})")
        if splitter == "mean":
            ctes.extend(_mean_search(d, nf, min_leaf))
        elif splitter != "best":
            ctes.extend(_random_search(d, nf, min_leaf, seed, splitter, n_draws))
        else:
            ctes.extend((_binned_search if bins else _best_search)(d, nf, min_leaf))
        ctes.append(f"sp{d} as (select b.*, 2 * b.node_id as left_id from bs{d} b)")
        ctes.append(
            f"nd{d} as (select s.tree_id, s.node_id, {d} as depth, cast(p.feature as integer) as feature, "
            f"p.threshold, cast(p.left_id as bigint) as left_id, cast(p.left_id + 1 as bigint) as right_id, "
            f"g.mu + s.s / s.n as value, s.n, "
            f"case when s.pure then 0.0 else s.q / s.n end as mse, "
            f"p.feature is null as is_leaf "
            f"from st{d} s cross join g left join sp{d} p on s.tree_id = p.tree_id and s.node_id = p.node_id)")
        node_parts.append(f"nd{d}")
        ctes.append(
            f"p{d + 1} as (select r.tree_id, case when {_xcase(nf, 'p.feature')} <= p.threshold "
            f"then cast(p.left_id as bigint) else cast(p.left_id + 1 as bigint) end as node_id, "
            f"r.* exclude (tree_id, node_id, dev) from r{d} r join sp{d} p "
            f"on r.tree_id = p.tree_id and r.node_id = p.node_id)")
    # materialized: every later reference must see the one node table
    ctes.append("nodes as materialized (" + " union all ".join(f"select * from {p}" for p in node_parts) + ")")
    return ctes


def predict_ctes(source_rows: str, n_features: int, n_trees: int, depth: int,
                 prefix: str = "") -> list:
    """CTEs ending in ``{prefix}pt`` = (row_key, tree_id, p): per-tree
    predictions of every row of ``source_rows`` (columns row_key, x0..)
    for the first ``n_trees`` trees, walking at most ``depth`` levels (a
    node reached at that depth answers with its stored mean)."""
    q = f"{prefix}q"
    ctes = [f"{q}0 as (select s.*, cast(t.range as integer) as tree_id, cast(1 as bigint) as node_id "
            f"from ({source_rows}) s cross join range({n_trees}) t)"]
    for d in range(depth):
        ctes.append(
            f"{q}{d + 1} as (select q.* exclude (node_id), case when n.is_leaf then q.node_id "
            f"when {_xcase(n_features, 'n.feature')} <= n.threshold then n.left_id "
            f"else n.right_id end as node_id from {q}{d} q join nodes n "
            f"on q.tree_id = n.tree_id and q.node_id = n.node_id)")
    ctes.append(f"{prefix}pt as (select q.row_key, q.tree_id, n.value as p from {q}{depth} q join nodes n "
                f"on q.tree_id = n.tree_id and q.node_id = n.node_id)")
    return ctes


def importance_ctes(n_features: int) -> list:
    """T15/T16 over ``nodes``: ``fimp`` = (feature, importance)."""
    return [
        "gain as (select p.tree_id, p.feature, p.n * p.mse - (l.n * l.mse + r.n * r.mse) as gain "
        "from nodes p join nodes l on p.tree_id = l.tree_id and p.left_id = l.node_id "
        "join nodes r on p.tree_id = r.tree_id and p.right_id = r.node_id where not p.is_leaf)",
        f"tf as (select t.tree_id, cast(f.range as integer) as feature from "
        f"(select distinct tree_id from nodes) t cross join range({n_features}) f)",
        "raw as (select tf.tree_id, tf.feature, coalesce(sum(g.gain), 0.0) as raw from tf "
        "left join gain g on tf.tree_id = g.tree_id and tf.feature = g.feature group by all)",
        "timp as (select tree_id, feature, case when sum(raw) over (partition by tree_id) > 0 "
        "then raw / sum(raw) over (partition by tree_id) else raw end as importance from raw)",
        "fs as (select feature, sum(importance) as s from timp group by feature)",
        "fimp as (select feature, case when sum(s) over () > 0 then s / sum(s) over () "
        "else 0.0 end as importance from fs)",
    ]

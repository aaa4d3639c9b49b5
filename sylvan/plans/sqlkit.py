"""DuckDB SQL text shared by the oracles (``oracle_sql`` in the entry
module).  Nothing here runs on Spark; it states in plain SQL what each
registered Spark query must return."""

from __future__ import annotations

from sylvan.functions.hashing import (hex_threshold, sql_hash8, sql_normal,
                                      sql_poisson1_weight, sql_uniform)

# The housing-like frame, as given in FIXTURES.md (fixed text).
HOUSING_SQL = """
select o.o_orderkey as row_key,
  cast(-124 as double) + c.c_nationkey * cast(0.4 as double) as longitude,
  cast(32 as double) + (o.o_custkey % 1000) / cast(100 as double) as latitude,
  cast(1 + o.o_custkey % 52 as double) as housing_median_age,
  coalesce(l.q, 0) * 10 as total_rooms,
  case when o.o_orderkey % 97 = 0 then null else coalesce(l.b, 0) end as total_bedrooms,
  cast(coalesce(l.ln, 0) * 3 as double) as population,
  cast(coalesce(l.n, 0) as double) as households,
  o.o_totalprice / 50000 as median_income,
  o.o_orderpriority as ocean_proximity,
  20000 * o.o_totalprice / 50000 + 2000 * (1 + o.o_custkey % 52)
    + case when coalesce(l.n, 0) = 0 then 0 else 2000 * l.q / l.n end
    + ((o.o_orderkey * 7919) % 40001 - 20000) as median_house_value
from orders o
join customer c on o.o_custkey = c.c_custkey
left join (select l_orderkey, count(*) as n, sum(l_quantity) as q, sum(l_linenumber) as ln,
                  sum(l_quantity * (cast(1.5 as double) + 10 * l_discount)) as b
           from lineitem group by l_orderkey) l on l.l_orderkey = o.o_orderkey
"""

AVERAGES_SQL = """
select row_key, median_income as MedInc, housing_median_age as HouseAge,
  total_rooms / nullif(households, 0) as AveRooms,
  total_bedrooms / nullif(households, 0) as AveBedrms,
  population as Population,
  population / nullif(households, 0) as AveOccup,
  latitude as Latitude, longitude as Longitude,
  median_house_value as target
from h
"""

PRED_SQL = """
select row_key, median_house_value as y,
  median_house_value + ((row_key * 31) % 1001 - 500) * 10 as p
from h
"""


def with_frames(body: str, averages: bool = False, pred: bool = False, extra: str = "") -> str:
    ctes = [f"h as ({HOUSING_SQL})"]
    if averages:
        ctes.append(f"a as ({AVERAGES_SQL})")
    if pred:
        ctes.append(f"pf as ({PRED_SQL})")
    if extra:
        ctes.append(extra)
    return "with " + ",\n".join(ctes) + "\n" + body


def h8(*parts: str) -> str:
    return sql_hash8(*parts)


def uni(h: str) -> str:
    return sql_uniform(h)


def normal(h1: str, h2: str) -> str:
    return sql_normal(h1, h2)


def poisson(h: str) -> str:
    return sql_poisson1_weight(h)


def hexcut(p: float) -> str:
    return f"'{hex_threshold(p)}'"


def subset_sql(nodes: str, n_features: int, m: int, seed) -> str:
    """(tree_id, node_id, feature) of SP7 for the (tree_id, node_id) rows
    of ``nodes``: the m features with the smallest md5(seed|tree|node|f)."""
    hx = h8(f"'{seed}'", "n.tree_id", "n.node_id", "f.feature")
    return f"""select tree_id, node_id, feature from (
      select n.tree_id, n.node_id, f.feature,
             row_number() over (partition by n.tree_id, n.node_id order by {hx}, f.feature) as rk
      from ({nodes}) n cross join (select cast(range as integer) as feature from range({n_features})) f
    ) where rk <= {m}"""

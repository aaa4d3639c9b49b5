"""Distributed global positions and exact quantiles.

Positions are computed the way a distributed sort does it: range-partition
on (group, value, salt), sort inside partitions, count rows per
(partition, group) and turn those counts into offsets.

Exact quantiles need no sort of the data.  A sketch aggregation brackets
each quantile between two values whose ranks are certain to enclose it; a
second pass counts what lies below the bracket and, value by value, what
lies inside it -- about 6 / ``ACCURACY`` of the rows -- and only those few
values are put in order.  Nothing is written, nothing runs before an
action, and a hot value costs one row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sylvan.session import ensure_checkpoint_dir


def _n_partitions(df: DataFrame, partitions: int | None) -> int:
    if partitions:
        return partitions
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def with_global_position(df: DataFrame, order_cols, group_cols=(),
                         partitions: int | None = None,
                         broadcast_offsets: bool = True) -> DataFrame:
    """Add ``_pos`` (0-based rank in ascending order, restarting per group)
    and ``_gn`` (group size).

    ``broadcast_offsets``: the offsets table has at most
    ``partitions x groups`` rows; pass False when the group count is
    unbounded so AQE chooses the join.
    """
    g = list(group_cols)
    order_cols = list(order_cols)
    n = _n_partitions(df, partitions)
    keys = g + order_cols + ["_salt"]
    srt = (df.withColumn("_salt", F.monotonically_increasing_id())
             .repartitionByRange(n, *[F.col(k) for k in keys])
             .sortWithinPartitions(*keys))
    # The sorted partitions are read twice (counts, then positions).  Rows
    # arriving from shuffles have no fixed order, so a recomputation could
    # salt and split them differently: cut lineage with a reliable
    # checkpoint in the cluster's checkpoint folder so both reads agree.
    ensure_checkpoint_dir(df.sparkSession)
    srt = (srt.checkpoint(eager=True)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_mid", F.monotonically_increasing_id()))
    small = srt.groupBy("_pid", *g).agg(F.min("_mid").alias("_first"),
                                        F.count(F.lit(1)).alias("_cnt"))
    before = Window.partitionBy(*g).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*g)
    small = (small.withColumn("_off", F.coalesce(F.sum("_cnt").over(before), F.lit(0)))
                  .withColumn("_gn", F.sum("_cnt").over(whole)))
    small = F.broadcast(small) if broadcast_offsets else small
    out = srt.join(small, ["_pid", *g], "inner")
    return (out.withColumn("_pos", F.col("_off") + F.col("_mid") - F.col("_first"))
               .drop("_salt", "_mid", "_first", "_cnt", "_off", "_pid"))


#: Rank accuracy of the bracketing sketch; groups of at most as many rows are
#: bracketed by their smallest and largest value.
ACCURACY = 50_000


#: The same for medians of several columns, whose sketches are all merged at once.
MEDIAN_ACCURACY = 10_000


def _brackets(v, probs, accuracy: int = ACCURACY) -> list:
    """Aggregates of one column: its size, extremes and bracket values."""
    around = [min(max(p + d / accuracy, 0.0), 1.0) for p in probs for d in (-3, 3)]
    return [F.count(v), F.min(v), F.max(v), F.percentile_approx(v, around, accuracy)]


def _inside(v, n, low, high, marks, i: int):
    """The row's part in quantile ``i``: null where it lies above the bracket,
    else a struct of the quantile's number and the value (null: below)."""
    lo = F.when(n <= ACCURACY, low).otherwise(marks[2 * i])
    hi = F.when(n <= ACCURACY, high).otherwise(marks[2 * i + 1])
    return F.when(v <= hi, F.struct(F.lit(i).alias("_i"), F.when(v >= lo, v).alias("_x")))


def _picked(counted: DataFrame, keys: list, probs) -> DataFrame:
    """Values at the two ranks around each quantile, and the weight of the upper one.

    ``counted``: (keys, _n, _i, _x, _c), how often each bracket value occurs.
    """
    by = Window.partitionBy(*keys, "_i").orderBy(F.col("_x").asc_nulls_first())
    upto = F.sum("_c").over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    pos = F.element_at(F.array(*(F.lit(float(p)) for p in probs)), F.col("_i") + 1) * (F.col("_n") - 1)
    c = counted.withColumn("_upto", upto).withColumn("_pos", pos)
    holds = lambda k: (F.col("_upto") > k) & (F.col("_upto") - F.col("_c") <= k)
    return c.groupBy(*keys, "_i").agg(
        F.max(F.when(holds(F.floor("_pos")), F.col("_x"))).alias("_lo"),
        F.max(F.when(holds(F.ceil("_pos")), F.col("_x"))).alias("_hi"),
        F.max(F.col("_pos") - F.floor("_pos")).alias("_f"))


def exact_percentiles(df: DataFrame, value: str, probs, group_cols=(), names=None) -> DataFrame:
    """Exact percentiles with linear interpolation (numpy's default,
    DuckDB ``quantile_cont``); NULL and NaN are missing.  One row per group
    (a null group is a group); without groups always one row."""
    g = list(group_cols)
    probs = list(probs)
    names = list(names or [f"p{int(round(p * 100))}" for p in probs])
    keys = [f"_g{i}" for i in range(len(g))]
    base = df.select(*(F.col(c).alias(k) for c, k in zip(g, keys)), F.col(value).cast("double").alias("_v"))
    base = base.where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    n, low, high, marks = _brackets(F.col("_v"), probs)
    sizes = base.groupBy(*(F.col(k).alias(f"{k}_") for k in keys)).agg(
        n.alias("_n"), low.alias("_low"), high.alias("_high"), marks.alias("_marks"))
    if keys:
        same = [F.col(k).eqNullSafe(F.col(f"{k}_")) for k in keys]
        both = base.join(sizes, reduce(lambda a, b: a & b, same))
    else:
        both = base.crossJoin(F.broadcast(sizes))        # one row
    parts = F.array_compact(F.array(*(_inside(F.col("_v"), F.col("_n"), F.col("_low"), F.col("_high"),
                                              F.col("_marks"), i) for i in range(len(probs)))))
    counted = (both.select(*keys, "_n", F.explode(parts).alias("_p"))
               .groupBy(*keys, "_n", "_p._i", "_p._x").agg(F.count(F.lit(1)).alias("_c")))
    got = _picked(counted, keys, probs)
    at = [F.max(F.when(F.col("_i") == i, F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_f"))).alias(nm)
          for i, nm in enumerate(names)]
    # the sketch's error bound makes every bracket hold its rank; a rank outside one must not pass for a missing value
    outside = F.max(F.col("_lo").isNull() | F.col("_hi").isNull())
    out = got.groupBy(*keys).agg(*(F.when(outside, F.raise_error(F.lit(
        "a quantile lies outside its sketch bracket"))).otherwise(a).alias(nm) for a, nm in zip(at, names)))
    return out.select(*(F.col(k).alias(c) for k, c in zip(keys, g)), *names)


def exact_median(df: DataFrame, value: str, group_cols=(), name="median") -> DataFrame:
    return exact_percentiles(df, value, [0.5], group_cols, [name])


def column_medians(df: DataFrame, cols, widen: bool = True) -> dict:
    """Exact medians of several numeric columns: one sketch pass for all
    brackets, one pass over the values inside them.  The result is one value
    per column (None where all are missing).  ``widen``: a bracket that does
    not hold its rank is replaced by the column's whole range (False: start
    with that)."""
    cols = list(cols)
    if not cols:
        return {}

    def clean(c):
        v = F.col(c).cast("double")
        return F.when(~F.isnan(v), v)
    # a line per column and row, so that each column's sketches are merged in a group of their own
    lines = df.select(F.explode(F.array(*(F.struct(F.lit(i).alias("_k"), clean(c).alias("_x"))
                                          for i, c in enumerate(cols)))).alias("_p")).select("_p.*")
    n, low, high, marks = _brackets(F.col("_x"), [0.5], MEDIAN_ACCURACY)
    sizes = [None] * len(cols)
    for r in lines.groupBy("_k").agg(n.alias("n"), low.alias("low"), high.alias("high"), marks.alias("marks")).collect():
        if r["n"]:
            whole = r["n"] <= MEDIAN_ACCURACY or not widen
            sizes[r["_k"]] = (r["n"], *((r["low"], r["high"]) if whole else r["marks"]))
    if not any(sizes):
        return dict.fromkeys(cols)
    # rows below a bracket and at its ends are counted, those between (few) are grouped by value
    ends, counts = [], []
    for i, c in enumerate(cols):
        if sizes[i]:
            n, lo, hi = sizes[i]
            v = clean(c)
            for x, at in ((None, v < lo), (lo, v == lo), (hi, v == hi))[:2 if lo == hi else 3]:
                ends.append((i, n, 0, x))
                counts.append(F.count(F.when(at, 1)))
    counted = df.agg(*(c.alias(f"_{j}") for j, c in enumerate(counts))).first()
    known = df.sparkSession.createDataFrame([(*end, c) for end, c in zip(ends, counted) if c],
                                            "_k int, _n long, _i int, _x double, _c long")

    def of(j, kind):
        return F.get(F.array(*(F.lit(s and s[j]).cast(kind) for s in sizes)), F.col("_k"))
    between = lines.where((F.col("_x") > of(1, "double")) & (F.col("_x") < of(2, "double")))
    counted = (between.select("_k", of(0, "long").alias("_n"), F.lit(0).alias("_i"), "_x").groupBy("_k", "_n", "_i", "_x")
               .agg(F.count(F.lit(1)).alias("_c")).unionByName(known))
    got, outside = {}, []
    for r in _picked(counted, ["_k"], [0.5]).collect():
        if r["_lo"] is None or r["_hi"] is None:
            outside.append(cols[r["_k"]])               # the bracket missed the rank: take the whole range
        else:
            got[r["_k"]] = r["_lo"] + (r["_hi"] - r["_lo"]) * r["_f"]
    if outside and widen:
        again = column_medians(df, outside, widen=False)
        return {c: again[c] if c in again else got.get(i) for i, c in enumerate(cols)}
    if outside:
        raise RuntimeError(f"no median found for {outside}")
    return {c: got.get(i) for i, c in enumerate(cols)}

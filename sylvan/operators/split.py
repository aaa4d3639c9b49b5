"""Splitting and sampling (SP1-SP7) with hash-derived randomness.

Membership is a pure function of (row key, seed): no ``randomSplit``
(whose result depends on partitioning), no shuffle, identical on every
re-execution after executor loss, and reproducible in DuckDB.
"""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sylvan.functions.hashing import hash8, hash_numbers, hex_threshold, poisson1_thresholds, poisson1_weight, uniform
from sylvan.functions.traverse import list_matrix, matrix_bytes, matrix_list


def split_hash(key: str, seed) -> F.Column:
    return hash8(key, F.lit(str(seed)))


def train_test_split(df: DataFrame, key: str = "row_key", test_size: float = 0.2,
                     seed=42, label: str = "split") -> DataFrame:
    """SP1: adds ``split`` in {'train', 'test'}; P(test) = test_size."""
    h = split_hash(key, seed)
    return df.withColumn(label, F.when(h < F.lit(hex_threshold(test_size)), F.lit("test"))
                                 .otherwise(F.lit("train")))


def three_way_split(df: DataFrame, key: str = "row_key", test_size: float = 0.15,
                    val_size: float = 0.176, seed=42, label: str = "split") -> DataFrame:
    """SP2: test first, then ``val_size`` of the remainder as validation."""
    h = split_hash(key, seed)
    t1 = hex_threshold(test_size)
    t2 = hex_threshold(test_size + (1.0 - test_size) * val_size)
    return df.withColumn(label, F.when(h < F.lit(t1), F.lit("test"))
                                 .when(h < F.lit(t2), F.lit("val")).otherwise(F.lit("train")))


def kfold(df: DataFrame, key: str = "row_key", k: int = 5, seed=42, label: str = "fold") -> DataFrame:
    """SP3: fold id in [0, k) from the hash; each row validates once."""
    if k < 2:
        raise ValueError("k must be >= 2")
    u = uniform(split_hash(key, seed))
    return df.withColumn(label, F.least(F.floor(u * k), F.lit(k - 1)).cast("int"))


# ---- exact sizes ---------------------------------------------------------------
#
# Rows are ordered by (hash, key).  A part of exactly m rows is the rows up to
# the m-th of that order, which two counting passes find without a sort: counts
# by the hash's first four digits name the bracket, counts by whole hash inside
# the brackets name the hash, and only among rows of that very hash does the
# key decide.  The driver sees at most 65,536 counts a pass and a bracket.

_PREFIX = 4


def _cuts(df: DataFrame, key: str, seed, ranks_of) -> tuple[list[int], list[tuple | None]]:
    """``ranks_of(n)``: ascending ranks; for each the ``(hash, key)`` of the row
    of that rank (key ``...``: all rows of the hash; None for rank 0)."""
    h = split_hash(key, seed)
    rows = df.select(F.col(key).alias("k"), h.alias("h"))
    by_prefix = sorted((r["p"], r["n"]) for r in rows.groupBy(F.substring("h", 1, _PREFIX).alias("p"))
                       .agg(F.count(F.lit(1)).alias("n")).collect())
    ranks = ranks_of(sum(n for _, n in by_prefix))

    def place(counts: list, rank: int) -> tuple | None:
        """The entry that holds ``rank`` and the rank within it."""
        for value, n in counts:
            if rank <= n:
                return value, rank
            rank -= n
        return None

    found = [place(by_prefix, r) if r > 0 else None for r in ranks]
    needed = sorted({f[0] for f in found if f})
    by_hash: dict[str, list] = {}
    if needed:
        for r in (rows.where(F.substring("h", 1, _PREFIX).isin(needed)).groupBy("h")
                  .agg(F.count(F.lit(1)).alias("n")).collect()):
            by_hash.setdefault(r["h"][:_PREFIX], []).append((r["h"], r["n"]))
    cuts: list[tuple | None] = []
    for f in found:
        if f is None:
            cuts.append(None)
            continue
        here = sorted(by_hash[f[0]])
        value, rank = place(here, f[1])
        if rank == dict(here)[value]:
            cuts.append((value, ...))
        else:       # a tie of hashes: the key decides
            order = Window.partitionBy("h").orderBy(F.col("k").asc_nulls_first())
            tied = (rows.where(F.col("h") == value).withColumn("i", F.row_number().over(order))
                    .where(F.col("i") == rank).first())
            cuts.append((value, tied["k"]))
    return ranks, cuts


def _up_to(h, key: str, cut: tuple | None):
    """Whether a row comes no later than the cut in the order of (hash, key)."""
    if cut is None:
        return F.lit(False)
    value, k = cut
    if k is ...:
        return h <= F.lit(value)
    same = F.col(key).isNull() if k is None else F.col(key).isNull() | (F.col(key) <= F.lit(k))
    return (h < F.lit(value)) | ((h == F.lit(value)) & same)


def _labelled(df: DataFrame, key: str, seed, names: list, ranks_of, label: str) -> DataFrame:
    """``names[i]`` for the rows up to the i-th cut, the last name for the rest."""
    h = split_hash(key, seed)
    _, cuts = _cuts(df, key, seed, ranks_of)
    out = F.lit(names[-1])
    for name, cut in reversed(list(zip(names, cuts))):
        out = F.when(_up_to(h, key, cut), F.lit(name)).otherwise(out)
    return df.withColumn(label, out)


def exact_train_test_split(df: DataFrame, key: str = "row_key", test_size: float = 0.2,
                           seed=42, label: str = "split") -> DataFrame:
    """SP1 with exact sizes: the test part has ceil(test_size * n) rows.

    Sizes are exact and the same for any partitioning where keys are
    distinct; rows of equal key share a side."""
    return _labelled(df, key, seed, ["test", "train"], lambda n: [_part(test_size, n)], label)


def exact_three_way_split(df: DataFrame, key: str = "row_key", test_size: float = 0.15,
                          val_size: float = 0.176, seed=42, label: str = "split") -> DataFrame:
    """SP2 with exact sizes: ceil(test_size * n) test rows, then
    ceil(val_size * rest) validation rows."""
    def ranks(n: int) -> list[int]:
        test = _part(test_size, n)
        return [test, test + _part(val_size, n - test)]
    return _labelled(df, key, seed, ["test", "val", "train"], ranks, label)


def exact_kfold(df: DataFrame, key: str = "row_key", k: int = 5, seed=42, label: str = "fold") -> DataFrame:
    """SP3 with exact sizes: n // k rows a fold, one more in the first n % k."""
    if k < 2:
        raise ValueError("k must be >= 2")
    return _labelled(df, key, seed, list(range(k)),
                     lambda n: [(i + 1) * (n // k) + min(i + 1, n % k) for i in range(k - 1)], label)


def _part(share: float, n: int) -> int:
    """ceil(share * n) of the share as written (0.1 of 30 rows are 3, not 4)."""
    return math.ceil(Fraction(str(share)) * n)


def tree_seed(seed, tree_id) -> str:
    return f"{seed}:{tree_id}"


def bag_weight(key: str, seed, tree_col: str = "tree_id") -> F.Column:
    """SP4 weight for (row, tree): Poisson(1) multiplicity of the row in
    the tree's bootstrap sample."""
    return poisson1_weight(hash8(key, F.lit(str(seed)), tree_col))


def bag_weight_array(key: str, seed, n_trees: int, bootstrap: bool = True, tree_mask=None,
                     packed: bool = False) -> F.Column:
    """ARRAY<TINYINT> of per-tree bag weights for a row (SP4 for all trees).

    The values are those of :func:`bootstrap_weights`; an Arrow function hashes
    the keys of a batch together, for Spark's ``md5`` takes
    several times as long.  ``packed``: drawn weights as one binary value of a
    byte per tree, for Arrow functions.  ``tree_mask(tree Column) -> Column`` multiplies the
    weight per tree.
    """
    trees = [F.lit(t) for t in range(n_trees)]
    if not bootstrap:
        return F.array(*[(F.lit(1) if tree_mask is None else tree_mask(t)).cast("tinyint") for t in trees])
    cuts = np.array([int(c, 16) for c in poisson1_thresholds()], np.uint32)
    ends = [f"|{t}".encode() for t in range(n_trees)]

    def drawn(start: pa.Array) -> np.ndarray:
        hashes = hash_numbers(start, ends)
        w = np.zeros(hashes.shape, np.int8)
        for cut in cuts:
            w += hashes >= cut
        return np.ascontiguousarray(w.T)

    kind = "binary" if packed else "array<tinyint>"

    def column(w: np.ndarray) -> pa.Array:
        return matrix_bytes(w) if packed else matrix_list(w, pa.int8())

    @F.arrow_udf(kind)
    def bag(start: pa.Array) -> pa.Array:
        return column(drawn(start))

    @F.arrow_udf(kind)
    def masked_bag(start: pa.Array, mask: pa.Array) -> pa.Array:
        return column(drawn(start) * list_matrix(mask, n_trees, np.int8))
    start = F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed)))
    if tree_mask is None:
        return bag(start)
    return masked_bag(start, F.array(*[tree_mask(t).cast("tinyint") for t in trees]))


def bootstrap_weights(df: DataFrame, n_trees: int, key: str = "row_key", seed=42,
                      bootstrap: bool = True) -> DataFrame:
    """SP4 / SP6: one row per (row, tree) with weight ``w``; ``bootstrap``
    False gives w = 1 everywhere (empty out-of-bag sets)."""
    d = df.withColumn("tree_id", F.explode(F.sequence(F.lit(0), F.lit(n_trees - 1))))
    w = bag_weight(key, seed) if bootstrap else F.lit(1)
    return d.withColumn("w", w)


_DRAW_DIGITS = 13


def exact_bootstrap_weights(df: DataFrame, n_trees: int, key: str = "row_key", seed=42) -> DataFrame:
    """SP4 with exactly n draws of n rows a tree: one row per (row, tree) with weight ``w``.

    Rows are numbered in the order of (hash, key), in 65,536 ranges of the
    hash; draw j of a tree takes the row whose number is the hash of (seed,
    tree, j) scaled to n.  Draws are counted per row before they are joined
    on, so a row meets one record however often it was drawn.  The weights of
    a tree add up to n.  Rows of equal key are drawn apart; which of them is
    numbered first is open.  An empty frame gives no row.
    """
    spark, n = df.sparkSession, df.count()
    b, h, rank = "__range", "__hash", "__rank"
    rows = df.withColumn(h, split_hash(key, seed)).withColumn(b, F.substring(h, 1, _PREFIX))
    # numbers before each range: a table of at most 16 ** _PREFIX rows
    before = rows.groupBy(b).agg(F.count(F.lit(1)).alias("__n")).select(
        b, (F.sum("__n").over(Window.orderBy(b)) - F.col("__n")).alias("__before"))
    inside = F.row_number().over(Window.partitionBy(b).orderBy(h, F.col(key).asc_nulls_first()))
    ranked = (rows.withColumn(rank, inside).join(F.broadcast(before), b)
              .withColumn(rank, F.col("__before") + F.col(rank) - 1).drop(b, h, "__before"))
    digits = F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit("draw"), "__tree", "id")), 1, _DRAW_DIGITS)
    share = F.conv(digits, 16, 10).cast("bigint") / F.lit(2.0 ** (4 * _DRAW_DIGITS))
    drawn = (spark.range(n).withColumn("__tree", F.explode(F.sequence(F.lit(0), F.lit(n_trees - 1))))
             .select("__tree", F.floor(share * F.lit(float(n))).alias(rank))
             .groupBy(rank, "__tree").agg(F.count(F.lit(1)).cast("int").alias("__w"))
             .groupBy(rank).agg(F.map_from_entries(F.collect_list(F.struct("__tree", "__w"))).alias("__drawn")))
    return (ranked.join(drawn, rank, "left")
            .withColumn("tree_id", F.explode(F.sequence(F.lit(0), F.lit(n_trees - 1))))
            .withColumn("w", F.coalesce(F.try_element_at("__drawn", F.col("tree_id")), F.lit(0)))
            .drop(rank, "__drawn"))


def oob_rows(df: DataFrame, n_trees: int, key: str = "row_key", seed=42) -> DataFrame:
    """SP5: (row, tree) pairs left out of the tree's bootstrap sample."""
    return bootstrap_weights(df, n_trees, key, seed).where(F.col("w") == 0)


def resolve_max_features(max_features, n_features: int) -> int:
    """Number of features tried per node: int, float share, 'sqrt',
    'log2' or None (all); ``int()`` truncation with a minimum of 1."""
    if max_features is None:
        return n_features
    if isinstance(max_features, bool):
        raise ValueError(f"cannot read max_features={max_features!r} as a count, a share or a rule")
    if isinstance(max_features, int):
        return min(max_features, n_features)
    if isinstance(max_features, float):
        return max(1, int(max_features * n_features))
    if max_features == "sqrt":
        return max(1, int(math.sqrt(n_features)))
    if max_features == "log2":
        return max(1, int(math.log2(n_features)))
    raise ValueError(f"cannot read max_features={max_features!r} as a count, a share or a rule")


def feature_subset_expr(seed, tree: F.Column, node: F.Column, n_features: int, m: int) -> F.Column:
    """SP7 as an expression: the m features with the smallest
    md5(seed|tree|node|feature), ties by feature id, sorted ascending."""
    if m >= n_features:
        return F.sequence(F.lit(0), F.lit(n_features - 1))
    ranked = F.array_sort(F.transform(
        F.sequence(F.lit(0), F.lit(n_features - 1)),
        lambda f: F.struct(hash8(F.lit(str(seed)), tree, node, f).alias("h"), f.alias("f"))))
    return F.array_sort(F.transform(F.slice(ranked, 1, m), lambda s: s["f"]))


def feature_subsets(nodes: DataFrame, n_features: int, m: int, seed=42) -> DataFrame:
    """SP7: (tree_id, node_id) -> ``features`` array of chosen feature ids."""
    return nodes.withColumn("features", feature_subset_expr(
        seed, F.col("tree_id"), F.col("node_id"), n_features, m))

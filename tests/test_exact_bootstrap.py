"""Bootstrap of exactly n draws, against plain code."""

import hashlib
from collections import Counter

from sylvan.operators import split as SP


def plain(keys, n_trees, seed):
    def h(*parts):
        return hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()
    order = sorted(keys, key=lambda k: (h(k, seed)[:8], k))
    out = {(k, t): 0 for k in keys for t in range(n_trees)}
    for t in range(n_trees):
        for j in range(len(keys)):
            out[order[int(int(h(seed, "draw", t, j)[:13], 16) / 2.0 ** 52 * len(keys))], t] += 1
    return out


def test_weights_equal_plain_code_for_any_partitioning(spark):
    keys = [k * 3 for k in range(700)]
    df = spark.createDataFrame([(k, "x") for k in keys], "row_key long, extra string")
    for parts in (1, 6):
        got = SP.exact_bootstrap_weights(df.repartition(parts), 3, seed=9).toPandas()
        assert set(got.columns) == {"row_key", "extra", "tree_id", "w"}
        assert {(r.row_key, r.tree_id): r.w for r in got.itertuples()} == plain(keys, 3, 9)
        assert (got.groupby("tree_id").w.sum() == len(keys)).all()


def test_edges(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,), (2,)], "row_key long")
    got = SP.exact_bootstrap_weights(df, 4).toPandas()
    assert len(got) == 20 and Counter(got.groupby("tree_id").w.sum()) == {5: 4}
    assert SP.exact_bootstrap_weights(df.where("row_key > 5"), 4).count() == 0
    assert SP.exact_bootstrap_weights(df.limit(1), 2).toPandas().w.tolist() == [1, 1]

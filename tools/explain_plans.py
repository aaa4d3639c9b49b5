"""Print the physical plans of the main jobs and a one-line summary each.

    python tools/explain_plans.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import contextlib
import io
import re
import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from pyspark.sql import functions as F  # noqa: E402

from sylvan.operators import levels  # noqa: E402
from sylvan.operators.forest import _Trees, subset_for  # noqa: E402
from sylvan.operators import clean, metrics as M, scale as C, split as SP  # noqa: E402
from sylvan.operators import score as SC  # noqa: E402
from sylvan.operators.forest import ForestParams, fit_forest  # noqa: E402
from sylvan.session import build_session  # noqa: E402
from sylvan.sources import housing as H  # noqa: E402


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def summary(text: str) -> str:
    head = text.split("\n\n(1)")[0]
    ex = len(re.findall(r"(?<!Broadcast)Exchange\b", head))
    bex = len(re.findall(r"BroadcastExchange", head))
    scans = re.findall(r"ReadSchema: (struct<[^>]*>)", text)
    pushed = re.findall(r"PushedFilters: (\[[^\]]*\])", text)
    return (f"shuffle exchanges: {ex}, broadcast exchanges: {bex}, "
            f"scans: {len(scans)}; read schemas: {scans}; pushed filters: {pushed}")


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(shuffle_partitions=8)
    h = H.housing_totals(spark, sf)
    model = fit_forest(h, H.HOUSING_TOTALS, H.HOUSING_TARGET, ForestParams(n_trees=4, max_depth=3, seed=42))
    jobs = {
        "housing frame (orders x customer x lineitem aggregate)": h,
        "split search level (exact, one level, all trees)": None,
        "standard scaling (fit constants as literals)": C.StandardScaler(H.HOUSING_TOTALS).fit_transform(h),
        "metrics with distributed exact median": M.regression_metrics(
            H.prediction_pairs(spark, sf), "y", "p"),
        "forest scoring (mapInArrow, broadcast model)": SC.predict(
            h.select("row_key", *H.HOUSING_TOTALS), model, uncertainty=True),
        "hash split (no shuffle)": SP.train_test_split(h.select("row_key", H.HOUSING_TARGET)),
        "filter pushdown example: events outliers": clean.remove_outliers(
            H.event_values(spark, sf).where(F.col("value") > 0), ["value"])[0],
    }
    # the roots of four trees over a small state, as the fit searches them
    st = h.select(F.array(*[F.col(c).cast("double") for c in H.HOUSING_TOTALS]).alias("x"),
                  (F.col(H.HOUSING_TARGET) - 200000).alias("yc"),
                  F.array_repeat(F.lit(1).cast("tinyint"), 4).alias("w"))
    trees = _Trees(4)
    open_ = [(t, trees.add(t), subset_for(42, t, 1, 8, 2), 1.0, 0.0, 1.0, 1) for t in range(4)]
    front = spark.sparkContext.broadcast(trees.frontier(list(range(4)), open_, 8, 0))
    jobs["split search level (exact, one level, all trees)"] = levels.best_splits(st, front, 8, 4, 1.0)
    print("# Physical plans of the main jobs\n")
    print(f"Generated by `tools/explain_plans.py` on `{sf}` (AQE on; final plans may coalesce further).\n")
    for name, df in jobs.items():
        text = plan_text(df)
        print(f"## {name}\n\n{summary(text)}\n\n```\n{text.split(chr(10) + chr(10) + '(1)')[0].strip()}\n```\n")


if __name__ == "__main__":
    main()

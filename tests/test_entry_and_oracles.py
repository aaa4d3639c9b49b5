"""Registered queries against their DuckDB oracles on the smallest tables,
plus the entry smoke check and batch = stream scoring."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from sylvan.sources.tables import TABLES

from .conftest import SF001

FAST = ["ratio_features_totals", "safe_ratio_scoring", "label_encode", "missing_report",
        "impute_median_mode", "standard_scale", "preprocess_fit_transform", "split_three_way",
        "bootstrap_weights", "metrics_all", "residual_stats", "compare_models", "forest_fit",
        "best_split", "forest_predict", "predict_interval", "feature_importance", "tree_rules",
        "oob_score", "grid", "forest_fit_levelwise", "forest_fit_missing", "forest_fit_bucketed", "forest_fit_streamed",
        "forest_fit_binned", "random_split", "extra_random_split", "cross_validate", "model_score",
        "evaluate_holdout", "load_csv_fill", "load_csv_drop", "pipeline_roundtrip", "stream_pipeline",
        "median_fill", "score_tiers", "predict_uncertainty"]


def _norm(v):
    if v is None:
        return "~"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.10g}")
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(_norm(r[c]) for c in cols) for r in pdf.to_dict("records")), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF001}/{t}.parquet')")
    return con


def test_registry_is_consistent():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 60


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, duck, name):
    sp = E.queries()[name](spark, SF001).toPandas()
    dk = duck.execute(E.oracle_sql()[name]).df()
    assert _rows(sp) == _rows(dk)


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 8 and set(df.columns) >= {"feature", "importance", "feature_name", "train_r2"}


def test_stream_equals_batch(spark):
    s = E.queries()["stream_score"](spark, SF001).toPandas().sort_values("row_key").reset_index(drop=True)
    b = E.queries()["predict_uncertainty"](spark, SF001).toPandas().sort_values("row_key").reset_index(drop=True)
    assert s.equals(b[s.columns])


def test_stream_in_several_micro_batches_equals_batch(spark):
    from sylvan.operators import score as SC
    from sylvan.plans.catalog import TOT, fitted
    from sylvan.session import scratch_path
    from sylvan.sources import housing as H
    from sylvan.streaming.score_stream import scoring_stream

    rows = H.housing_totals(spark, SF001).select("row_key", *TOT)
    model = fitted(spark, SF001)
    src = scratch_path(spark, "multi-src")
    rows.repartition(4).write.parquet(src)
    sink = scratch_path(spark, "multi-sink")
    q = (scoring_stream(spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(src), model)
         .writeStream.format("parquet").option("path", sink)
         .option("checkpointLocation", scratch_path(spark, "multi-ckpt"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.read.parquet(sink).select("row_key", "prediction")
    want = SC.predict(rows, model).select("row_key", "prediction")
    assert got.count() == want.count() and got.exceptAll(want).count() == 0

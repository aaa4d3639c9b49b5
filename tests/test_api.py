import json

import numpy as np
import pytest

from sylvan.api import ForestRegressor, TreeRegressor
from sylvan.session import scratch_path

FEATS = [f"x{i}" for i in range(5)]


def test_facade_round_trip(spark, sample_regression):
    train, test, _ = sample_regression
    est = ForestRegressor(n_trees=5, max_depth=4, oob_score=True, random_state=1).fit(train, FEATS, "y")
    assert est.oob_score_ is not None
    imp = np.array(est.feature_importances_)
    assert imp.sum() == pytest.approx(1.0)
    p = est.predict_proba(test).toPandas()
    assert len(p) == 20 and (p.uncertainty >= 0).all()
    assert est.score(test, "y") > 0
    store = scratch_path(spark, "api-store")
    mid = est.save(spark, store)
    back = ForestRegressor.load(spark, store, mid)
    a = est.predict(test).toPandas().sort_values("row_key").prediction.to_numpy()
    b = back.predict(test).toPandas().sort_values("row_key").prediction.to_numpy()
    assert np.array_equal(a, b)
    with pytest.raises(IndexError):
        est.get_tree(5)


def test_tree_regressor_and_unfitted_error(spark, sample_regression):
    train, test, _ = sample_regression
    with pytest.raises(ValueError):
        TreeRegressor().predict(test)
    t = TreeRegressor(max_depth=3).fit(train, FEATS, "y")
    assert t.get_depth(spark).first()["depth"] <= 3
    assert t.tree_rules(spark).count() >= 2


def test_cli_round_trip(spark, tmp_path, capsys):
    import json

    from sylvan.cli import main
    base = str(tmp_path)
    assert main(["generate-data", "--rows", "300", "--complexity", "simple", "--output", f"{base}/d"]) == 0
    assert main(["train", "--data", f"{base}/d", "--target", "target", "--store", f"{base}/m",
                 "--n-trees", "3", "--max-depth", "3"]) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["train_r2"] > 0
    assert main(["predict", "--store", f"{base}/m", "--model-id", out["model_id"], "--data", f"{base}/d",
                 "--output", f"{base}/p", "--uncertainty"]) == 0
    back = spark.read.option("header", True).csv(f"{base}/p")
    assert back.count() == 300 and set(back.columns) == {"row_key", "prediction", "uncertainty"}


def test_cli_trains_on_a_csv_with_classes_and_gaps(spark, tmp_path, capsys):
    import pandas as pd

    from sylvan.cli import main
    pdf = pd.DataFrame({"a": [float(i) if i % 5 else None for i in range(200)],
                        "kind": [["x", "y", None][i % 3] for i in range(200)], "y": [float(i % 17) for i in range(200)]})
    pdf.to_csv(tmp_path / "in.csv", index=False)
    assert main(["train", "--data", str(tmp_path / "in.csv"), "--target", "y", "--store", str(tmp_path / "m"),
                 "--n-trees", "2", "--max-depth", "3", "--na-action", "fill"]) == 0
    assert "model_id" in json.loads(capsys.readouterr().out.strip().splitlines()[-1])


def test_checkpoint_folder_must_be_set_off_local(monkeypatch):
    from types import SimpleNamespace

    from sylvan.session import ensure_checkpoint_dir
    fake = SimpleNamespace(sparkContext=SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077"),
                           conf=SimpleNamespace(get=lambda key, default: None))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(fake)


def test_load_csv_semantics(spark, tmp_path):
    import pandas as pd

    from sylvan.sources.io import load_csv
    pdf = pd.DataFrame({"a": [1.0, None, 3.0, 4.0, 5.0, 6.0], "cat": ["x", "y", "x", None, "z", "y"],
                        "y": [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]})
    path = str(tmp_path / "in.csv")
    pdf.to_csv(path, index=False)
    tr, te, feats = load_csv(spark, path, "y", na_action="fill", test_size=0.5)
    rows = tr.unionByName(te).toPandas()
    assert len(rows) == 6 and feats == ["a", "cat"]
    assert rows.a.notna().all() and set(rows.cat) <= {0.0, 1.0, 2.0}
    tr2, te2, _ = load_csv(spark, path, "y", na_action="drop")
    assert tr2.count() + te2.count() == 4
    with pytest.raises(KeyError):
        load_csv(spark, path, "nope")


def test_streaming_with_features_scaler_interval_price(spark, sample_regression):
    from sylvan.operators.scale import StandardScaler
    from sylvan.session import scratch_path
    from sylvan.streaming.score_stream import scoring_stream
    train, test, _ = sample_regression
    sc = StandardScaler(FEATS).fit(train)
    est = ForestRegressor(n_trees=3, max_depth=3).fit(sc.transform(train), FEATS, "y")
    src = scratch_path(spark, "s-src")
    test.write.parquet(src)
    sink = scratch_path(spark, "s-sink")
    q = (scoring_stream(spark.readStream.schema(test.schema).parquet(src), est.model_, scaler=sc,
                        confidence_level=0.9, price_adjust=True)
         .writeStream.format("parquet").option("path", sink)
         .option("checkpointLocation", scratch_path(spark, "s-ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.read.parquet(sink).toPandas()
    assert len(got) == 20 and {"interval", "adjusted_price"} <= set(got.columns)

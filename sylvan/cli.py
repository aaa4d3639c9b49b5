"""Command line: train / predict / evaluate / generate-data / info.

    python -m sylvan train --data t.csv --target y --store /shared/models
    python -m sylvan predict --store /shared/models --model-id ID --data d.csv --output out/ --uncertainty
    python -m sylvan evaluate --store /shared/models --model-id ID --data d.csv --target y
    python -m sylvan generate-data --rows 1000 --output synth/ [--complexity medium]
    python -m sylvan info --store /shared/models

Each command is a thin argument layer over the operators; inputs are
read with ``spark.read`` (CSV with header, or parquet), every step runs
as Spark jobs, and results are written with ``df.write``.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import functions as F


def _read(spark, path: str):
    if path.endswith(".csv") or path.endswith("/csv"):
        return spark.read.option("header", True).option("inferSchema", True).csv(path)
    return spark.read.parquet(path)


def _keyed(df, key: str):
    if key in df.columns:
        return df
    from sylvan.sources.io import with_content_key
    return with_content_key(df, key)


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="sylvan")
    sub = ap.add_subparsers(dest="cmd", required=True)
    t = sub.add_parser("train")
    t.add_argument("--data", required=True)
    t.add_argument("--target", required=True)
    t.add_argument("--features", nargs="*")
    t.add_argument("--store", required=True)
    t.add_argument("--key", default="row_key")
    t.add_argument("--n-trees", type=int, default=100)
    t.add_argument("--max-depth", type=int)
    t.add_argument("--min-samples-split", type=int, default=2)
    t.add_argument("--min-samples-leaf", type=int, default=1)
    t.add_argument("--max-features", default="sqrt")
    t.add_argument("--seed", type=int, default=42)
    t.add_argument("--test-size", type=float, default=0.2)
    t.add_argument("--na-action", choices=["drop", "fill"], default="drop")
    p = sub.add_parser("predict")
    p.add_argument("--store", required=True)
    p.add_argument("--model-id", required=True)
    p.add_argument("--data", required=True)
    p.add_argument("--output", required=True)
    p.add_argument("--key", default="row_key")
    p.add_argument("--uncertainty", action="store_true")
    e = sub.add_parser("evaluate")
    e.add_argument("--store", required=True)
    e.add_argument("--model-id", required=True)
    e.add_argument("--data", required=True)
    e.add_argument("--target", required=True)
    e.add_argument("--key", default="row_key")
    g = sub.add_parser("generate-data")
    g.add_argument("--rows", type=int, default=1000)
    g.add_argument("--features", type=int, default=10)
    g.add_argument("--complexity", choices=["linear", "simple", "medium", "complex"], default="linear")
    g.add_argument("--seed", type=int, default=42)
    g.add_argument("--output", required=True)
    i = sub.add_parser("info")
    i.add_argument("--store", required=True)
    args = ap.parse_args(argv)

    from sylvan.operators import metrics as M
    from sylvan.operators import model_store as MS
    from sylvan.operators import score as SC
    from sylvan.operators.features import select_features
    from sylvan.operators.forest import ForestParams, fit_forest
    from sylvan.operators.split import train_test_split
    from sylvan.session import build_session
    from sylvan.sources import synthetic as SY
    from sylvan.sources.io import load_csv, write_predictions

    spark = build_session()
    if args.cmd == "train":
        if args.data.endswith("csv"):
            train, test, feats = load_csv(spark, args.data, args.target, args.features, args.test_size,
                                          args.seed, args.na_action, args.key)
        else:
            df = _keyed(_read(spark, args.data), args.key)
            df = select_features(df, args.target, args.features, keep=(args.key,))
            feats = [c for c in df.columns if c not in (args.key, args.target)]
            s = train_test_split(df, args.key, args.test_size, args.seed)
            train, test = s.where(F.col("split") == "train"), s.where(F.col("split") == "test")
        mf = args.max_features
        mf = None if mf == "none" else (float(mf) if "." in mf else (int(mf) if mf.isdigit() else mf))
        model = fit_forest(train, feats, args.target, ForestParams(
            n_trees=args.n_trees, max_depth=args.max_depth, min_samples_split=args.min_samples_split,
            min_samples_leaf=args.min_samples_leaf, max_features=mf, seed=args.seed), key=args.key)
        model.training_score = SC.score(train, model, args.target)
        test_r2 = SC.score(test, model, args.target)
        mid = MS.save_model(spark, model, args.store, metadata={"test_r2": test_r2})
        print(json.dumps({"model_id": mid, "train_r2": model.training_score, "test_r2": test_r2}))
    elif args.cmd == "predict":
        model = MS.load_model(spark, args.store, args.model_id)
        df = _keyed(_read(spark, args.data), args.key)
        out = SC.predict(df, model, uncertainty=args.uncertainty)
        cols = [args.key, "prediction"] + (["uncertainty"] if args.uncertainty else [])
        write_predictions(out.select(*cols), args.output, "csv")
    elif args.cmd == "evaluate":
        model = MS.load_model(spark, args.store, args.model_id)
        df = _keyed(_read(spark, args.data), args.key)
        met = M.regression_metrics(SC.predict(df, model), args.target, "prediction",
                                   n_features=model.n_features)
        print(json.dumps(met.first().asDict()))
    elif args.cmd == "generate-data":
        keys = spark.range(args.rows).withColumnRenamed("id", "row_key")
        if args.complexity == "linear":
            out = SY.linear_set(keys, n_features=args.features, seed=args.seed)
        else:
            out = SY.nonlinear_set(keys, complexity=args.complexity, seed=args.seed)
        out.write.mode("overwrite").parquet(args.output)
    elif args.cmd == "info":
        MS.list_models(spark, args.store).show(truncate=False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())

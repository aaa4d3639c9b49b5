"""Fitted preprocessing kept with a model (S8): fills, scaler constants and
class codes in one typed table, read back as the objects that made them."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sylvan.operators import clean, features as P, scale as C

COLUMNS = "part string, column string, stat string, number double, label string"


@dataclass
class FittedState:
    """Imputer, scaler and label encoders of a trained pipeline (each optional)."""

    imputer: clean.ImputerState | None = None
    scaler: object = None
    encoders: DataFrame | None = None           # (column, class, code)
    encoded: list = field(default_factory=list)

    def prepare(self, df: DataFrame) -> DataFrame:
        """Raw rows with missing values filled and classes coded, unscaled."""
        d = clean.apply_imputer(df, self.imputer) if self.imputer is not None else df
        for c in self.encoded:
            d = P.apply_label_encoder(d, self.encoders, c, f"{c}_code")
            d = d.withColumn(f"{c}_code", F.col(f"{c}_code").cast("double"))
        return d

    def transform(self, df: DataFrame) -> DataFrame:
        """Raw rows as the model expects them."""
        d = self.prepare(df)
        return self.scaler.transform(d) if self.scaler is not None else d


def fit_state(df: DataFrame, numeric, strings=(), strategy: str = "median", scaler: str = "standard",
              sig_digits: int | None = None) -> FittedState:
    """Learn fills and scaling of ``numeric`` and codes of ``strings`` from ``df``.

    Its rows are computed once and kept for the passes over them; of the codes
    the class tables stay cached, so that no later use reads the rows again."""
    rows = df.select(*dict.fromkeys([*numeric, *strings])).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        state = FittedState(imputer=clean.fit_imputer(rows, numeric, strategy), encoded=list(strings))
        for c in strings:
            enc = P.fit_label_encoder(rows, c)
            state.encoders = enc if state.encoders is None else state.encoders.unionByName(enc)
        if state.encoders is not None:
            state.encoders = state.encoders.persist(StorageLevel.MEMORY_AND_DISK)
            state.encoders.count()
        state.scaler = C.make_scaler(scaler, numeric, sig_digits).fit(clean.apply_imputer(rows, state.imputer))
    finally:
        rows.unpersist()
    return state


def save_state(spark: SparkSession, folder: str, state: FittedState) -> None:
    """Write the state as one table."""
    rows = []
    if state.imputer is not None:
        rows += [("imputer", c, state.imputer.strategy, float(v), None) for c, v in state.imputer.fills.items()]
    if state.scaler is not None:
        kind = "standard" if isinstance(state.scaler, C.StandardScaler) else "minmax"
        rows += [(kind, c, stat, float(v), None) for c, stat, v in state.scaler.state()]
    table = spark.createDataFrame(rows, COLUMNS)
    if state.encoders is not None:
        table = table.unionByName(state.encoders.select(
            F.lit("encoder").alias("part"), "column", F.lit("code").alias("stat"),
            F.col("code").cast("double").alias("number"), F.col("class").cast("string").alias("label")))
    table.write.parquet(folder)


def load_state(spark: SparkSession, store: str, model_id: str) -> FittedState:
    """Read a model's state back.  Class tables stay tables; the constants of
    the imputer and the scaler are one row a column."""
    from sylvan.operators.model_store import committed
    _commit, home = committed(spark, store, model_id)
    table = spark.read.parquet(f"{home}/state")
    by: dict[str, dict] = {}
    strategy = "median"
    for r in table.where("part <> 'encoder'").collect():
        by.setdefault(r["part"], {}).setdefault(r["stat"], {})[r["column"]] = r["number"]
    out = FittedState()
    if "imputer" in by:
        strategy, fills = next(iter(by["imputer"].items()))
        out.imputer = clean.ImputerState(strategy, fills)
    if "standard" in by:
        s = by["standard"]
        out.scaler = C.StandardScaler(list(s["mean"]), mean_=s["mean"], scale_=s["scale"])
    elif "minmax" in by:
        s = by["minmax"]
        out.scaler = C.MinMaxScaler(list(s["scale"]), scale_=s["scale"], min_=s["min"])
    enc = table.where("part = 'encoder'").select("column", F.col("label").alias("class"),
                                                 F.col("number").cast("int").alias("code"))
    out.encoded = sorted(r["column"] for r in enc.select("column").distinct().collect())
    out.encoders = enc if out.encoded else None
    return out

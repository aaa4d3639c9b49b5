"""Projections and scalar features.

All of these are narrow projections: no shuffle, whole-stage codegen.
Ratios use ``try_divide`` (NULL on a zero divisor, never an ANSI error);
the scoring-time variant uses "0 when the divisor is not positive".
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sylvan.functions.exprs import broadcast_if_small, positive_ratio, safe_div
from sylvan.operators.ranking import with_global_position


# ---- P1 / P2 ---------------------------------------------------------------

def select_features(df: DataFrame, target: str, features=None, keep=("row_key",)) -> DataFrame:
    """P1 + P2: pick features (default: every column but the target and
    kept keys) and the target, cast to double; unknown names raise."""
    if target not in df.columns:
        raise KeyError(f"the frame has no target column {target!r}")
    keep = [k for k in keep if k in df.columns]
    if features is None:
        features = [c for c in df.columns if c != target and c not in keep]
    missing = sorted(set(features) - set(df.columns))
    if missing:
        raise KeyError(f"the frame lacks the features {missing}")
    return df.select(*keep, *[F.col(c).cast("double").alias(c) for c in features],
                     F.col(target).cast("double").alias(target))


# ---- P3 / P4 / P5: ratio features on totals --------------------------------

def ratio_features_totals(df: DataFrame) -> DataFrame:
    """The eight ratio features on the totals form."""
    return df.withColumns({
        "rooms_per_household": safe_div("total_rooms", "households"),
        "bedrooms_per_room": safe_div("total_bedrooms", "total_rooms"),
        "population_per_household": safe_div("population", "households"),
        "bedrooms_per_household": safe_div("total_bedrooms", "households"),
        "income_per_room": safe_div("median_income", "total_rooms"),
        "income_per_person": safe_div("median_income", "population"),
        "room_density": safe_div("total_rooms", F.col("households") + 1),
        "bedroom_ratio": safe_div("total_bedrooms", F.col("total_rooms") + 1),
    })


def ratio_interactions(df: DataFrame) -> DataFrame:
    """P3 plus latitude x longitude and income x age."""
    return ratio_features_totals(df).withColumns({
        "lat_lon_interaction": F.col("latitude") * F.col("longitude"),
        "income_age_interaction": F.col("median_income") * F.col("housing_median_age"),
    })


P5_FEATURES = ["rooms_per_household", "bedrooms_per_room", "population_per_household",
               "income_per_room", "income_per_person", "bedroom_ratio"]


def ratio_subset(df: DataFrame) -> DataFrame:
    """P5: six of the P3 features."""
    full = ratio_features_totals(df)
    drop = [c for c in ("bedrooms_per_household", "room_density") if c in full.columns]
    return full.drop(*drop)


# ---- P6 / P7 / P8: features on the averages form ---------------------------

AVG_ENGINEERED = ["rooms_per_household", "bedrooms_per_room", "population_per_household",
                  "income_per_room", "age_income_interaction", "location_density"]
POLY = ["income_squared", "rooms_squared"]


def avg_features(df: DataFrame) -> DataFrame:
    """Six engineered features on the averages form (training side:
    NULL on a zero divisor, later median-filled).  population_per_household
    is Population / HouseAge, as in the source pipeline."""
    return df.withColumns({
        "rooms_per_household": safe_div("AveRooms", "AveOccup"),
        "bedrooms_per_room": safe_div("AveBedrms", "AveRooms"),
        "population_per_household": safe_div("Population", "HouseAge"),
        "income_per_room": safe_div("MedInc", "AveRooms"),
        "age_income_interaction": F.col("HouseAge") * F.col("MedInc"),
        "location_density": safe_div("Population", F.col("AveOccup") + 1),
    })


def poly_features(df: DataFrame) -> DataFrame:
    """Income squared and rooms squared."""
    return df.withColumns({
        "income_squared": F.col("MedInc") * F.col("MedInc"),
        "rooms_squared": F.col("AveRooms") * F.col("AveRooms"),
    })


def scoring_features(df: DataFrame, enhanced: bool = False) -> DataFrame:
    """The P6 features with the scoring-time rule (0 unless the
    divisor is > 0), plus P7 when ``enhanced``."""
    out = df.withColumns({
        "rooms_per_household": positive_ratio("AveRooms", "AveOccup"),
        "bedrooms_per_room": positive_ratio("AveBedrms", "AveRooms"),
        "population_per_household": positive_ratio("Population", "HouseAge"),
        "income_per_room": positive_ratio("MedInc", "AveRooms"),
        "age_income_interaction": F.col("HouseAge") * F.col("MedInc"),
        "location_density": F.col("Population") / (F.col("AveOccup") + 1),
    })
    return poly_features(out) if enhanced else out


# ---- P9 / P10 ---------------------------------------------------------------

QUICK_ORDER = ["longitude", "latitude", "housing_median_age", "total_rooms", "total_bedrooms",
               "population", "households", "median_income", "ocean_proximity_code"]


def rebuild_totals(df: DataFrame) -> DataFrame:
    """Totals from averages: households = max(1, Population/AveOccup),
    totals = average x households, category code 0, in the 9-column order
    of the totals-form model."""
    hh = F.greatest(F.lit(1.0), F.coalesce(safe_div("Population", "AveOccup"), F.lit(1.0)))
    keep = [c for c in df.columns if c not in set(QUICK_ORDER)]
    d = df.withColumn("households", hh)
    d = d.withColumns({
        "longitude": F.col("Longitude"), "latitude": F.col("Latitude"),
        "housing_median_age": F.col("HouseAge"),
        "total_rooms": F.col("AveRooms") * F.col("households"),
        "total_bedrooms": F.col("AveBedrms") * F.col("households"),
        "population": F.col("Population"), "median_income": F.col("MedInc"),
        "ocean_proximity_code": F.lit(0.0)})
    key = [c for c in ("row_key",) if c in keep]
    return d.select(*key, *QUICK_ORDER)


def feature_vector(df: DataFrame, feature_names, name: str = "features") -> DataFrame:
    """P10: ordered ARRAY<DOUBLE> of the model's features."""
    missing = [c for c in feature_names if c not in df.columns]
    if missing:
        raise KeyError(f"the frame lacks the features {missing}")
    return df.withColumn(name, F.array(*[F.col(c).cast("double") for c in feature_names]))


def explode_array(df: DataFrame, array_col: str = "features", prefix: str = "f",
                  n: int | None = None) -> DataFrame:
    """ARRAY<DOUBLE> column to positional columns f0..f{n-1}."""
    if n is None:
        n = df.select(F.max(F.size(array_col))).first()[0] or 0
    return df.withColumns({f"{prefix}{i}": F.col(array_col)[i].cast("double") for i in range(n)})


# ---- P12 / P13: label encoding --------------------------------------------

def fit_label_encoder(df: DataFrame, col: str) -> DataFrame:
    """P12 fit: (column, class, code) with code = rank of the class among
    the sorted distinct values.  Distinct values come from a grouped
    aggregation and are ranked by the distributed position operator, so
    even a high-cardinality column never lands in one task."""
    classes = df.where(F.col(col).isNotNull()).select(F.col(col).alias("class")).distinct()
    ranked = with_global_position(classes, ["class"])
    return ranked.select(F.lit(col).alias("column"), "class", F.col("_pos").cast("int").alias("code"))


def apply_label_encoder(df: DataFrame, encoder: DataFrame, col: str,
                        out: str | None = None, unseen: str = "null",
                        max_rows: int = 1_000_000) -> DataFrame:
    """Map classes to codes with a left join, broadcast only after
    the class table is counted below ``max_rows``.  ``unseen``: "null"
    keeps unknown classes as NULL, "error" raises on the first one."""
    out = out or f"{col}_code"
    enc = encoder.where(F.col("column") == col).select(
        F.col("class").alias("_cls"), F.col("code").alias(out))
    enc = broadcast_if_small(enc, max_rows)
    res = df.join(enc, df[col] == enc["_cls"], "left").drop("_cls")
    if unseen == "error":
        res = res.withColumn(out, F.when(F.col(col).isNotNull() & F.col(out).isNull(),
                                         F.raise_error(F.lit("unseen label"))).otherwise(F.col(out)))
    return res


# ---- P14 / P15 ----------------------------------------------------------------

def scale_target(df: DataFrame, col: str = "target", factor: float = 100000.0) -> DataFrame:
    """Target unit scaling."""
    return df.withColumn(col, F.col(col) * F.lit(float(factor)))


# Fixed values of the reference's price adjustment: inflation factor 2.2,
# then market premium 1.5.
INFLATION_FACTOR = 2.2
MARKET_PREMIUM = 1.5


def price_adjust(df: DataFrame, pred: str = "prediction") -> DataFrame:
    """Inflation then market premium, with the breakdown."""
    return df.withColumns({
        "base_price": F.col(pred),
        "after_inflation": F.col(pred) * F.lit(INFLATION_FACTOR),
        "adjusted_price": F.col(pred) * F.lit(INFLATION_FACTOR) * F.lit(MARKET_PREMIUM),
    })

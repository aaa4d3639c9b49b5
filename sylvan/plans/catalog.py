"""Registered queries: one Spark job per operator family, each with the
DuckDB SQL that states the expected result (``None`` = rows-only).

Every query reads the driver's tables (through the frames of
:mod:`sylvan.sources.housing`) over whole tables.  Floating outputs are
rounded identically on both sides so the value hashes compare.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sylvan.operators import clean, features as P, metrics as M, scale as C, split as SP
from sylvan.operators import model_store as MS
from sylvan.operators import score as SC
from sylvan.operators.forest import ForestParams, fit_forest
from sylvan.plans import oracle_forest as OF
from sylvan.plans.sqlkit import (AVERAGES_SQL, HOUSING_SQL, h8, hexcut, normal, poisson,
                                 subset_sql, uni, with_frames)
from sylvan.sources import housing as H
from sylvan.sources import synthetic as SY
from sylvan.sources.io import csv_roundtrip as _csv_roundtrip
from sylvan.sources.tables import table

TOT = H.HOUSING_TOTALS
AVG = H.AVERAGES
Y = H.HOUSING_TARGET


def sig10(x: str) -> str:
    """DuckDB twin of scale.significant(x, 10)."""
    return (f"(case when ({x}) = 0 or ({x}) is null then ({x}) else "
            f"round(({x}), 9 - cast(floor(log10(abs({x}))) as integer)) end)")


def std_stats(cols, src: str, prefix_m: str = "m_", prefix_s: str = "s_", by_index: bool = False) -> str:
    """avg / population std per column, stored to 10 significant digits
    (zero std -> 1), as StandardScaler.fit does."""
    parts = []
    for i, c in enumerate(cols):
        k = str(i) if by_index else c
        parts.append(f"{sig10(f'avg({c})')} as {prefix_m}{k}, case when stddev_pop({c}) = 0 then 1.0 "
                     f"else {sig10(f'stddev_pop({c})')} end as {prefix_s}{k}")
    return f"select {', '.join(parts)} from {src}"


def rnd(df: DataFrame, digits: dict) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), d) for c, d in digits.items()})


# ---- sources --------------------------------------------------------------

def q_csv_roundtrip(spark, sf):
    h = H.housing_totals(spark, sf)
    back = _csv_roundtrip(spark, h)
    return back


SQL_CSV = with_frames(f"select row_key, {', '.join(TOT + [Y])}, ocean_proximity from h")


def q_array_features(spark, sf):
    e = H.embedding_rows(spark, sf)
    wide = P.explode_array(e, "features", "f", 64)
    return rnd(wide.select("row_key", "label", F.size("features").alias("n_dims"),
                           "f0", "f1", "f63",
                           F.sqrt(F.aggregate("features", F.lit(0.0), lambda a, v: a + v * v)).alias("l2")),
               {"f0": 6, "f1": 6, "f63": 6, "l2": 6})


SQL_ARRAY = """select vec_id as row_key, cast(label as double) as label,
  cast(len(embedding) as integer) as n_dims,
  round(cast(embedding[1] as double), 6) as f0, round(cast(embedding[2] as double), 6) as f1,
  round(cast(embedding[64] as double), 6) as f63,
  round(sqrt(list_reduce(list_transform(embedding, lambda v: cast(v as double) * cast(v as double)),
        lambda a, b: a + b)), 6) as l2
from embeddings"""


def q_synth_linear(spark, sf):
    return rnd(SY.linear_set(table(spark, sf, "orders").select(F.col("o_orderkey").alias("row_key"))),
               {**{f"feature_{i}": 9 for i in range(10)}, "target": 6})


def _sql_normals(n, key="o_orderkey", seed=42):
    cols = []
    for i in range(n):
        a = h8(key, f"'{seed}'", "'x'", str(i), "'a'")
        b = h8(key, f"'{seed}'", "'x'", str(i), "'b'")
        cols.append(f"{normal(a, b)} as feature_{i}")
    return ", ".join(cols)


def _sql_noise(key="o_orderkey", seed=42):
    return normal(h8(key, f"'{seed}'", "'noise'", "'a'"), h8(key, f"'{seed}'", "'noise'", "'b'"))


def _sql_linear():
    coefs = SY.linear_coefficients(42, 5)
    lin = " + ".join(f"{c!r} * feature_{j}" for j, c in enumerate(coefs))
    return f"""with s as (select o_orderkey as row_key, {_sql_normals(10)}, {_sql_noise()} as eps from orders)
select row_key, {', '.join(f'round(feature_{i}, 9) as feature_{i}' for i in range(10))},
  round({lin} + 0.1 * eps, 6) as target from s"""


def _synth_nl(level):
    def q(spark, sf):
        df = SY.nonlinear_set(table(spark, sf, "orders").select(F.col("o_orderkey").alias("row_key")),
                              complexity=level)
        return rnd(df, {**{f"feature_{i}": 9 for i in range(5)}, "target": 6})
    return q


def _sql_nl(level):
    x = [f"feature_{i}" for i in range(5)]
    f = {
        "simple": f"{x[0]} * {x[0]} + 0.5 * {x[1]} + 0.2 * {x[2]}",
        "medium": f"{x[0]} * {x[0]} + {x[1]} * {x[1]} + {x[0]} * {x[1]} + 0.5 * sin({x[2]}) + 0.3 * exp({x[3]} / 2)",
        "complex": (f"sin({x[0]}) * ({x[1]} * {x[1]}) + cos({x[2]}) * {x[3]} + exp({x[4]} / 3) "
                    f"+ {x[0]} * {x[1]} * {x[2]} + sqrt(abs({x[0]} + {x[1]}))"),
    }[level]
    return f"""with s as (select o_orderkey as row_key, {_sql_normals(5)}, {_sql_noise()} as eps from orders)
select row_key, {', '.join(f'round({c}, 9) as {c}' for c in x)}, round({f} + 0.1 * eps, 6) as target from s"""


# ---- projections ------------------------------------------------------------

P3 = ["rooms_per_household", "bedrooms_per_room", "population_per_household", "bedrooms_per_household",
      "income_per_room", "income_per_person", "room_density", "bedroom_ratio"]
P3_SQL = {
    "rooms_per_household": "total_rooms / nullif(households, 0)",
    "bedrooms_per_room": "total_bedrooms / nullif(total_rooms, 0)",
    "population_per_household": "population / nullif(households, 0)",
    "bedrooms_per_household": "total_bedrooms / nullif(households, 0)",
    "income_per_room": "median_income / nullif(total_rooms, 0)",
    "income_per_person": "median_income / nullif(population, 0)",
    "room_density": "total_rooms / nullif(households + 1, 0)",
    "bedroom_ratio": "total_bedrooms / nullif(total_rooms + 1, 0)",
}


def q_ratio_features_totals(spark, sf):
    d = P.ratio_features_totals(H.housing_totals(spark, sf))
    return d.select("row_key", *P3)


SQL_P3 = with_frames("select row_key, " + ", ".join(f"{e} as {c}" for c, e in P3_SQL.items()) + " from h")


def q_ratio_interactions(spark, sf):
    d = P.ratio_interactions(H.housing_totals(spark, sf))
    cols = P3 + ["lat_lon_interaction", "income_age_interaction"]
    return d.select("row_key", *cols)


SQL_P4 = with_frames("select row_key, " + ", ".join(f"{e} as {c}" for c, e in P3_SQL.items())
                     + ", latitude * longitude as lat_lon_interaction, "
                       "median_income * housing_median_age as income_age_interaction from h")


def q_ratio_subset(spark, sf):
    d = P.ratio_subset(H.housing_totals(spark, sf))
    return d.select("row_key", *P.P5_FEATURES)


SQL_P5 = with_frames("select row_key, " + ", ".join(f"{P3_SQL[c]} as {c}" for c in P.P5_FEATURES)
                     + " from h")

P6_SQL = {
    "rooms_per_household": "AveRooms / nullif(AveOccup, 0)",
    "bedrooms_per_room": "AveBedrms / nullif(AveRooms, 0)",
    "population_per_household": "Population / nullif(HouseAge, 0)",
    "income_per_room": "MedInc / nullif(AveRooms, 0)",
    "age_income_interaction": "HouseAge * MedInc",
    "location_density": "Population / nullif(AveOccup + 1, 0)",
}


def q_avg_features(spark, sf):
    d = P.avg_features(H.housing_averages(spark, sf))
    return d.select("row_key", *P.AVG_ENGINEERED)


SQL_P6 = with_frames("select row_key, " + ", ".join(f"{e} as {c}" for c, e in P6_SQL.items())
                     + " from a", averages=True)


def q_poly_features(spark, sf):
    d = P.poly_features(H.housing_averages(spark, sf))
    return d.select("row_key", *P.POLY)


SQL_P7 = with_frames("select row_key, MedInc * MedInc as income_squared, "
                     "AveRooms * AveRooms as rooms_squared from a", averages=True)

P8_SQL = {
    "rooms_per_household": "case when AveOccup > 0 then AveRooms / AveOccup else 0.0 end",
    "bedrooms_per_room": "case when AveRooms > 0 then AveBedrms / AveRooms else 0.0 end",
    "population_per_household": "case when HouseAge > 0 then Population / HouseAge else 0.0 end",
    "income_per_room": "case when AveRooms > 0 then MedInc / AveRooms else 0.0 end",
    "age_income_interaction": "HouseAge * MedInc",
    "location_density": "Population / (AveOccup + 1)",
    "income_squared": "MedInc * MedInc",
    "rooms_squared": "AveRooms * AveRooms",
}


def q_safe_ratio_scoring(spark, sf):
    d = P.scoring_features(H.housing_averages(spark, sf), enhanced=True)
    cols = list(P8_SQL)
    return d.select("row_key", *cols)


SQL_P8 = with_frames("select row_key, " + ", ".join(f"{e} as {c}" for c, e in P8_SQL.items())
                     + " from a", averages=True)


def q_rebuild_totals(spark, sf):
    d = P.rebuild_totals(H.housing_averages(spark, sf))
    return d


SQL_P9 = with_frames("""select row_key, Longitude as longitude, Latitude as latitude,
  HouseAge as housing_median_age, AveRooms * hh as total_rooms,
  AveBedrms * hh as total_bedrooms, Population as population,
  hh as households, MedInc as median_income, cast(0.0 as double) as ocean_proximity_code
from (select *, greatest(1.0, coalesce(Population / nullif(AveOccup, 0), 1.0)) as hh from a)""",
                     averages=True)

BALANCED_14 = AVG + P.AVG_ENGINEERED


def q_feature_vector(spark, sf):
    d = P.feature_vector(P.scoring_features(H.housing_averages(spark, sf).fillna(0.0, AVG)),
                         BALANCED_14, "features")
    return rnd(d.select("row_key", F.size("features").alias("n_features"),
                        F.element_at("features", 1).alias("v_first"),
                        F.element_at("features", -1).alias("v_last"),
                        F.aggregate("features", F.lit(0.0), lambda a, v: a + v).alias("v_sum")),
               {"v_first": 6, "v_last": 6, "v_sum": 4})


SQL_P10 = with_frames(
    "select row_key, 14 as n_features, round(MedInc, 6) as v_first, round(" + P8_SQL["location_density"]
    + ", 6) as v_last, round(" + " + ".join(
        [f"coalesce({c}, 0.0)" for c in AVG]
        + [f"({P8_SQL[c]})" for c in P.AVG_ENGINEERED]) + ", 4) as v_sum from "
    "(select row_key, MedInc, HouseAge, coalesce(AveRooms, 0.0) as AveRooms, "
    "coalesce(AveBedrms, 0.0) as AveBedrms, Population, coalesce(AveOccup, 0.0) as AveOccup, "
    "Latitude, Longitude from a)", averages=True)


def q_label_encode(spark, sf):
    return P.fit_label_encoder(H.housing_totals(spark, sf), "ocean_proximity")


SQL_P12 = with_frames("select 'ocean_proximity' as column, class, "
                      "cast(dense_rank() over (order by class) - 1 as integer) as code "
                      "from (select distinct ocean_proximity as class from h)")


def q_encoder_apply(spark, sf):
    h = H.housing_totals(spark, sf)
    enc = P.fit_label_encoder(h, "ocean_proximity")
    return P.apply_label_encoder(h.select("row_key", "ocean_proximity"), enc, "ocean_proximity")


SQL_P13 = with_frames("select row_key, ocean_proximity, cast(dense_rank() over (order by ocean_proximity) - 1 "
                      "as integer) as ocean_proximity_code from h")


def q_price_adjust(spark, sf):
    d = P.price_adjust(H.prediction_pairs(spark, sf), "p")
    return d.select("row_key", "base_price", "after_inflation", "adjusted_price")


SQL_P15 = with_frames("select row_key, p as base_price, p * 2.2 as after_inflation, "
                      "p * 2.2 * 1.5 as adjusted_price from pf", pred=True)


def q_error_bands(spark, sf):
    d = M.error_bands(H.prediction_pairs(spark, sf))
    return d.select("row_key", "error_pct", "band")


SQL_P16 = with_frames("select row_key, e as error_pct, case when e < 15 then 'good' "
                      "when e < 25 then 'ok' else 'high' end as band from "
                      "(select row_key, abs((y - p) / nullif(y, 0)) * 100 as e from pf)", pred=True)


def _model_preds(spark, sf):
    """Predictions of four 'models' of rising error on one test set."""
    return H.prediction_pairs(spark, sf).select("row_key", "y", F.explode(F.array(*(
        F.struct(F.lit(f"model_{k}").alias("model"),
                 (F.col("y") + (F.col("p") - F.col("y")) * (k * k * 4)).alias("p")) for k in range(1, 5))))
        .alias("m")).select("row_key", "y", "m.model", "m.p")


SQL_MODEL_PREDS = ("mp as (select row_key, y, 'model_' || k as model, y + (p - y) * (k * k * 4) as p "
                   "from pf cross join (select unnest([1, 2, 3, 4]) as k))")


def q_score_tiers(spark, sf):
    m = M.regression_metrics(_model_preds(spark, sf), group_cols=["model"], with_median=False)
    t = M.score_tiers(m)
    return rnd(t.select("model", "r2_score", "tier", "gap_pct", "meets_target"),
               {"r2_score": 9, "gap_pct": 7})


def _sql_metrics_body(src: str, group: str) -> str:
    gsel = f"{group}, " if group else ""
    gby = f"group by {group}" if group else ""
    med_join = f"using ({group})" if group else "on true"
    return f"""mom as (select {gsel}count(*) as n, avg((y - p) * (y - p)) as mse, avg(abs(y - p)) as mae,
    avg(case when y <> 0 then abs((y - p) / y) end) as mape_, var_pop(y) as vy, var_pop(y - p) as ve,
    max(abs(y - p)) as max_error,
    avg(case when (abs(y) + abs(p)) / 2 <> 0 then abs(y - p) / ((abs(y) + abs(p)) / 2) end) as smape_
  from {src} {gby}),
med as (select {gsel}quantile_cont(abs(y - p), 0.5) as median_ae from {src} {gby}),
met as (select {gsel}n, mse, sqrt(mse) as rmse, mae, coalesce(mape_ * 100, 'inf'::double) as mape,
    case when vy > 0 then 1 - mse / vy when mse = 0 then 1.0 else 0.0 end as r2_score,
    case when vy > 0 then 1 - ve / vy when ve = 0 then 1.0 else 0.0 end as explained_variance,
    max_error, median_ae, coalesce(smape_ * 100, 0.0) as smape
  from mom join med {med_join})"""


SQL_P17 = with_frames(
    "select model, round(r2_score, 9) as r2_score, case when r2_score >= 0.85 then 'outstanding' "
    "when r2_score >= 0.80 then 'success' when r2_score >= 0.75 then 'close' else 'below' end as tier, "
    "round((0.8 - r2_score) * 100, 7) as gap_pct, r2_score >= 0.8 as meets_target from met",
    pred=True, extra=SQL_MODEL_PREDS + ",\n" + _sql_metrics_body("mp", "model"))


# ---- filters / missing / validation ----------------------------------------------

def q_drop_missing(spark, sf):
    return clean.drop_missing(H.housing_averages(spark, sf))


SQL_F1 = with_frames("select row_key, " + ", ".join(AVG + ["target"])
                     + " from a where " + " and ".join(f"{c} is not null" for c in AVG + ["target"]),
                     averages=True)


def q_missing_report(spark, sf):
    return clean.missing_report(H.housing_averages(spark, sf))


SQL_F5 = with_frames(" union all ".join(
    f"select '{c}' as column, count(*) filter (where {c} is null"
    + (f" or isnan({c})" if c != "row_key" else "") + f") as n_missing from a"
    for c in ["row_key"] + AVG + ["target"]), averages=True)


def q_impute_median_mode(spark, sf):
    h = H.housing_averages(spark, sf)
    d = clean.impute_median_mode(h, exclude=["row_key"])
    return rnd(d, {c: 9 for c in AVG + ["target"]})


SQL_I1 = with_frames("select row_key, " + ", ".join(
    f"round(coalesce({c}, (select median({c}) from a)), 9) as {c}" for c in AVG + ["target"]) + " from a",
    averages=True)


def q_impute_mean(spark, sf):
    h = H.housing_averages(spark, sf)
    st = clean.fit_imputer(h, AVG, "mean")
    return rnd(clean.apply_imputer(h, st).drop("target"), {c: 9 for c in AVG})


SQL_I2 = with_frames("select row_key, " + ", ".join(
    f"round(coalesce({c}, (select avg({c}) from a)), 9) as {c}" for c in AVG) + " from a", averages=True)


def q_outlier_filter(spark, sf):
    ev = H.event_values(spark, sf)
    kept, _ = clean.remove_outliers(ev, ["value"], 3.0)
    return kept


SQL_F2 = """select event_id as row_key, value from events, (select avg(value) as m, stddev_pop(value) as s from events) st
where not (abs((value - st.m) / (st.s + 1e-8)) > 3.0)"""


def q_validate_rules(spark, sf):
    return clean.validate(H.housing_averages(spark, sf), feature_cols=AVG, target="target")


SQL_F3 = with_frames(" union all ".join(
    [f"select 'missing_{c}' as rule, count(*) filter (where {c} is null or isnan({c})) as n_violations from a "
     f"union all select 'infinite_{c}' as rule, count(*) filter (where abs({c}) = 'inf'::double) from a"
     for c in AVG]
    + ["select 'missing_target' as rule, count(*) filter (where target is null or isnan(target)) from a"]),
    averages=True)


# ---- scaling --------------------------------------------------------------------

def _complete_totals(spark, sf):
    return clean.drop_missing(H.housing_totals(spark, sf).select("row_key", *TOT, Y))


SQL_COMPLETE = "hc as (select row_key, " + ", ".join(TOT) + f", {Y} from h where total_bedrooms is not null)"


def q_standard_scale(spark, sf):
    d = _complete_totals(spark, sf)
    return rnd(C.StandardScaler(TOT, sig_digits=10).fit_transform(d).drop(Y), {c: 7 for c in TOT})


def _sql_std():
    return with_frames("select row_key, " + ", ".join(f"round(({c} - m_{c}) / s_{c}, 7) as {c}" for c in TOT)
                       + f" from hc cross join ({std_stats(TOT, 'hc')})", extra=SQL_COMPLETE)


def q_standard_inverse(spark, sf):
    d = _complete_totals(spark, sf)
    sc = C.StandardScaler(TOT, sig_digits=10)
    return rnd(sc.inverse_transform(sc.fit_transform(d)).drop(Y), {c: 9 for c in TOT})


SQL_STD_INV = with_frames("select row_key, " + ", ".join(f"round({c}, 9) as {c}" for c in TOT) + " from hc",
                          extra=SQL_COMPLETE)


def q_minmax_scale(spark, sf):
    d = _complete_totals(spark, sf)
    return rnd(C.MinMaxScaler(TOT).fit_transform(d).drop(Y), {c: 7 for c in TOT})


def _sql_minmax():
    stats = ", ".join(f"min({c}) as lo_{c}, case when max({c}) - min({c}) = 0 then 1.0 "
                      f"else max({c}) - min({c}) end as r_{c}" for c in TOT)
    return with_frames("select row_key, " + ", ".join(
        f"round({c} * (1.0 / r_{c}) + (0.0 - lo_{c} * (1.0 / r_{c})), 7) as {c}" for c in TOT)
        + f" from hc cross join (select {stats} from hc)", extra=SQL_COMPLETE)


def q_minmax_inverse(spark, sf):
    d = _complete_totals(spark, sf)
    sc = C.MinMaxScaler(TOT)
    return rnd(sc.inverse_transform(sc.fit_transform(d)).drop(Y), {c: 9 for c in TOT})


def q_preprocess_fit_transform(spark, sf):
    h = H.housing_totals(spark, sf).select("row_key", *TOT, Y)
    pp = C.Preprocessor(TOT, scaler_type="standard", handle_missing="mean", remove_outliers=True,
                        sig_digits=10)
    return rnd(pp.fit_transform(h).drop(Y), {c: 7 for c in TOT})


def _sql_preprocess():
    fill = ", ".join(f"coalesce({c}, (select avg({c}) from h)) as {c}" for c in TOT)
    zs = ", ".join(f"avg({c}) as m_{c}, stddev_pop({c}) as s_{c}" for c in TOT)
    cond = " or ".join(f"abs(({c} - m_{c}) / (s_{c} + 1e-8)) > 3.0" for c in TOT)
    body = ("select row_key, " + ", ".join(f"round(({c} - a_{c}) / d_{c}, 7) as {c}" for c in TOT)
            + f" from kept cross join ({std_stats(TOT, 'kept', 'a_', 'd_')})")
    extra = (f"fl as (select row_key, {fill} from h),\n"
             f"kept as (select fl.* from fl cross join (select {zs} from fl) z where not ({cond}))")
    return with_frames(body, extra=extra)


# ---- splitting / sampling --------------------------------------------------------------

def q_split_train_test(spark, sf):
    return SP.train_test_split(H.housing_totals(spark, sf).select("row_key"), test_size=0.2, seed=42)


SQL_SP1 = f"select o_orderkey as row_key, case when {h8('o_orderkey', repr('42'))} < {hexcut(0.2)} then 'test' else 'train' end as split from orders join customer on o_custkey = c_custkey"


def q_split_three_way(spark, sf):
    return SP.three_way_split(H.housing_totals(spark, sf).select("row_key"), seed=42)


SQL_SP2 = (f"select o_orderkey as row_key, case when {h8('o_orderkey', repr('42'))} < {hexcut(0.15)} then 'test' "
           f"when {h8('o_orderkey', repr('42'))} < {hexcut(0.15 + 0.85 * 0.176)} then 'val' else 'train' end as split "
           "from orders join customer on o_custkey = c_custkey")


def q_kfold(spark, sf):
    return SP.kfold(H.housing_totals(spark, sf).select("row_key"), k=5, seed=42)


SQL_SP3 = (f"select o_orderkey as row_key, cast(least(floor({uni(h8('o_orderkey', repr('42')))} * 5), 4) as integer) "
           "as fold from orders join customer on o_custkey = c_custkey")



def q_split_exact(spark, sf):
    """SP1 with exact sizes: ceil(0.2 n) test rows."""
    return SP.exact_train_test_split(H.housing_totals(spark, sf).select("row_key"), test_size=0.2, seed=42)


def q_split_three_way_exact(spark, sf):
    """SP2 with exact sizes: ceil(0.15 n) test rows, ceil(0.176 of the rest) validation rows."""
    return SP.exact_three_way_split(H.housing_totals(spark, sf).select("row_key"), seed=42)


def q_kfold_exact(spark, sf):
    """SP3 with exact sizes: seven folds that differ by at most one row."""
    return SP.exact_kfold(H.housing_totals(spark, sf).select("row_key"), k=7, seed=42)


_RANKED = (f"with r as (select o_orderkey as row_key, count(*) over () as n, "
           f"row_number() over (order by {h8('o_orderkey', repr('42'))}, o_orderkey) as i "
           f"from orders join customer on o_custkey = c_custkey)")
SQL_SP1_EXACT = _RANKED + " select row_key, case when i <= ceil(n * 2 / 10.0) then 'test' else 'train' end as split from r"
SQL_SP2_EXACT = (_RANKED + ", s as (select *, cast(ceil(n * 15 / 100.0) as bigint) as t from r) select row_key, "
                 "case when i <= t then 'test' when i <= t + ceil((n - t) * 176 / 1000.0) then 'val' else 'train' end as split from s")
SQL_SP3_EXACT = (_RANKED + " select row_key, cast(case when i <= (n % 7) * (n // 7 + 1) then (i - 1) // (n // 7 + 1) "
                 "else (i - 1 - n % 7) // (n // 7) end as integer) as fold from r")


def q_csv_quarantine(spark, sf):
    """A CSV with ragged lines, words for numbers and missing values, split into valid and rejected rows."""
    from sylvan.session import scratch_path
    from sylvan.sources.io import read_csv_checked
    path = scratch_path(spark, "dirty-csv")
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    k, price = F.col("o_orderkey").cast("string"), F.col("o_totalprice").cast("double").cast("string")
    line = (F.when(F.col("o_orderkey") % 50 == 1, k)
            .when(F.col("o_orderkey") % 51 == 2, F.concat_ws(",", k, price, F.col("o_custkey"), F.lit("more")))
            .when(F.col("o_orderkey") % 53 == 3, F.concat_ws(",", k, F.lit("abc"), F.col("o_custkey")))
            .when(F.col("o_orderkey") % 59 == 4, F.concat_ws(",", k, F.lit(""), F.col("o_custkey")))
            .when(F.col("o_orderkey") % 61 == 5, F.concat_ws(",", k, price, F.lit("")))
            .otherwise(F.concat_ws(",", k, price, F.col("o_custkey"))))
    orders.select(line.alias("row_key,price,customer")).write.option("header", True).option(
        "quote", "").option("sep", "\x01").csv(path)
    good, bad = read_csv_checked(spark, path, "row_key long, price double, customer double",
                                 feature_cols=["price"], target="customer")
    key = F.coalesce(F.split("line", ",").getItem(0).cast("long"), "row_key")
    return good.select("row_key", F.lit("").alias("reasons")).unionByName(
        bad.select(key.alias("row_key"), F.concat_ws("+", "reasons").alias("reasons")))


SQL_CSV_QUARANTINE = ("select o_orderkey as row_key, case when o_orderkey % 50 = 1 or o_orderkey % 51 = 2 or o_orderkey % 53 = 3 "
                      "then 'unreadable' when o_orderkey % 59 = 4 then 'missing_price' when o_orderkey % 61 = 5 "
                      "then 'missing_target' else '' end as reasons from orders")

N_BAG = 5


def q_bootstrap_weights(spark, sf):
    return SP.bootstrap_weights(H.housing_totals(spark, sf).select("row_key"), N_BAG, seed=42) \
        .select("row_key", "tree_id", "w")


SQL_SP4 = (f"select o_orderkey as row_key, cast(t.range as integer) as tree_id, "
           f"{poisson(h8('o_orderkey', repr('42'), 't.range'))} as w "
           f"from orders join customer on o_custkey = c_custkey cross join range({N_BAG}) t")


def q_oob_rows(spark, sf):
    return SP.oob_rows(H.housing_totals(spark, sf).select("row_key"), N_BAG, seed=42).select("row_key", "tree_id")




def q_bootstrap_exact(spark, sf):
    """SP4: n draws of n rows for every tree."""
    return SP.exact_bootstrap_weights(H.housing_totals(spark, sf).select("row_key"), N_BAG, seed=42)


SQL_SP4_EXACT = f"""with h as ({HOUSING_SQL}),
r as (select row_key, row_number() over (order by {h8('row_key', repr('42'))}, row_key) - 1 as k from h),
t as (select cast(unnest(range({N_BAG})) as integer) as tree_id),
d as (select tree_id, cast(floor(cast(concat('0x', substr(md5(concat_ws('|', '42', 'draw', cast(tree_id as varchar),
      cast(k as varchar))), 1, 13)) as bigint) / {2.0 ** 52!r} * cast((select count(*) from h) as double)) as bigint) as k
      from r cross join t),
c as (select tree_id, k, cast(count(*) as integer) as w from d group by tree_id, k)
select row_key, t.tree_id, coalesce(w, 0) as w from r cross join t left join c on c.tree_id = t.tree_id and c.k = r.k"""
SQL_SP5 = f"select row_key, tree_id from ({SQL_SP4}) where w = 0"

# ---- the learner -----------------------------------------------------------------

FOREST = dict(n_trees=4, max_depth=2, min_samples_split=10, min_samples_leaf=5, max_features="sqrt", seed=42)
STUMP = dict(n_trees=1, max_depth=1, min_samples_split=2, min_samples_leaf=1, max_features=None,
             seed=7, bootstrap=False)
NODE_STEPS = {"value": 0.0141421356237, "mse": 141.421356237}
FOREST_DEEP = dict(n_trees=3, max_depth=8, min_samples_split=4, min_samples_leaf=2, max_features="sqrt", seed=3)
FOREST_BINNED = dict(n_trees=3, max_depth=4, min_samples_split=10, min_samples_leaf=5, max_features="sqrt",
                     seed=42, max_bins=64)
FOREST_BUCKETED = dict(n_trees=3, max_depth=4, min_samples_split=10, min_samples_leaf=5, max_features="sqrt",
                       seed=11, prefix_buckets=6)
_MODELS: dict = {}


def fitted(spark, sf, which: str = "forest"):
    """The registered forest / stump fitted on the housing frame (cached
    per session and folder, because several queries score one model)."""
    key = (id(spark), sf, which)
    if key not in _MODELS:
        params = ForestParams(**(STUMP if which == "stump" else FOREST))
        h = H.housing_totals(spark, sf)
        if which == "train":
            h = SP.train_test_split(h, seed=42).where(F.col("split") == "train").drop("split")
        _MODELS[key] = fit_forest(h, TOT, Y, params)
    return _MODELS[key]


def _forest_sql(cfg: dict, source: str = "h") -> list:
    m = SP.resolve_max_features(cfg.get("max_features", "sqrt"), len(TOT))
    splitter = cfg.get("splitter", "best")
    draws = cfg.get("max_candidates", 10) if splitter == "random" else cfg.get("max_attempts", 100)
    return OF.forest_ctes(TOT, Y, source, cfg["n_trees"], cfg["max_depth"], cfg.get("min_samples_split", 2),
                          cfg.get("min_samples_leaf", 1), m, cfg["seed"], cfg.get("bootstrap", True),
                          splitter, draws, bins=cfg.get("max_bins"))


NODE_ROUND = {"threshold": 6, "value": 4, "mse": 1}


def _leaf_codes(df: DataFrame) -> DataFrame:
    """Leaves carry -1 for feature and child ids (NULL in the node table)."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(-1)) for c in ("feature", "left_id", "right_id")})


def q_forest_fit(spark, sf):
    """The whole node table of the bagged forest."""
    return _leaf_codes(rnd(fitted(spark, sf).nodes_df(spark), NODE_ROUND))


def _stepped_nodes(spark, model) -> DataFrame:
    return _stepped(model.nodes_df(spark))


def _stepped(nodes: DataFrame) -> DataFrame:
    """The node table with means and errors in steps that no mean of a few
    prices is a half multiple of."""
    grid = {c: F.floor(F.col(c) / step + 0.5) for c, step in NODE_STEPS.items()}
    return _leaf_codes(rnd(nodes.withColumns(grid), {"threshold": 6}))


def q_forest_fit_levelwise(spark, sf):
    """T8 / T9 eight levels deep."""
    return _stepped_nodes(spark, fit_forest(H.housing_totals(spark, sf), TOT, Y, ForestParams(**FOREST_DEEP)))


def q_forest_fit_node_table(spark, sf):
    """T8 / T9 with the nodes kept as a table: upper levels together, small nodes finished in groups."""
    from sylvan.operators.node_table import fit_node_table
    table = fit_node_table(H.housing_totals(spark, sf), TOT, Y, ForestParams(**FOREST_DEEP), local_rows=2000)
    return _stepped(table.nodes)


def q_forest_fit_streamed(spark, sf):
    """T3 over sorted streams: prefix sums carried from partition to partition, no key's values in one cell."""
    params = ForestParams(**FOREST_DEEP, streamed=True)
    return _stepped_nodes(spark, fit_forest(H.housing_totals(spark, sf), TOT, Y, params))


def q_forest_fit_bucketed(spark, sf):
    """T3 with every feature split into value buckets (the search of very large inputs)."""
    return _stepped_nodes(spark, fit_forest(H.housing_totals(spark, sf), TOT, Y, ForestParams(**FOREST_BUCKETED)))


def missing_values(spark, sf) -> DataFrame:
    """The housing frame with NaN, infinities and NULL in two features and
    in the target of some rows (by key, so that SQL can state the same)."""
    h = H.housing_totals(spark, sf)
    a, b = F.col(TOT[0]).cast("double"), F.col(TOT[1]).cast("double")
    k = F.col("row_key")
    return h.withColumns({
        TOT[0]: F.when(k % 7 == 0, F.lit(float("nan"))).when(k % 11 == 0, F.lit(float("inf"))).otherwise(a),
        TOT[1]: F.when(k % 5 == 0, F.lit(None).cast("double")).when(k % 13 == 0, F.lit(float("-inf"))).otherwise(b),
        Y: F.when(k % 17 == 0, F.lit(float("nan"))).otherwise(F.col(Y))})


def q_forest_fit_missing(spark, sf):
    """T9 / P11 on rows with missing, NaN and infinite values: features
    without a value go right, rows without a target are left out."""
    return _stepped_nodes(spark, fit_forest(missing_values(spark, sf), TOT, Y, ForestParams(**FOREST_MISSING)))


FOREST_MISSING = dict(n_trees=3, max_depth=4, min_samples_split=10, min_samples_leaf=5, max_features="sqrt", seed=5)


def _fsql(body: str, cfg=FOREST, more: list = (), train_only: bool = False) -> str:
    side = [f"tr as (select * from h where not ({h8('row_key', repr('42'))} < {hexcut(0.2)}))"] if train_only else []
    ctes = [f"h as ({HOUSING_SQL})"] + side + _forest_sql(cfg, "tr" if train_only else "h") + list(more)
    return "with " + ",\n".join(ctes) + "\n" + body


SQL_NODES = ("select tree_id, node_id, depth, coalesce(feature, -1) as feature, round(threshold, 6) as threshold, "
             "coalesce(left_id, -1) as left_id, coalesce(right_id, -1) as right_id, "
             "round(value, 4) as value, n, round(mse, 1) as mse, is_leaf from nodes")

SQL_FOREST_FIT = _fsql(SQL_NODES)
SQL_STEPPED = (SQL_NODES.replace("round(value, 4)", f"cast(floor(value / cast({NODE_STEPS['value']} as double) + 0.5) as bigint)")
               .replace("round(mse, 1)", f"cast(floor(mse / cast({NODE_STEPS['mse']} as double) + 0.5) as bigint)"))
SQL_FOREST_DEEP = _fsql(SQL_STEPPED, FOREST_DEEP)
SQL_FOREST_BUCKETED = _fsql(SQL_STEPPED, FOREST_BUCKETED)
SQL_FOREST_BINNED = _fsql(SQL_STEPPED, FOREST_BINNED)
SQL_FOREST_MISSING = _fsql(SQL_STEPPED, FOREST_MISSING).replace(
    f"h as ({HOUSING_SQL})",
    f"h0 as ({HOUSING_SQL}), h as (select * replace ("
    f"case when row_key % 7 = 0 or row_key % 11 = 0 then null else {TOT[0]} end as {TOT[0]}, "
    f"case when row_key % 5 = 0 or row_key % 13 = 0 then null else {TOT[1]} end as {TOT[1]}, "
    f"case when row_key % 17 = 0 then null else {Y} end as {Y}) from h0)")


def q_forest_fit_binned(spark, sf):
    """T3 over global quantile bins (``max_bins``)."""
    return _stepped_nodes(spark, fit_forest(H.housing_totals(spark, sf), TOT, Y, ForestParams(**FOREST_BINNED)))


def q_best_split(spark, sf):
    """Root split of a single unbagged tree over all features."""
    return rnd(fitted(spark, sf, "stump").nodes_df(spark).where(F.col("depth") == 0)
               .select("feature", "threshold", "n", "value", "mse"), NODE_ROUND)


SQL_BEST_SPLIT = _fsql("select feature, round(threshold, 6) as threshold, n, round(value, 4) as value, "
                       "round(mse, 1) as mse from nodes where depth = 0", STUMP)


def q_best_split_bootstrap(spark, sf):
    """Root split of every bagged tree (T3 with Poisson weights, SP7 subsets)."""
    return rnd(fitted(spark, sf).nodes_df(spark).where(F.col("depth") == 0)
               .select("tree_id", "feature", "threshold", "n"), {"threshold": 6})


SQL_BEST_SPLIT_BOOT = _fsql("select tree_id, feature, round(threshold, 6) as threshold, n from nodes "
                            "where depth = 0")


def q_node_stats(spark, sf):
    """Weighted node size, mean and MSE of every node of the forest."""
    return rnd(fitted(spark, sf).nodes_df(spark).select("tree_id", "node_id", "n", "value", "mse"),
               {"value": 4, "mse": 1})


SQL_NODE_STATS = _fsql("select tree_id, node_id, n, round(value, 4) as value, round(mse, 1) as mse from nodes")


def q_feature_subset(spark, sf):
    """SP7 for every internal node of the fitted forest."""
    nodes = fitted(spark, sf).nodes_df(spark).where(~F.col("is_leaf")).select("tree_id", "node_id")
    sub = SP.feature_subsets(nodes, len(TOT), SP.resolve_max_features("sqrt", len(TOT)), seed=42)
    return sub.select("tree_id", "node_id", F.explode("features").alias("feature"))


SQL_FEATURE_SUBSET = _fsql(
    "select * from (" + subset_sql("select tree_id, node_id from nodes where not is_leaf", len(TOT), 2, 42) + ")")

ROWS_SQL = "select row_key, " + ", ".join(f"cast({c} as double) as x{i}" for i, c in enumerate(TOT)) + " from h"


def q_stump_predict(spark, sf):
    m = fitted(spark, sf, "stump")
    p = SC.predict(H.housing_totals(spark, sf).select("row_key", *TOT), m)
    return rnd(p.select("row_key", "prediction"), {"prediction": 4})


SQL_STUMP_PREDICT = _fsql("select row_key, round(p, 4) as prediction from pt", STUMP,
                          OF.predict_ctes(ROWS_SQL, len(TOT), 1, 1))


def q_tree_predict(spark, sf):
    m = fitted(spark, sf)
    p = SC.predict_tree(H.housing_totals(spark, sf).select("row_key", *TOT), m, 2)
    return rnd(p.select("row_key", "prediction"), {"prediction": 4})


SQL_TREE_PREDICT = _fsql("select row_key, round(p, 4) as prediction from pt where tree_id = 2", FOREST,
                         OF.predict_ctes(ROWS_SQL, len(TOT), FOREST["n_trees"], FOREST["max_depth"]))


def q_forest_predict(spark, sf):
    p = SC.predict(H.housing_totals(spark, sf).select("row_key", *TOT), fitted(spark, sf))
    return rnd(p.select("row_key", "prediction"), {"prediction": 4})


_PT = OF.predict_ctes(ROWS_SQL, len(TOT), FOREST["n_trees"], FOREST["max_depth"])
SQL_FOREST_PREDICT = _fsql("select row_key, round(avg(p), 4) as prediction from pt group by row_key",
                           FOREST, _PT)


def q_predict_uncertainty(spark, sf):
    p = SC.predict(H.housing_totals(spark, sf).select("row_key", *TOT), fitted(spark, sf), uncertainty=True)
    return rnd(p.select("row_key", "prediction", "uncertainty"), {"prediction": 4, "uncertainty": 4})


SQL_PREDICT_UNC = _fsql("select row_key, round(avg(p), 4) as prediction, round(stddev_pop(p), 4) as uncertainty "
                        "from pt group by row_key", FOREST, _PT)


def q_predict_interval(spark, sf):
    p = SC.predict(H.housing_totals(spark, sf).select("row_key", *TOT), fitted(spark, sf), uncertainty=True)
    iv = SC.prediction_interval(p, confidence_level=0.95)
    return rnd(iv.select("row_key", F.col("interval.lower").alias("lower"),
                         F.col("interval.upper").alias("upper")), {"lower": 3, "upper": 3})


Z95 = SC.z_value(0.95)
SQL_PREDICT_INTERVAL = _fsql(
    f"select row_key, round(avg(p) - {Z95!r} * stddev_pop(p), 3) as lower, "
    f"round(avg(p) + {Z95!r} * stddev_pop(p), 3) as upper from pt group by row_key", FOREST, _PT)


def q_feature_importance(spark, sf):
    imp = MS.forest_importances(fitted(spark, sf).nodes_df(spark), len(TOT))
    return rnd(MS.named_importances(imp, TOT), {"importance": 6})


SQL_IMPORTANCE = _fsql("select f.feature, round(importance, 6) as importance, n.feature_name from fimp f "
                       "join (select cast(range as integer) as feature, ["
                       + ", ".join(f"'{c}'" for c in TOT) + "][range + 1] as feature_name from range("
                       + str(len(TOT)) + ")) n using (feature)", FOREST, OF.importance_ctes(len(TOT)))


def q_top_features(spark, sf):
    imp = MS.forest_importances(fitted(spark, sf).nodes_df(spark), len(TOT))
    return rnd(MS.top_features(imp, 3), {"importance": 6})


SQL_TOP = _fsql("select feature, round(importance, 6) as importance from fimp "
                "order by importance desc, feature limit 3", FOREST, OF.importance_ctes(len(TOT)))


def q_tree_stats(spark, sf):
    return MS.tree_stats(fitted(spark, sf).nodes_df(spark))


SQL_TREE_STATS = _fsql("select tree_id, max(depth) as depth, count(*) filter (where is_leaf) as n_leaves, "
                       "count(*) as n_nodes from nodes group by tree_id")


def q_tree_rules(spark, sf):
    r = MS.tree_rules(fitted(spark, sf).nodes_df(spark), TOT)
    return rnd(r, {"value": 4})


def _sql_rules():
    names = "[" + ", ".join(f"'{c}'" for c in TOT) + "]"
    body = f"""rl0 as (select tree_id, node_id, '' as path from nodes where depth = 0),
rl1 as (select n.tree_id, n.left_id as node_id, {names}[n.feature + 1] || ' <= ' || printf('%.9f', n.threshold) as path
        from rl0 r join nodes n using (tree_id, node_id) where not n.is_leaf
        union all
        select n.tree_id, n.right_id, {names}[n.feature + 1] || ' > ' || printf('%.9f', n.threshold)
        from rl0 r join nodes n using (tree_id, node_id) where not n.is_leaf),
rl2 as (select n.tree_id, n.left_id as node_id, r.path || ' AND ' || {names}[n.feature + 1] || ' <= ' || printf('%.9f', n.threshold)
        from rl1 r join nodes n using (tree_id, node_id) where not n.is_leaf
        union all
        select n.tree_id, n.right_id, r.path || ' AND ' || {names}[n.feature + 1] || ' > ' || printf('%.9f', n.threshold)
        from rl1 r join nodes n using (tree_id, node_id) where not n.is_leaf),
rl as (select * from rl0 union all select * from rl1 union all select * from rl2)"""
    return _fsql("select n.tree_id, n.node_id, n.depth, case when r.path = '' then 'TRUE' else r.path end as rule, "
                 "n.n, round(n.value, 4) as value from nodes n join rl r using (tree_id, node_id) where n.is_leaf",
                 FOREST, [body])


def q_oob_score(spark, sf):
    m = fitted(spark, sf)
    p = SC.predict(H.housing_totals(spark, sf).select("row_key", *TOT, Y), m, oob=True)
    cov = p.where(F.col("oob_count") > 0)
    met = M.regression_metrics(cov, Y, "oob_prediction")
    return rnd(met.select(F.col("n").alias("n_covered"), F.col("r2_score").alias("oob_score")),
               {"oob_score": 6})


SQL_OOB = _fsql(
    "select count(*) as n_covered, round(case when var_pop(y) > 0 then 1 - avg((y - op) * (y - op)) / var_pop(y) "
    "else 0 end, 6) as oob_score from (select pt.row_key, avg(pt.p) as op, any_value(fx.y) as y from pt "
    f"join fx using (row_key) where {poisson(h8('pt.row_key', repr('42'), 'pt.tree_id'))} = 0 "
    "group by pt.row_key)", FOREST,
    OF.predict_ctes(ROWS_SQL, len(TOT), FOREST["n_trees"], FOREST["max_depth"]))


# ---- metrics ------------------------------------------------------------------------

MET_COLS = {"mse": 2, "rmse": 6, "mae": 6, "mape": 9, "r2_score": 9, "explained_variance": 9,
            "max_error": 6, "median_ae": 6, "smape": 9}


def q_metrics_all(spark, sf):
    m = M.regression_metrics(H.prediction_pairs(spark, sf), n_features=8)
    return rnd(m, {**MET_COLS, "adjusted_r2": 9})


SQL_METRICS_ALL = with_frames(
    "select n, " + ", ".join(f"round({c}, {d}) as {c}" for c, d in MET_COLS.items())
    + ", round(case when n <= 9 then 'nan'::double else 1 - (1 - r2_score) * (n - 1) / (n - 8 - 1) end, 9) "
      "as adjusted_r2 from met", pred=True, extra=_sql_metrics_body("pf", ""))


def q_metrics_requested(spark, sf):
    m = M.regression_metrics(_model_preds(spark, sf), group_cols=["model"])
    lg = M.metrics_long(m, ["model"], ["r2_score", "mae", "rmse"])
    return rnd(lg, {"value": 6})


SQL_METRICS_REQ = with_frames(
    "select model, metric, round(value, 6) as value from met "
    "unpivot (value for metric in (r2_score, mae, rmse))",
    pred=True, extra=SQL_MODEL_PREDS + ",\n" + _sql_metrics_body("mp", "model"))


def q_residual_stats(spark, sf):
    r = M.residual_statistics(H.prediction_pairs(spark, sf))
    return rnd(r, {c: 6 for c in r.columns})


SQL_RESID = with_frames("""select round(mean, 6) as mean, round(std, 6) as std, round(mn, 6) as min,
  round(mx, 6) as max, round(med, 6) as median, round(q25, 6) as q25, round(q75, 6) as q75,
  round(q75 - q25, 6) as iqr,
  round(case when std = 0 then 0 else m3 / (std * std * std) end, 6) as skewness,
  round(case when std = 0 then 0 else m4 / (std * std * std * std) - 3 end, 6) as kurtosis
from (select avg(r) as mean, stddev_pop(r) as std, min(r) as mn, max(r) as mx,
        quantile_cont(r, 0.5) as med, quantile_cont(r, 0.25) as q25, quantile_cont(r, 0.75) as q75,
        avg(power(r - mu, 3)) as m3, avg(power(r - mu, 4)) as m4
      from (select y - p as r, avg(y - p) over () as mu from pf))""", pred=True)


def q_compare_models(spark, sf):
    m = M.compare_models(_model_preds(spark, sf), baseline="model_4")
    return rnd(m, {**MET_COLS, "improvement_pct": 6})


SQL_COMPARE = with_frames(
    "select model, n, " + ", ".join(f"round({c}, {d}) as {c}" for c, d in MET_COLS.items())
    + ", round((r2_score - (select r2_score from met where model = 'model_4')) / "
      "abs((select r2_score from met where model = 'model_4')) * 100, 6) as improvement_pct from met",
    pred=True, extra=SQL_MODEL_PREDS + ",\n" + _sql_metrics_body("mp", "model"))


def q_best_model(spark, sf):
    m = M.regression_metrics(_model_preds(spark, sf), group_cols=["model"])
    best = m.agg(F.max_by("model", "r2_score").alias("model"), F.max("r2_score").alias("r2_score"))
    return rnd(best, {"r2_score": 9})


SQL_BEST_MODEL = with_frames("select arg_max(model, r2_score) as model, round(max(r2_score), 9) as r2_score from met",
                             pred=True, extra=SQL_MODEL_PREDS + ",\n" + _sql_metrics_body("mp", "model"))


def q_models_meeting_target(spark, sf):
    m = M.regression_metrics(_model_preds(spark, sf), group_cols=["model"])
    ok = m.where(F.col("r2_score") >= 0.8)
    cnt = ok.agg(F.count(F.lit(1)).alias("n_meeting"))
    return rnd(ok.select("model", "r2_score").withColumn("_k", F.lit(0))
               .join(cnt.withColumn("_k", F.lit(0)), "_k").drop("_k"), {"r2_score": 9})


SQL_MEETING = with_frames("select model, round(r2_score, 9) as r2_score, "
                          "(select count(*) from met where r2_score >= 0.8) as n_meeting from met "
                          "where r2_score >= 0.8",
                          pred=True, extra=SQL_MODEL_PREDS + ",\n" + _sql_metrics_body("mp", "model"))


def q_target_stats(spark, sf):
    return rnd(M.target_statistics(H.housing_totals(spark, sf), Y, "ocean_proximity"),
               {"y_mean": 6})


SQL_TARGET_STATS = with_frames(f"select count(*) as n, min({Y}) as y_min, max({Y}) as y_max, "
                               f"round(avg({Y}), 6) as y_mean, count(distinct ocean_proximity) as n_classes from h")


def q_union_splits(spark, sf):
    """K6: train and test parts back together (UNION ALL by name)."""
    s = SP.train_test_split(H.housing_totals(spark, sf).select("row_key", Y), seed=42)
    tr = s.where(F.col("split") == "train")
    te = s.where(F.col("split") == "test")
    return tr.unionByName(te)


SQL_UNION = with_frames(f"select row_key, {Y}, case when {h8('row_key', repr('42'))} < {hexcut(0.2)} "
                        "then 'test' else 'train' end as split from h")


def q_first_predictions(spark, sf):
    """K5: first n sample predictions ordered by row key (a report limit)."""
    p = SC.predict(H.housing_totals(spark, sf).select("row_key", *TOT, Y), fitted(spark, sf))
    return rnd(p.orderBy("row_key").limit(10).select("row_key", F.col(Y).alias("y"), "prediction"),
               {"prediction": 4})


SQL_FIRST = _fsql(f"select row_key, fx.y as y, round(avg(p), 4) as prediction from pt join fx using (row_key) "
                  "group by row_key, fx.y order by row_key limit 10", FOREST, _PT)


def q_grid(spark, sf):
    """G1 grid: 3 x 3 x 3 x 3 settings with a stable setting id, each
    joined with the training split it will be fitted on: training rows
    and the most leaves the setting can grow there
    (min(2^max_depth, floor(n_train / min_samples_leaf)))."""
    from sylvan.operators.cv import param_grid
    grid = param_grid(spark, {"n_trees": [50, 100, 150], "max_depth": [10, 15, 20],
                              "min_samples_split": [2, 5, 10], "min_samples_leaf": [1, 2, 4]})
    n_train = (SP.train_test_split(H.housing_totals(spark, sf).select("row_key"), seed=42)
               .where(F.col("split") == "train").agg(F.count(F.lit(1)).alias("n_train")))
    # one-row table of the split size attached by a constant key (broadcast, 1 row)
    g = (grid.withColumn("_k", F.lit(0))
             .join(F.broadcast(n_train.withColumn("_k", F.lit(0))), "_k").drop("_k"))
    return g.withColumn("max_leaves", F.least(F.pow(F.lit(2), F.col("max_depth")).cast("bigint"),
                                              F.floor(F.col("n_train") / F.col("min_samples_leaf"))))


SQL_GRID = f"""select s.*, t.n_train, least(cast(pow(2, s.max_depth) as bigint),
  cast(floor(t.n_train / s.min_samples_leaf) as bigint)) as max_leaves
from (select cast(row_number() over (order by a, b, c, d) - 1 as integer) as setting_id,
  a as n_trees, b as max_depth, c as min_samples_split, d as min_samples_leaf
from (select unnest([50, 100, 150]) as a) cross join (select unnest([10, 15, 20]) as b)
cross join (select unnest([2, 5, 10]) as c) cross join (select unnest([1, 2, 4]) as d)) s
cross join (select count(*) as n_train from orders join customer on o_custkey = c_custkey
            where {h8('o_orderkey', repr('42'))} >= {hexcut(0.2)}) t"""


def q_model_list(spark, sf):
    """Store the fitted forest and list the store."""
    from sylvan.session import scratch_path
    store = scratch_path(spark, "models")
    m = fitted(spark, sf)
    MS.save_model(spark, m, store)
    lst = MS.list_models(spark, store)
    return rnd(lst.select("n_features", "n_samples", "n_trees", "avg_depth", "avg_leaves", "total_nodes"),
               {"avg_depth": 6, "avg_leaves": 6})


SQL_MODEL_LIST = _fsql("select 8 as n_features, (select count(*) from fx) as n_samples, count(*) as n_trees, "
                       "round(avg(depth), 6) as avg_depth, round(avg(n_leaves), 6) as avg_leaves, "
                       "cast(sum(2 * n_leaves - 1) as bigint) as total_nodes from (select tree_id, max(depth) as depth, "
                       "count(*) filter (where is_leaf) as n_leaves from nodes group by tree_id)")


def q_model_roundtrip(spark, sf):
    """Save, load, score again; predictions must equal the original."""
    from sylvan.session import scratch_path
    store = scratch_path(spark, "roundtrip")
    m = fitted(spark, sf)
    MS.save_model(spark, m, store)
    MS.save_model(spark, m, store)                    # a second save replaces the first
    back = MS.load_model(spark, store, m.model_id)
    p = SC.predict(H.housing_totals(spark, sf).select("row_key", *TOT), back)
    return rnd(p.select("row_key", "prediction"), {"prediction": 4})


# ---- rows-only (iterative or stochastic fits) ---------------------------------------------

RANDOM = dict(n_trees=4, max_depth=3, min_samples_leaf=5, splitter="random", seed=42)
EXTRA = dict(n_trees=4, max_depth=3, min_samples_leaf=5, splitter="extra", seed=42)


def q_random_split(spark, sf):
    """T4: forest grown with the random splitter (best of <= 10 hash draws)."""
    m = fit_forest(H.housing_totals(spark, sf), TOT, Y, ForestParams(**RANDOM))
    return _leaf_codes(rnd(m.nodes_df(spark), NODE_ROUND))


def q_extra_random_split(spark, sf):
    """T5: forest grown with the extra-random splitter (first valid draw)."""
    m = fit_forest(H.housing_totals(spark, sf), TOT, Y, ForestParams(**EXTRA))
    return _leaf_codes(rnd(m.nodes_df(spark), NODE_ROUND))


class MeanSplitter:
    """A splitter written against the protocol alone: in each node the feature that
    correlates best with the target, cut at its mean (down to three decimals)."""

    def best_splits(self, level):
        w, v, y = F.col("w"), F.col("v"), F.col("yc")
        moments = level.long().groupBy("slot", "feature").agg(
            F.sum(w).alias("n"), F.sum(w * v).alias("sx"), F.sum(w * y).alias("sy"), F.sum(w * v * v).alias("xx"),
            F.sum(w * v * y).alias("xy"), F.min("v").alias("low"), F.max("v").alias("high")).where("low < high")
        rank = -F.pow(F.expr("xy - sx * sy / n"), 2) / F.expr("xx - sx * sx / n")
        best = moments.withColumn("rank", rank).groupBy("slot").agg(F.min(F.struct(
            "rank", "feature", F.expr("floor(sx / n * 1000) / 1000").alias("threshold"))).alias("b"))
        return best.select("slot", "b.feature", "b.threshold")


CUSTOM = dict(n_trees=4, max_depth=4, min_samples_leaf=5, seed=42)


def q_custom_splitter(spark, sf):
    """Section 2.13: a forest grown by a splitter from outside the library."""
    m = fit_forest(H.housing_totals(spark, sf), TOT, Y, ForestParams(**CUSTOM, splitter=MeanSplitter()))
    return _leaf_codes(rnd(m.nodes_df(spark), NODE_ROUND))


class LineEstimator:
    """An estimator written against the protocol alone: least squares on the first feature."""

    def fit(self, df, feature_cols, target):
        x, y = F.col(feature_cols[0]).cast("double"), F.col(target).cast("double")
        a, mx, my = df.select(x.alias("x"), y.alias("y")).dropna().agg(
            F.covar_pop("x", "y") / F.var_pop("x"), F.avg("x"), F.avg("y")).first()
        return FittedLine(feature_cols[0], a, my - a * mx)


class FittedLine:
    def __init__(self, feature, slope, start):
        self.feature, self.slope, self.start = feature, slope, start

    def predict(self, df):
        return df.withColumn("prediction", F.col(self.feature).cast("double") * self.slope + self.start)


def q_cross_validate_estimator(spark, sf):
    """Section 2.13 / M18: 4-fold CV of an estimator from outside the library."""
    from sylvan.operators.cv import cross_validate
    return rnd(cross_validate(H.housing_totals(spark, sf), TOT, Y, LineEstimator(), k=4), {"value": 4})


def _sql_cv_line():
    fold = f"cast(least(floor({uni(h8('row_key', repr('42')))} * 4), 3) as integer)"
    ctes = [f"h as (select *, {fold} as fold from ({HOUSING_SQL}))",
            f"line as (select f.range as fold, regr_slope({Y}, {TOT[0]}) as a, regr_intercept({Y}, {TOT[0]}) as b "
            f"from h join range(4) f on h.fold <> f.range group by all)",
            f"cvp as (select h.row_key, cast(h.{Y} as double) as y, h.{TOT[0]} * a + b as p, h.fold from h join line using (fold))",
            _sql_metrics_body("cvp", "fold")]
    return ("with " + ",\n".join(ctes) + "\nselect fold, metric, round(value, 4) as value from met "
            "unpivot (value for metric in (r2_score, rmse, mae))")


CV_K, CV_T, CV_DEPTH = 3, 5, 4


def q_cross_validate(spark, sf):
    """3-fold CV of a 5-tree forest (all folds grown in one fit)."""
    from sylvan.operators.cv import cross_validate
    res = cross_validate(H.housing_totals(spark, sf), TOT, Y,
                         ForestParams(n_trees=CV_T, max_depth=CV_DEPTH, min_samples_leaf=5, seed=42), k=CV_K)
    return rnd(res, {"value": 6})


def _sql_cv():
    fold = f"cast(least(floor({uni(h8('row_key', repr('42')))} * {CV_K}), {CV_K - 1}) as integer)"
    src = f"(select *, {fold} as fold from h)"
    ctes = [f"h as ({HOUSING_SQL})"] + OF.forest_ctes(
        TOT, Y, src, CV_K * CV_T, CV_DEPTH, 2, 5, 2, 42, True,
        mask=f"case when {fold.replace('row_key', 'fx.row_key')} = t.range // {CV_T} then 0 else 1 end")
    rows = ("select row_key, " + ", ".join(f"cast({c} as double) as x{i}" for i, c in enumerate(TOT))
            + " from h")
    ctes += OF.predict_ctes(rows, len(TOT), CV_K * CV_T, CV_DEPTH)
    ctes += [f"cvp as (select pt.row_key, any_value(fx.y) as y, avg(pt.p) as p, "
             f"any_value({fold.replace('row_key', 'pt.row_key')}) as fold from pt join fx using (row_key) "
             f"where pt.tree_id // {CV_T} = {fold.replace('row_key', 'pt.row_key')} group by pt.row_key)",
             _sql_metrics_body("cvp", "fold")]
    return ("with " + ",\n".join(ctes) + "\nselect fold, metric, round(value, 6) as value from met "
            "unpivot (value for metric in (r2_score, rmse, mae))")


GRID_SMALL = {"n_trees": [3, 6], "max_depth": [2, 4], "min_samples_split": [10, 40], "min_samples_leaf": [5, 15]}


def q_grid_search(spark, sf):
    """G1: validation R^2 of a 2 x 2 x 2 x 2 grid; one fit per
    (min_split, min_leaf), smaller settings scored as prefixes / cuts."""
    from sylvan.operators.cv import grid_search
    h = SP.three_way_split(H.housing_totals(spark, sf), seed=42)
    res = grid_search(h.where(F.col("split") == "train"), h.where(F.col("split") == "val"), TOT, Y,
                      GRID_SMALL, seed=42)
    return rnd(res, {"r2_score": 6})


def _sql_grid():
    """One nested query per (min_split, min_leaf) pair."""
    return " union all ".join(f"select * from ({_sql_grid_pair(a, b)})" for a in GRID_SMALL["min_samples_split"]
                              for b in GRID_SMALL["min_samples_leaf"])


def _sql_grid_pair(mss: int, msl: int):
    hh = h8("row_key", repr("42"))
    split = (f"case when {hh} < {hexcut(0.15)} then 'test' when {hh} < {hexcut(0.15 + 0.85 * 0.176)} "
             f"then 'val' else 'train' end")
    src = f"(select * from (select *, {split} as split from h) where split = 'train')"
    ntr, dep = max(GRID_SMALL["n_trees"]), max(GRID_SMALL["max_depth"])
    ctes = [f"h as ({HOUSING_SQL})"] + OF.forest_ctes(TOT, Y, src, ntr, dep, mss, msl, 2, 42, True)
    val = ("select row_key, " + ", ".join(f"cast({c} as double) as x{i}" for i, c in enumerate(TOT))
           + f", cast({Y} as double) as y from (select *, {split} as split from h) where split = 'val'")
    parts = []
    for n in GRID_SMALL["n_trees"]:
        for d in GRID_SMALL["max_depth"]:
            pre = f"g{n}_{d}_"
            ctes += OF.predict_ctes(val, len(TOT), n, d, prefix=pre)
            parts.append(
                f"select {n} as n_trees, {d} as max_depth, {mss} as min_samples_split, {msl} as min_samples_leaf, "
                f"round(case when var_pop(y) > 0 then 1 - avg((y - pr) * (y - pr)) / var_pop(y) else 0 end, 6) "
                f"as r2_score from (select v.row_key, any_value(v.y) as y, avg(t.p) as pr from {pre}pt t "
                f"join ({val}) v using (row_key) group by v.row_key)")
    return "with " + ",\n".join(ctes) + "\n" + " union all ".join(parts)


def q_stream_score(spark, sf):
    from sylvan.streaming.score_stream import stream_score_available_now
    return rnd(stream_score_available_now(spark, H.housing_totals(spark, sf).select("row_key", *TOT),
                                          fitted(spark, sf)).select("row_key", "prediction", "uncertainty"),
               {"prediction": 4, "uncertainty": 4})


SQL_STREAM = _fsql("select row_key, round(avg(p), 4) as prediction, round(stddev_pop(p), 4) as uncertainty "
                   "from pt group by row_key", FOREST, _PT)


def _preset_round(df: DataFrame) -> DataFrame:
    """mse is ~1e8: 2 decimals; the other metrics: 6 decimals."""
    return df.withColumn("value", F.when(F.col("metric") == "mse", F.round("value", 2))
                                   .otherwise(F.round("value", 6)))


def q_preset_quick(spark, sf):
    """G4 'quick' preset end to end (20 trees, depth 12, split 5, leaf 2):
    metrics of the held-out split."""
    from sylvan.plans.presets import run_preset
    return _preset_round(run_preset(spark, sf, "quick"))


# ---- more sources, projections and reports ---------------------------------------------

def q_prediction_sink(spark, sf):
    """Predictions with uncertainty written as CSV and read back."""
    from sylvan.session import scratch_path
    from sylvan.sources.io import read_csv, write_predictions
    p = SC.predict(H.housing_totals(spark, sf).select("row_key", *TOT), fitted(spark, sf), uncertainty=True)
    out = p.select("row_key", "prediction", "uncertainty")
    path = scratch_path(spark, "pred-sink")
    write_predictions(out, path, "csv")
    back = read_csv(spark, path, schema=out.schema)
    return rnd(back, {"prediction": 4, "uncertainty": 4})


def q_split_sink(spark, sf):
    """train/test rows (target included) written partitioned by split."""
    from sylvan.session import scratch_path
    from sylvan.sources.io import write_splits
    s = SP.train_test_split(H.housing_totals(spark, sf).select("row_key", *TOT, Y), seed=42)
    path = scratch_path(spark, "split-sink")
    write_splits(s, path)
    return spark.read.parquet(path).select("row_key", Y, "split")


def q_features_target_join(spark, sf):
    """Features and target kept apart are aligned by key (never by position)."""
    h = H.housing_totals(spark, sf)
    feats = P.ratio_features_totals(h).select("row_key", "rooms_per_household", "income_per_person")
    tgt = h.select("row_key", Y)
    return feats.join(tgt, "row_key", "inner")


SQL_S11 = with_frames(f"select row_key, {P3_SQL['rooms_per_household']} as rooms_per_household, "
                      f"{P3_SQL['income_per_person']} as income_per_person, {Y} from h")


def q_select_features(spark, sf):
    """P1 + P2: feature/target selection with a cast to double."""
    return P.select_features(H.housing_totals(spark, sf), Y, ["housing_median_age", "households", "population"])


SQL_P1 = with_frames(f"select row_key, cast(housing_median_age as double) as housing_median_age, "
                     f"cast(households as double) as households, cast(population as double) as population, "
                     f"cast({Y} as double) as {Y} from h")


def q_target_scaling(spark, sf):
    """Target held in units of 100,000 scaled back to dollars."""
    a = H.housing_averages(spark, sf).select("row_key", (F.col("target") / 100000).alias("target"))
    return P.scale_target(a, "target", 100000.0)


SQL_P14 = with_frames("select row_key, target / 100000 * 100000.0 as target from a", averages=True)


def q_residuals(spark, sf):
    """Residual column y - p."""
    return M.with_residual(H.prediction_pairs(spark, sf)).select("row_key", "residual")


SQL_P18 = with_frames("select row_key, y - p as residual from pf", pred=True)


def q_outlier_summary(spark, sf):
    """F2 report: number and share of z-score outliers."""
    return rnd(clean.outlier_summary(H.event_values(spark, sf), ["value"], 3.0), {"pct_outliers": 9})


SQL_F2_SUMMARY = """select count(*) filter (where abs((value - st.m) / (st.s + 1e-8)) > 3.0) as n_outliers,
  count(*) as n_rows,
  round(count(*) filter (where abs((value - st.m) / (st.s + 1e-8)) > 3.0) * 100.0 / count(*), 9) as pct_outliers
from events, (select avg(value) as m, stddev_pop(value) as s from events) st"""


def q_median_fill(spark, sf):
    """Ratio features (NULL on zero divisors) then exact-median fill of
    every numeric column, as in the balanced pipeline."""
    a = P.avg_features(H.housing_averages(spark, sf))
    cols = AVG + P.AVG_ENGINEERED
    return clean.median_fill(a, cols).select("row_key", *cols)


def _sql_median_fill():
    cols = AVG + P.AVG_ENGINEERED
    inner = "select row_key, " + ", ".join(AVG) + ", " + ", ".join(f"{e} as {c}" for c, e in P6_SQL.items()) + " from a"
    return with_frames("select row_key, " + ", ".join(
        f"coalesce({c}, (select median({c}) from e6)) as {c}" for c in cols) + " from e6",
        averages=True, extra=f"e6 as ({inner})")


def q_scale_except_codes(spark, sf):
    """Scale every feature except the categorical code."""
    h = H.housing_totals(spark, sf).select("row_key", *TOT, "ocean_proximity")
    h = clean.drop_missing(P.apply_label_encoder(h, P.fit_label_encoder(h, "ocean_proximity"), "ocean_proximity"))
    out = C.StandardScaler(TOT, sig_digits=10).fit_transform(h).drop("ocean_proximity")
    return rnd(out, {c: 7 for c in TOT})


def _sql_scale_codes():
    return with_frames("select row_key, " + ", ".join(f"round(({c} - m_{c}) / s_{c}, 7) as {c}" for c in TOT)
                       + ", cast(dense_rank() over (order by ocean_proximity) - 1 as integer) as ocean_proximity_code"
                       + f" from hc2 cross join ({std_stats(TOT, 'hc2')})",
                       extra="hc2 as (select * from h where total_bedrooms is not null)")


def q_model_score(spark, sf):
    """R^2 on the held-out split of a forest fitted on the train side."""
    te = SP.train_test_split(H.housing_totals(spark, sf), seed=42).where(F.col("split") == "test")
    p = SC.predict(te.select("row_key", Y, *TOT), fitted(spark, sf, "train"))
    return rnd(M.regression_metrics(p, Y, "prediction", with_median=False).select("n", "r2_score"), {"r2_score": 6})


_TEST_ROWS = ("select row_key, " + ", ".join(f"cast({c} as double) as x{i}" for i, c in enumerate(TOT))
              + f" from h where {h8('row_key', repr('42'))} < {hexcut(0.2)}")
SQL_MODEL_SCORE = _fsql(
    "select count(*) as n, round(case when var_pop(y) > 0 then 1 - avg((y - pr) * (y - pr)) / var_pop(y) "
    f"else 0 end, 6) as r2_score from (select pt.row_key, avg(p) as pr, any_value(h.{Y}) as y from pt "
    "join h using (row_key) group by pt.row_key)", FOREST,
    OF.predict_ctes(_TEST_ROWS, len(TOT), FOREST["n_trees"], FOREST["max_depth"]), train_only=True)


def q_forest_stats(spark, sf):
    """T18 forest level: average depth and leaves, total nodes."""
    return rnd(MS.forest_stats(fitted(spark, sf).nodes_df(spark)), {"avg_depth": 6, "avg_leaves": 6})


SQL_FOREST_STATS = _fsql("select count(*) as n_trees, round(avg(depth), 6) as avg_depth, "
                         "round(avg(n_leaves), 6) as avg_leaves, max(depth) as max_depth, "
                         "cast(sum(2 * n_leaves - 1) as bigint) as total_nodes from (select tree_id, max(depth) as depth, "
                         "count(*) filter (where is_leaf) as n_leaves from nodes group by tree_id)")


def q_evaluate_holdout(spark, sf):
    """All metrics on the held-out split of a forest fitted on the train side."""
    te = SP.train_test_split(H.housing_totals(spark, sf), seed=42).where(F.col("split") == "test")
    p = SC.predict(te.select("row_key", Y, *TOT), fitted(spark, sf, "train")).select(
        F.col(Y).alias("y"), F.col("prediction").alias("p"))
    return rnd(M.regression_metrics(p), MET_COLS)


SQL_EVALUATE = _fsql(
    "select n, " + ", ".join(f"round({c}, {d}) as {c}" for c, d in MET_COLS.items()) + " from met", FOREST,
    OF.predict_ctes(_TEST_ROWS, len(TOT), FOREST["n_trees"], FOREST["max_depth"])
    + [f"ev as (select pt.row_key, avg(p) as p, any_value(h.{Y}) as y from pt join h using (row_key) "
       "group by pt.row_key)", _sql_metrics_body("ev", "")], train_only=True)


PIPE = dict(n_trees=4, max_depth=3, min_samples_split=10, min_samples_leaf=5, max_features="sqrt", seed=21)


def _raw_rows(spark, sf) -> DataFrame:
    """Rows as they arrive: a missing feature here and there, a class as text."""
    return H.housing_totals(spark, sf).withColumn(
        TOT[3], F.when(F.col("row_key") % 7 != 0, F.col(TOT[3]).cast("double")))


def _stored_pipeline(spark, sf):
    """Train on raw rows, save model and fitted state, read both back."""
    from sylvan.operators.fitted_state import fit_state, load_state
    from sylvan.session import scratch_path

    raw = _raw_rows(spark, sf)
    state = fit_state(raw, TOT, ["ocean_proximity"], sig_digits=10)
    model = fit_forest(state.transform(raw), TOT + ["ocean_proximity_code"], Y, ForestParams(**PIPE))
    store = scratch_path(spark, "pipeline-store")
    mid = MS.save_model(spark, model, store, state=state)
    return raw, MS.load_model(spark, store, mid), load_state(spark, store, mid)


def q_pipeline_roundtrip(spark, sf):
    """Raw rows scored by a reloaded model with its reloaded fills, codes and scaling."""
    raw, model, state = _stored_pipeline(spark, sf)
    return rnd(SC.predict(state.transform(raw), model).select("row_key", "prediction"), {"prediction": 4})


def q_stream_pipeline(spark, sf):
    """ST1: a stream of raw rows -> features -> scaler -> prediction -> interval -> price."""
    from sylvan.streaming.score_stream import stream_score_available_now

    raw, model, state = _stored_pipeline(spark, sf)
    out = stream_score_available_now(spark, raw, model, features=state.prepare, scaler=state.scaler,
                                     confidence_level=0.9, price_adjust=True)
    return rnd(out.select("row_key", F.col("interval.lower").alias("lower"), F.col("interval.upper").alias("upper"),
                          "adjusted_price"), {"lower": 3, "upper": 3, "adjusted_price": 3})


def _sql_pipeline(body: str) -> str:
    raw = ", ".join(f"case when row_key % 7 <> 0 then cast({c} as double) end as {c}" if c == TOT[3] else c for c in TOT)
    fill = ", ".join(f"coalesce(cast({c} as double), (select quantile_cont({c}, 0.5) from rw)) as {c}" for c in TOT)
    scaled = ", ".join(f"({c} - m{i}) / s{i} as x{i}" for i, c in enumerate(TOT))
    nf = len(TOT) + 1
    xs = [f"x{i}" for i in range(nf)]
    ctes = [f"h as ({HOUSING_SQL})",
            f"rw as (select row_key, {raw}, dense_rank() over (order by ocean_proximity) - 1 as code, {Y} as y from h)",
            f"fl as (select row_key, {fill}, code, y from rw)",
            f"sst as materialized ({std_stats(TOT, 'fl', 'm', 's', True)})",
            f"sc as materialized (select row_key, {scaled}, cast(code as double) as x{nf - 1}, y from fl cross join sst)"]
    ctes += OF.forest_ctes(xs, "y", "sc", PIPE["n_trees"], PIPE["max_depth"], PIPE["min_samples_split"],
                           PIPE["min_samples_leaf"], SP.resolve_max_features("sqrt", nf), PIPE["seed"], True)
    ctes += OF.predict_ctes(f"select row_key, {', '.join(xs)} from sc", nf, PIPE["n_trees"], PIPE["max_depth"])
    return "with " + ",\n".join(ctes) + "\n" + body


SQL_PIPELINE = _sql_pipeline("select row_key, round(avg(p), 4) as prediction from pt group by row_key")
SQL_STREAM_PIPELINE = _sql_pipeline(
    f"select row_key, round(avg(p) - {SC.z_value(0.9)!r} * stddev_pop(p), 3) as lower, "
    f"round(avg(p) + {SC.z_value(0.9)!r} * stddev_pop(p), 3) as upper, "
    f"round(avg(p) * {P.INFLATION_FACTOR} * {P.MARKET_PREMIUM}, 3) as adjusted_price from pt group by row_key")


def _load_csv(action: str):
    """S1 end to end on a file with missing numbers, missing strings and tied modes."""
    def q(spark, sf):
        from sylvan.session import scratch_path
        from sylvan.sources.io import load_csv, write_predictions

        k = F.col("row_key")
        raw = H.housing_totals(spark, sf).select(
            "row_key", F.when(k % 7 != 0, F.col(TOT[2])).alias("a"), F.col(TOT[3]).alias("b"),
            F.when(k % 100 == 1, F.concat(F.lit("t"), k.cast("string"))).alias("tag"), F.col(Y).alias("y"))
        path = scratch_path(spark, "load-csv")
        write_predictions(raw, path, "csv")
        train, test, _ = load_csv(spark, path, "y", na_action=action, seed=42)
        both = train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
        return rnd(both.withColumn("row_key", F.col("row_key").cast("long")), {"a": 6, "b": 6, "y": 6})
    return q


def _load_csv_sql(action: str) -> str:
    kept = ("select * from raw where a is not null and tag is not null" if action == "drop" else
            "select row_key, coalesce(a, (select quantile_cont(a, 0.5) from raw)) as a, b, coalesce(tag, (select tag "
            "from raw where tag is not null group by tag order by count(*) desc, tag limit 1)) as tag, y from raw")
    return f"""with h as ({HOUSING_SQL}),
raw as (select row_key, cast(case when row_key % 7 <> 0 then {TOT[2]} end as double) as a,
  cast({TOT[3]} as double) as b, case when row_key % 100 = 1 then 't' || row_key end as tag, cast({Y} as double) as y from h),
kept as ({kept})
select cast(row_key as bigint) as row_key, round(a, 6) as a, round(b, 6) as b,
  cast(dense_rank() over (order by tag) - 1 as double) as tag, round(y, 6) as y,
  case when {h8('row_key', repr('42'))} < {hexcut(0.2)} then 'test' else 'train' end as split from kept"""


def _preset(name):
    def q(spark, sf):
        from sylvan.plans.presets import run_preset
        return _preset_round(run_preset(spark, sf, name))
    q.__doc__ = f"G4: the '{name}' pipeline end to end (metrics of the held-out split)."
    return q


def _sql_preset(name: str) -> str:
    """The named pipeline in SQL: features, exact-median fill, hash split,
    train-side standard scaling, the forest, held-out metrics."""
    from sylvan.plans.presets import PRESETS
    cfg = PRESETS[name]
    if cfg["features"] == "totals":
        feats = TOT + ["ocean_proximity_code"]
        base = ("select row_key, " + ", ".join(TOT) + ", cast(dense_rank() over (order by ocean_proximity) - 1 "
                f"as double) as ocean_proximity_code, {Y} as y from h")
        extra_ctes = []
    else:
        feats = AVG + P.AVG_ENGINEERED
        base = ("select row_key, " + ", ".join(AVG) + ", "
                + ", ".join(f"{e} as {c}" for c, e in P6_SQL.items()) + ", target as y from a")
        extra_ctes = [f"a as ({AVERAGES_SQL})"]
    nf = len(feats)
    fill = ", ".join(f"coalesce({c}, (select median({c}) from pb)) as {c}" for c in feats)
    hh = h8("row_key", repr("42"))
    scaled = ", ".join(f"({c} - m{i}) / s{i} as x{i}" for i, c in enumerate(feats))
    ctes = [f"h as ({HOUSING_SQL})"] + extra_ctes + [
        f"pb as ({base})",
        f"pf2 as (select row_key, {fill}, y, case when {hh} < {hexcut(0.2)} then 'test' else 'train' end as split from pb)",
        f"sst as materialized ({std_stats(feats, '(select * from pf2 where split = ' + chr(39) + 'train' + chr(39) + ')', 'm', 's', True)})",
        f"sc as materialized (select row_key, {scaled}, y, split from pf2 cross join sst)",
        "trn as (select * from sc where split = 'train')",
    ]
    m = SP.resolve_max_features("sqrt", nf)
    ctes += OF.forest_ctes([f"x{i}" for i in range(nf)], "y", "trn", cfg["n_trees"], cfg["max_depth"],
                           cfg["min_samples_split"], cfg["min_samples_leaf"], m, 42, True)
    tst = "select row_key, " + ", ".join(f"x{i}" for i in range(nf)) + " from sc where split = 'test'"
    ctes += OF.predict_ctes(tst, nf, cfg["n_trees"], cfg["max_depth"])
    ctes += ["ev as (select pt.row_key, avg(pt.p) as p, any_value(sc.y) as y from pt join sc using (row_key) "
             "group by pt.row_key)", _sql_metrics_body("ev", "")]
    mets = ", ".join(M.ALL_METRICS)
    body = (f"select metric, case when metric = 'mse' then round(value, 2) else round(value, 6) end as value "
            f"from met unpivot (value for metric in ({mets})) "
            "union all select 'meets_target' as metric, case when r2_score >= 0.8 then 1.0 else 0.0 end from met")
    return "with " + ",\n".join(ctes) + "\n" + body


def q_named_dataset(spark, sf):
    """Named dataset (averages form) loaded and split; test rows."""
    _, test, target = H.load_named(spark, sf, "housing_averages")
    return test.select("row_key", "MedInc", "AveOccup", target)


SQL_NAMED = with_frames(f"select row_key, MedInc, AveOccup, target from a where {h8('row_key', repr('42'))} < "
                        f"{hexcut(0.2)}", averages=True)


def q_array_validation(spark, sf):
    """Shape and value checks of an array feature column."""
    return clean.validate(H.embedding_rows(spark, sf), array_col="features", n_features=64)


SQL_ARRAY_VALID = """select 'empty_array' as rule, count(*) filter (where coalesce(len(embedding), -1) <= 0) as n_violations from embeddings
union all select 'wrong_length', count(*) filter (where len(embedding) <> 64) from embeddings
union all select 'nonfinite_element', count(*) filter (where len(list_filter(embedding,
    lambda v: v is null or isnan(v) or abs(v) = 'inf'::float)) > 0) from embeddings"""


QUERIES = {
    "csv_roundtrip": (q_csv_roundtrip, SQL_CSV),
    "array_features": (q_array_features, SQL_ARRAY),
    "synth_linear": (q_synth_linear, _sql_linear()),
    "synth_nonlinear_simple": (_synth_nl("simple"), _sql_nl("simple")),
    "synth_nonlinear_medium": (_synth_nl("medium"), _sql_nl("medium")),
    "synth_nonlinear_complex": (_synth_nl("complex"), _sql_nl("complex")),
    "ratio_features_totals": (q_ratio_features_totals, SQL_P3),
    "ratio_interactions": (q_ratio_interactions, SQL_P4),
    "ratio_subset": (q_ratio_subset, SQL_P5),
    "avg_features": (q_avg_features, SQL_P6),
    "poly_features": (q_poly_features, SQL_P7),
    "safe_ratio_scoring": (q_safe_ratio_scoring, SQL_P8),
    "rebuild_totals": (q_rebuild_totals, SQL_P9),
    "feature_vector": (q_feature_vector, SQL_P10),
    "label_encode": (q_label_encode, SQL_P12),
    "encoder_apply": (q_encoder_apply, SQL_P13),
    "price_adjust": (q_price_adjust, SQL_P15),
    "error_bands": (q_error_bands, SQL_P16),
    "score_tiers": (q_score_tiers, SQL_P17),
    "drop_missing": (q_drop_missing, SQL_F1),
    "missing_report": (q_missing_report, SQL_F5),
    "impute_median_mode": (q_impute_median_mode, SQL_I1),
    "impute_mean": (q_impute_mean, SQL_I2),
    "outlier_filter": (q_outlier_filter, SQL_F2),
    "validate_rules": (q_validate_rules, SQL_F3),
    "standard_scale": (q_standard_scale, _sql_std()),
    "standard_inverse": (q_standard_inverse, SQL_STD_INV),
    "minmax_scale": (q_minmax_scale, _sql_minmax()),
    "minmax_inverse": (q_minmax_inverse, SQL_STD_INV),
    "preprocess_fit_transform": (q_preprocess_fit_transform, _sql_preprocess()),
    "split_train_test": (q_split_train_test, SQL_SP1),
    "split_three_way": (q_split_three_way, SQL_SP2),
    "kfold": (q_kfold, SQL_SP3),
    "split_exact": (q_split_exact, SQL_SP1_EXACT),
    "split_three_way_exact": (q_split_three_way_exact, SQL_SP2_EXACT),
    "kfold_exact": (q_kfold_exact, SQL_SP3_EXACT),
    "csv_quarantine": (q_csv_quarantine, SQL_CSV_QUARANTINE),
    "bootstrap_weights": (q_bootstrap_weights, SQL_SP4),
    "bootstrap_exact": (q_bootstrap_exact, SQL_SP4_EXACT),
    "oob_rows": (q_oob_rows, SQL_SP5),
    "feature_subset": (q_feature_subset, SQL_FEATURE_SUBSET),
    "node_stats": (q_node_stats, SQL_NODE_STATS),
    "best_split": (q_best_split, SQL_BEST_SPLIT),
    "best_split_bootstrap": (q_best_split_bootstrap, SQL_BEST_SPLIT_BOOT),
    "custom_splitter": (q_custom_splitter, _fsql(SQL_NODES, {**CUSTOM, "splitter": "mean"})),
    "cross_validate_estimator": (q_cross_validate_estimator, _sql_cv_line()),
    "random_split": (q_random_split, _fsql(SQL_NODES, RANDOM)),
    "extra_random_split": (q_extra_random_split, _fsql(SQL_NODES, EXTRA)),
    "stump_predict": (q_stump_predict, SQL_STUMP_PREDICT),
    "tree_predict": (q_tree_predict, SQL_TREE_PREDICT),
    "forest_predict": (q_forest_predict, SQL_FOREST_PREDICT),
    "predict_uncertainty": (q_predict_uncertainty, SQL_PREDICT_UNC),
    "predict_interval": (q_predict_interval, SQL_PREDICT_INTERVAL),
    "feature_importance": (q_feature_importance, SQL_IMPORTANCE),
    "tree_stats": (q_tree_stats, SQL_TREE_STATS),
    "tree_rules": (q_tree_rules, _sql_rules()),
    "model_list": (q_model_list, SQL_MODEL_LIST),
    "model_roundtrip": (q_model_roundtrip, SQL_FOREST_PREDICT),
    "top_features": (q_top_features, SQL_TOP),
    "metrics_all": (q_metrics_all, SQL_METRICS_ALL),
    "metrics_requested": (q_metrics_requested, SQL_METRICS_REQ),
    "residual_stats": (q_residual_stats, SQL_RESID),
    "compare_models": (q_compare_models, SQL_COMPARE),
    "best_model": (q_best_model, SQL_BEST_MODEL),
    "models_meeting_target": (q_models_meeting_target, SQL_MEETING),
    "target_stats": (q_target_stats, SQL_TARGET_STATS),
    "union_splits": (q_union_splits, SQL_UNION),
    "first_predictions": (q_first_predictions, SQL_FIRST),
    "grid": (q_grid, SQL_GRID),
    "forest_fit": (q_forest_fit, SQL_FOREST_FIT),
    "forest_fit_levelwise": (q_forest_fit_levelwise, SQL_FOREST_DEEP),
    "forest_fit_node_table": (q_forest_fit_node_table, SQL_FOREST_DEEP),
    "forest_fit_streamed": (q_forest_fit_streamed, SQL_FOREST_DEEP),
    "forest_fit_bucketed": (q_forest_fit_bucketed, SQL_FOREST_BUCKETED),
    "pipeline_roundtrip": (q_pipeline_roundtrip, SQL_PIPELINE),
    "stream_pipeline": (q_stream_pipeline, SQL_STREAM_PIPELINE),
    "load_csv_fill": (_load_csv("fill"), _load_csv_sql("fill")),
    "load_csv_drop": (_load_csv("drop"), _load_csv_sql("drop")),
    "forest_fit_binned": (q_forest_fit_binned, SQL_FOREST_BINNED),
    "forest_fit_missing": (q_forest_fit_missing, SQL_FOREST_MISSING),
    "oob_score": (q_oob_score, SQL_OOB),
    "cross_validate": (q_cross_validate, _sql_cv()),
    "grid_search": (q_grid_search, _sql_grid()),
    "preset_quick": (q_preset_quick, _sql_preset("quick")),
    "stream_score": (q_stream_score, SQL_STREAM),
    "prediction_sink": (q_prediction_sink, SQL_PREDICT_UNC),
    "split_sink": (q_split_sink, SQL_UNION),
    "features_target_join": (q_features_target_join, SQL_S11),
    "select_features": (q_select_features, SQL_P1),
    "target_scaling": (q_target_scaling, SQL_P14),
    "residuals": (q_residuals, SQL_P18),
    "outlier_summary": (q_outlier_summary, SQL_F2_SUMMARY),
    "median_fill": (q_median_fill, _sql_median_fill()),
    "scale_except_codes": (q_scale_except_codes, _sql_scale_codes()),
    "model_score": (q_model_score, SQL_MODEL_SCORE),
    "forest_stats": (q_forest_stats, SQL_FOREST_STATS),
    "evaluate_holdout": (q_evaluate_holdout, SQL_EVALUATE),
    "preset_balanced": (_preset("balanced"), _sql_preset("balanced")),
    "named_dataset": (q_named_dataset, SQL_NAMED),
    "array_validation": (q_array_validation, SQL_ARRAY_VALID),
}

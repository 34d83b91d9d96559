"""Registered queries: one callable per operator, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver's tables (through the ``deliveries`` adapters)
so its work grows with them. Doubles are rounded to 6 places because the
results are compared with another engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as X
from ..constants import REQUEST_RANGES, VALID_RANGES
from ..operators import clean as C
from ..operators import metrics as M
from ..operators import features as FE
from ..operators import rank as R
from ..sources import fixtures as FX
from ..sources import readers as RD
from .common import rounded, with_component_prediction

GEO_ARGS = ("pickup_lat", "pickup_lng", "dropoff_lat", "dropoff_lng")
QUERIES: dict = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _d(spark, sf):
    return FX.deliveries(spark, sf)


def _raw(spark, sf):
    return FX.deliveries_raw(spark, sf)


def _pred(spark, sf):
    return with_component_prediction(_d(spark, sf))


# ---- 2.7 scalar functions ----------------------------------------------------

@query("geodesic_km")
def q_geodesic(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_d(spark, sf).select("order_id", X.geodesic_km(*GEO_ARGS).alias("distance_km")))


@query("haversine_km")
def q_haversine(spark, sf):
    return rounded(_d(spark, sf).select("order_id", X.haversine_km(*GEO_ARGS).alias("haversine_km")))


@query("bearing_deg")
def q_bearing(spark, sf):
    return rounded(_d(spark, sf).select("order_id", X.bearing_deg(*GEO_ARGS).alias("bearing")))


@query("bearing_sin_cos")
def q_bearing_sc(spark, sf):
    b = X.bearing_deg(*GEO_ARGS)
    return rounded(_d(spark, sf).select("order_id", X.bearing_sin(b).alias("bearing_sin"), X.bearing_cos(b).alias("bearing_cos")))


@query("coordinate_diffs")
def q_diffs(spark, sf):
    return rounded(_d(spark, sf).select("order_id", *[c.alias(n) for n, c in X.coordinate_diffs(*GEO_ARGS).items()]))


@query("offset_point")
def q_offset(spark, sf):
    d = _d(spark, sf)
    dist = X.geodesic_km(*GEO_ARGS)
    angle = F.radians(X.bearing_deg(*GEO_ARGS))
    bounds = {"lat_min": 37.70, "lat_max": 37.85, "lng_min": -122.52, "lng_max": -122.35}
    p = X.offset_point("pickup_lat", "pickup_lng", dist, angle, bounds)
    return rounded(d.select("order_id", p["lat"].alias("offset_lat"), p["lng"].alias("offset_lng")))


@query("temporal_parts")
def q_temporal(spark, sf):
    parts = X.temporal_parts("order_timestamp")
    return _d(spark, sf).select("order_id", *[c.cast("long").alias(n) for n, c in parts.items()])


@query("cyclical_features")
def q_cyclical(spark, sf):
    d = _d(spark, sf).select("order_id", *[c.alias(n) for n, c in X.temporal_parts("order_timestamp").items()])
    return rounded(d.select("order_id", *[c.alias(n) for n, c in X.cyclical_features().items()]))


@query("rush_flags")
def q_rush(spark, sf):
    h = F.hour("order_timestamp")
    flags = X.rush_flags(h)
    return _d(spark, sf).select("order_id", *[c.cast("long").alias(n) for n, c in flags.items()],
                                X.weekend_flag(F.weekday("order_timestamp")).cast("long").alias("is_weekend"))


@query("weekend_flag")
def q_weekend(spark, sf):
    return _d(spark, sf).select("order_id", X.weekend_flag(F.weekday("order_timestamp")).cast("long").alias("is_weekend"))


@query("weather_ordinal")
def q_weather_ord(spark, sf):
    return _raw(spark, sf).select("order_id", "order_timestamp", X.weather_ordinal("weather_condition").cast("long").alias("weather_encoded"))


@query("weather_one_hot")
def q_weather_1h(spark, sf):
    d = _raw(spark, sf)
    cols = X.weather_one_hot(FE.WeatherFeatures().fit(d)._scalars["vocabulary"])
    return d.select("order_id", "order_timestamp", *[c.cast("long").alias(n) for n, c in sorted(cols.items())])


@query("weather_multiplier")
def q_weather_mult(spark, sf):
    return rounded(_raw(spark, sf).select("order_id", "order_timestamp", X.weather_multiplier("weather_condition").alias("weather_multiplier")))


@query("traffic_multiplier")
def q_traffic(spark, sf):
    ts = F.col("order_timestamp")
    return rounded(_d(spark, sf).select("order_id", X.traffic_multiplier(F.hour(ts), F.weekday(ts)).alias("traffic_profile")))


@query("component_eta")
def q_component(spark, sf):
    return rounded(_pred(spark, sf).select("order_id", "predicted_eta_minutes"))


@query("baseline_eta")
def q_baseline(spark, sf):
    b = X.baseline_eta(X.geodesic_km(*GEO_ARGS))
    return rounded(_d(spark, sf).select("order_id", b.alias("b")).select("order_id", "b.*"))


@query("unit_convert")
def q_units(spark, sf):
    d = _d(spark, sf)
    secs = F.col("actual_eta_minutes") * 60.0
    metres = X.geodesic_km(*GEO_ARGS) * 1000.0
    return rounded(d.select("order_id", X.seconds_to_minutes(secs).alias("duration_minutes"),
                            X.metres_to_km(metres).alias("distance_km")))


@query("prediction_id")
def q_pred_id(spark, sf):
    return _d(spark, sf).select("order_id", X.prediction_id(F.col("order_id"), F.lit("v1")).alias("prediction_id"))


@query("format_id")
def q_format_id(spark, sf):
    ev = FX.table(spark, sf, "events")
    return ev.select("event_id", X.format_id("O", F.col("event_id"), 7).alias("order_id"),
                     X.format_id("R", F.col("user_id") % 50, 4).alias("restaurant_id"))


@query("round_1dp")
def q_round(spark, sf):
    return _d(spark, sf).select("order_id", X.round_1dp("actual_eta_minutes").alias("eta_1dp"))


@query("parse_stats_json")
def q_parse_json(spark, sf):
    from pyspark.sql import types as T
    ev = FX.table(spark, sf, "events")
    schema = T.StructType([T.StructField("k", T.LongType())])
    return ev.select("event_id", X.parse_json_object("props", schema).alias("p")).select("event_id", F.col("p.k").alias("k"))


@query("with_prediction_interval")
def q_interval(spark, sf):
    p = _pred(spark, sf)
    mae = p.agg(F.avg(F.abs(F.col("actual_eta_minutes") - F.col("predicted_eta_minutes")))).first()[0]
    cols = X.prediction_interval("predicted_eta_minutes", mae)
    return p.select("order_id", *[c.alias(n) for n, c in cols.items()])


# ---- 2.4 / 2.2 evaluation ------------------------------------------------------

@query("residuals")
def q_residuals(spark, sf):
    return rounded(M.residuals(_pred(spark, sf), "actual_eta_minutes", "predicted_eta_minutes", ["order_id"]))


@query("regression_metrics")
def q_regression(spark, sf):
    return rounded(M.regression_metrics(_pred(spark, sf)))


@query("within_k_pct")
def q_within(spark, sf):
    r = M.residuals(_pred(spark, sf), "actual_eta_minutes", "predicted_eta_minutes")
    return rounded(M.within_k_pct(r))


@query("error_percentiles")
def q_err_pct(spark, sf):
    r = M.residuals(_pred(spark, sf), "actual_eta_minutes", "predicted_eta_minutes")
    return rounded(M.error_percentiles(r))


@query("segment_metrics")
def q_segments(spark, sf):
    p = _pred(spark, sf).withColumn("hour_of_day", F.hour("order_timestamp"))
    return rounded(M.segment_metrics(p, "hour_of_day").withColumn("segment", F.col("segment").cast("long")))


@query("segment_metrics_min_count")
def q_segments_min(spark, sf):
    p = _pred(spark, sf).withColumn("day_of_month", F.dayofmonth("order_timestamp"))
    return rounded(M.segment_metrics_min_count(p, "day_of_month").withColumn("segment", F.col("segment").cast("long")))


@query("sort_segments")
def q_sort_segments(spark, sf):
    p = _pred(spark, sf)
    return rounded(M.segment_metrics(p, "restaurant_id"))


@query("error_histogram")
def q_hist(spark, sf):
    return rounded(M.error_histogram(_pred(spark, sf)).withColumn("bin", F.col("bin").cast("long")))


@query("error_cdf")
def q_cdf(spark, sf):
    r = M.residuals(_pred(spark, sf), "actual_eta_minutes", "predicted_eta_minutes", ["order_id"])
    r = r.withColumn("abs_error", F.round("abs_error", 6))
    return rounded(R.error_cdf(r, "abs_error", "order_id"))


# ---- 2.5 ordering ------------------------------------------------------------------

@query("time_split")
def q_time_split(spark, sf):
    return R.time_split(_d(spark, sf).select("order_id", "order_timestamp"), 0.2)


@query("time_series_folds")
def q_folds(spark, sf):
    return R.time_series_folds(_d(spark, sf).select("order_id", "order_timestamp"), 5).withColumn(
        "fold", F.col("fold").cast("long"))


@query("cv_summary")
def q_cv_summary(spark, sf):
    f = R.time_series_folds(_pred(spark, sf).select("order_id", "order_timestamp", "actual_eta_minutes",
                                                     "predicted_eta_minutes"), 5).filter("is_val")
    fm = f.groupBy("fold").agg(
        F.avg(F.abs(F.col("actual_eta_minutes") - F.col("predicted_eta_minutes"))).alias("mae"),
        F.sqrt(F.avg(F.pow(F.col("actual_eta_minutes") - F.col("predicted_eta_minutes"), 2))).alias("rmse"),
        (F.lit(1.0) - F.sum(F.pow(F.col("actual_eta_minutes") - F.col("predicted_eta_minutes"), 2))
         / (F.var_pop("actual_eta_minutes") * F.count(F.lit(1)))).alias("r2"),
    )
    return rounded(M.cv_summary(fm))


@query("sort_by_time")
def q_sort_time(spark, sf):
    return RD.sort_by_time(_d(spark, sf).select("order_id", "order_timestamp", "zone_id"))


# ---- 2.1 scans ---------------------------------------------------------------------

@query("date_range_filter")
def q_date_range(spark, sf):
    return rounded(RD.date_range_filter(_d(spark, sf), "2024-01-05", "2024-01-20"))


@query("limit_rows")
def q_limit(spark, sf):
    return rounded(RD.sort_by_time(_d(spark, sf)).limit(100))


# ---- 2.4 quality -------------------------------------------------------------------

@query("duplicate_count")
def q_dupes(spark, sf):
    return M.duplicate_count(_raw(spark, sf))


@query("validate_target")
def q_validate_target(spark, sf):
    return rounded(C.validate_target(_raw(spark, sf)))


@query("data_quality_profile")
def q_profile(spark, sf):
    return rounded(C.data_quality_profile(_raw(spark, sf)).withColumn(
        "total_columns", F.col("total_columns").cast("long")))


@query("describe_summary")
def q_describe(spark, sf):
    d = _d(spark, sf).withColumn("haversine_distance_km", X.geodesic_km(*GEO_ARGS))
    return rounded(C.describe_summary(d, ["actual_eta_minutes", "haversine_distance_km"]))


@query("feature_quality_counters")
def q_feature_quality(spark, sf):
    ranges = dict(VALID_RANGES)
    ranges.update({k: v for k, v in REQUEST_RANGES.items() if k not in ranges})
    return M.feature_quality_counters(_raw(spark, sf), ranges)


# ---- 2.2 / 2.4 cleaning ------------------------------------------------------------

@query("dedupe_first")
def q_dedupe(spark, sf):
    return rounded(C.dedupe_first(_raw(spark, sf)))


def _stringly(spark, sf):
    r = _raw(spark, sf)
    eid = F.col("event_id")
    return r.select(
        "order_id", "event_id",
        F.col("order_timestamp").cast("string").alias("order_timestamp"),
        F.when(eid % 29 == 0, F.lit("x")).otherwise(F.col("zone_id").cast("string")).alias("zone_id"),
        F.when(eid % 23 == 0, F.lit("n/a")).otherwise(F.col("prep_time_minutes").cast("string")).alias("prep_time_minutes"),
        F.col("traffic_multiplier").cast("string").alias("traffic_multiplier"),
        F.col("pickup_lat").cast("string").alias("pickup_lat"),
    )


@query("coerce_types")
def q_coerce(spark, sf):
    return rounded(C.coerce_types(_stringly(spark, sf)))


@query("impute_missing")
def q_impute(spark, sf):
    res = C.impute_missing(_raw(spark, sf))
    return rounded(res.df.select("order_id", "event_id", "order_timestamp", "weather_condition", "prep_time_minutes"))


@query("range_filter_or_clip")
def q_ranges(spark, sf):
    return rounded(C.range_filter_or_clip(_raw(spark, sf)))


def _clip_query(method):
    def fn(spark, sf):
        out, _, _ = C.bounds_clip(_d(spark, sf), "actual_eta_minutes", method, 1.5)
        return rounded(out.select("order_id", "actual_eta_minutes"))
    return fn


QUERIES["iqr_bounds_clip"] = _clip_query("iqr")
QUERIES["zscore_bounds_clip"] = _clip_query("zscore")
QUERIES["fixed_bounds_clip"] = _clip_query("bounds")


@query("clean_orders")
def q_clean(spark, sf):
    return rounded(C.clean_orders(_raw(spark, sf)).df)


@query("cleaning_report")
def q_clean_report(spark, sf):
    rep = C.clean_orders(_raw(spark, sf)).report
    return rounded(C.cleaning_report_frame(spark, rep))


# ---- 2.3 / 2.4 features, joins, lookups ------------------------------------------------

from ..operators import lookups as LK  # noqa: E402
from ..sources import sinks as SK  # noqa: E402
from ..session import scratch_path  # noqa: E402

SPLIT_TS = "2024-01-16 00:00:00"


def _train(d):
    return d.filter(F.col("order_timestamp") < F.lit(SPLIT_TS).cast("timestamp_ntz"))


def _test(d):
    return d.filter(F.col("order_timestamp") >= F.lit(SPLIT_TS).cast("timestamp_ntz"))


@query("zone_centroids")
def q_centroids(spark, sf):
    m = FE.GeoFeatures().fit(_d(spark, sf))
    return rounded(m._tables["centroids"])


@query("join_zone_centroid")
def q_zone_centroid(spark, sf):
    d = _d(spark, sf)
    m = FE.GeoFeatures().fit(d.filter("zone_id <= 6"))
    return rounded(m.transform(d).select("order_id", "dist_to_zone_centroid"))


@query("target_encoding_fit")
def q_te_fit(spark, sf):
    m = FE.TargetEncoder(columns=["restaurant_id"]).fit(_train(_d(spark, sf)))
    return rounded(m._tables["restaurant_id"])


@query("join_target_encoding")
def q_te_join(spark, sf):
    d = _d(spark, sf)
    m = FE.TargetEncoder(columns=["zone_id", "restaurant_type"]).fit(_train(d).filter("zone_id <= 6"))
    return rounded(m.transform(d).select("order_id", "zone_id_encoded", "restaurant_type_encoded"))


@query("group_eta_stats")
def q_group_stats(spark, sf):
    m = FE.GroupStats(keys=["restaurant_id"]).fit(_train(_d(spark, sf)))
    return rounded(m._tables["restaurant_id"])


def _zone_stats_model(d):
    return FE.GroupStats(keys=["zone_id"]).fit(_train(d).filter("zone_id <= 6"))


@query("join_group_stats")
def q_join_group_stats(spark, sf):
    d = _d(spark, sf)
    out = _zone_stats_model(d).transform(d)
    return rounded(out.select("order_id", "zone_id_eta_mean", "zone_id_eta_median", "zone_id_eta_std", "zone_id_order_count"))


@query("fill_group_stats")
def q_fill_group_stats(spark, sf):
    d = _d(spark, sf)
    out = _zone_stats_model(d).transform(d)
    return rounded(out.select("zone_id", "zone_id_eta_mean", "zone_id_eta_median", "zone_id_eta_std",
                              "zone_id_order_count").distinct())


@query("lookup_zone_stats_with_defaults")
def q_lookup_zone(spark, sf):
    d = _d(spark, sf)
    m = _zone_stats_model(d)
    out = LK.lookup_zone_stats_with_defaults(d.select("order_id", "zone_id"), m._tables["zone_id"],
                                             m._scalars["rows_zone_id"])
    return rounded(out.drop("zone_id"))


@query("lookup_hit_rate")
def q_hit_rate(spark, sf):
    d = _d(spark, sf)
    m = _zone_stats_model(d)
    out = LK.lookup_zone_stats_with_defaults(d.select("order_id", "zone_id"), m._tables["zone_id"])
    return M.lookup_hit_rate(out.withColumn("_m", F.when(F.col("zone_stats_hit"), F.lit(1))), "zone_stats", "zone_id", "_m")


def _zone_counts(d):
    return d.groupBy("zone_id").agg(F.count(F.lit(1)).alias("order_count"), F.max("actual_eta_minutes").alias("max_eta"))


@query("upsert_zone_statistics")
def q_upsert(spark, sf):
    d = _d(spark, sf)
    existing = _zone_counts(_train(d).filter("zone_id <= 6"))
    incoming = _zone_counts(d)
    return rounded(SK.insert_if_absent(existing, incoming, ["zone_id"]))


@query("touch_updated_at")
def q_touch(spark, sf):
    d = _d(spark, sf)
    old = _zone_counts(_train(d)).withColumn("updated_at", F.lit(SPLIT_TS).cast("timestamp_ntz"))
    new = _zone_counts(d.filter("zone_id <= 4")).unionByName(_zone_counts(_train(d).filter("zone_id IN (5, 6)")))
    return rounded(SK.touch_updated_at(old, new, ["zone_id"], ["order_count", "max_eta"], "2024-02-01 00:00:00"))


@query("impute_features_train_median")
def q_train_median(spark, sf):
    r = _raw(spark, sf)
    m = FE.MedianImputer(inputCols=["prep_time_minutes"]).fit(_train(r))
    return rounded(m.transform(r).select("order_id", "event_id", "order_timestamp", "prep_time_minutes"))


FEATURE_OUT = ["order_id"] + [
    "haversine_distance_km", "bearing", "bearing_sin", "bearing_cos", "lat_diff", "lng_diff", "manhattan_proxy",
    "dist_to_zone_centroid", "hour_of_day", "day_of_week", "month", "day_of_month", "week_of_year",
    "hour_sin", "hour_cos", "dow_sin", "dow_cos", "month_sin", "month_cos",
    "is_morning_rush", "is_lunch_rush", "is_dinner_rush", "is_late_night", "is_weekend",
    "zone_id_encoded", "restaurant_type_encoded", "zone_id_eta_mean", "zone_id_eta_median", "zone_id_eta_std",
    "zone_id_order_count", "weather_encoded", "weather_cloudy", "weather_fog", "weather_heavy_rain", "weather_rain",
]
INT_FEATURES = {"hour_of_day", "day_of_week", "month", "day_of_month", "week_of_year", "is_morning_rush",
                "is_lunch_rush", "is_dinner_rush", "is_late_night", "is_weekend", "weather_encoded",
                "weather_cloudy", "weather_fog", "weather_heavy_rain", "weather_rain", "zone_id_order_count"}


def _longs(df, cols):
    return df.select(*[F.col(c).cast("long").alias(c) if c in INT_FEATURES else F.col(c) for c in cols])


@query("feature_pipeline")
def q_feature_pipeline(spark, sf):
    d = _d(spark, sf)
    model = FE.fit_feature_pipeline(_train(d))
    return rounded(_longs(model.transform(d), FEATURE_OUT))


@query("prepare_training")
def q_prepare_training(spark, sf):
    tr = _train(_d(spark, sf))
    out, _ = FE.prepare_training(tr)
    cols = ["order_id", "zone_id_encoded", "restaurant_type_encoded", "zone_id_eta_mean", "zone_id_eta_median",
            "zone_id_eta_std", "zone_id_order_count", "restaurant_id_eta_mean", "restaurant_id_eta_median",
            "restaurant_id_eta_std", "restaurant_id_order_count"]
    return rounded(out.select(*[F.col(c).cast("long").alias(c) if c.endswith("_order_count") else F.col(c) for c in cols]))


@query("prepare_inference")
def q_prepare_inference(spark, sf):
    d = _d(spark, sf)
    model = FE.fit_feature_pipeline(_train(d))
    out = FE.prepare_inference(_test(d), model)
    return rounded(_longs(out, FEATURE_OUT))


@query("select_model_features")
def q_select_features(spark, sf):
    d = _d(spark, sf)
    out = FE.fit_feature_pipeline(_train(d)).transform(d)
    sel = FE.select_model_features(FE.drop_target(out), keep=["order_id"])
    return rounded(_longs(sel, sel.columns))


@query("complete_features")
def q_complete_features(spark, sf):
    d = _d(spark, sf)
    out = FE.fit_feature_pipeline(_train(d)).transform(d.drop("rider_reliability"))
    return rounded(FE.complete_features(out, keep=["order_id"]))


@query("lag_features")
def q_lags(spark, sf):
    d = _d(spark, sf)
    m = FE.LagFeatures(groupCols=["zone_id"]).fit(_train(d))
    out = m.transform(d)
    return rounded(out.select("order_id", "zone_id_actual_eta_minutes_lag_1", "zone_id_actual_eta_minutes_lag_3",
                              "zone_id_actual_eta_minutes_lag_7"))


@query("rolling_mean_prior5")
def q_rolling(spark, sf):
    d = _d(spark, sf)
    m = FE.LagFeatures(groupCols=["restaurant_id"], lags=[1]).fit(_train(d))
    return rounded(m.transform(d).select("order_id", "restaurant_id_actual_eta_minutes_rolling_mean"))


@query("concat_columns")
def q_concat(spark, sf):
    r = _raw(spark, sf)
    m = FE.WeatherFeatures().fit(_train(r))
    out = m.transform(r)
    cols = ["order_id", "order_timestamp", "weather_encoded"] + sorted(c for c in out.columns if c.startswith("weather_") and c not in ("weather_condition", "weather_multiplier", "weather_encoded"))
    return out.select(*[F.col(c).cast("long").alias(c) if c.startswith("weather_") else F.col(c) for c in cols])


@query("tagged_union")
def q_tagged(spark, sf):
    d = _d(spark, sf)
    ref = _train(d).select("order_id", "actual_eta_minutes").withColumn("w", F.lit("reference"))
    cur = _test(d).select("order_id", "actual_eta_minutes").withColumn("w", F.lit("current"))
    return rounded(ref.unionByName(cur))


@query("enrich_orders_with_dims")
def q_enrich(spark, sf):
    o = FX.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    c = FX.table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_nationkey", "c_mktsegment")
    n = FX.table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    out = LK.enrich_orders_with_dims(o, [(c, "o_custkey"), (n, "c_nationkey")])
    return rounded(out.select("o_orderkey", "o_totalprice", "c_name", "c_mktsegment", "n_name"))


@query("distance_matrix")
def q_distance_matrix(spark, sf):
    d = _d(spark, sf)
    origins = d.groupBy("zone_id").agg(F.avg("pickup_lat").alias("lat"), F.avg("pickup_lng").alias("lng")).select(
        F.col("zone_id").cast("long").alias("origin_idx"), "lat", "lng")
    dests = d.groupBy("restaurant_id").agg(F.avg("dropoff_lat").alias("lat"), F.avg("dropoff_lng").alias("lng")).select(
        F.col("restaurant_id").alias("dest_idx"), "lat", "lng")
    pairs = d.select(F.col("zone_id").cast("long").alias("origin_idx"), F.col("restaurant_id").alias("dest_idx")).distinct()
    return rounded(LK.distance_matrix(origins, dests, pairs))


def _prediction_log(spark, sf):
    p = _pred(spark, sf)
    return p.select(X.prediction_id(F.col("order_id"), F.lit("v1")).alias("prediction_id"), "order_id",
                    "event_id", "order_timestamp", "predicted_eta_minutes", "actual_eta_minutes")


@query("join_prediction_feedback")
def q_feedback(spark, sf):
    log = _prediction_log(spark, sf)
    actuals = log.filter(F.col("event_id") % 3 != 0).select("prediction_id", "actual_eta_minutes")
    out = LK.join_prediction_feedback(log.drop("actual_eta_minutes"), actuals)
    return rounded(out.select("prediction_id", "predicted_eta_minutes", "actual_eta_minutes", "error"))


def _requests(spark, sf, keep: tuple = ()):
    r = _raw(spark, sf)
    eid = F.col("event_id")
    return r.select(
        *[F.col(c).alias(f"keep_{c}") for c in keep],
        "order_id", "event_id", "pickup_lat", "pickup_lng", "dropoff_lat", "dropoff_lng",
        F.when(eid % 31 == 0, F.lit(None).cast("double")).otherwise(F.col("dropoff_lng")).alias("dropoff_lng_req"),
        "zone_id", F.when(eid % 7 == 0, F.lit("")).otherwise(F.col("restaurant_type")).alias("restaurant_type"),
        F.when(eid % 13 == 0, F.lit(None).cast("timestamp_ntz")).otherwise(F.col("order_timestamp")).alias("order_time"),
        F.when(eid % 11 == 0, F.lit(0.0)).otherwise(F.col("traffic_multiplier")).alias("traffic_multiplier"),
        "weather_condition", "prep_time_minutes",
        F.when(eid % 37 == 0, F.lit(60.0)).otherwise(F.col("rider_avg_speed_kmh")).alias("rider_avg_speed_kmh"),
    ).drop("dropoff_lng").withColumnRenamed("dropoff_lng_req", "dropoff_lng")


@query("request_validity")
def q_validity(spark, sf):
    v = LK.request_validity(_requests(spark, sf))
    return v.select("order_id", "event_id", "is_valid", F.array_join("errors", "; ").alias("errors"))


@query("request_defaults")
def q_defaults(spark, sf):
    v = LK.request_defaults(_requests(spark, sf), now=F.lit("2024-02-01 00:00:00").cast("timestamp_ntz"))
    return rounded(v.select("order_id", "event_id", "zone_id", "restaurant_type", "traffic_multiplier",
                            "weather_condition", "prep_time_minutes", "rider_avg_speed_kmh", "rider_reliability",
                            "order_time"))


# ---- 2.1 sources and sinks --------------------------------------------------------------

@query("scan_restaurants")
def q_scan_restaurants(spark, sf):
    path = scratch_path(spark, "restaurants")
    SK.write_parquet(FX.restaurants(spark, sf), path)
    return rounded(RD.load_dimension(spark, path))


@query("scan_riders")
def q_scan_riders(spark, sf):
    path = scratch_path(spark, "riders")
    SK.write_csv(FX.riders(spark, sf), path)
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("rider_id", T.StringType()), T.StructField("avg_speed_kmh", T.DoubleType()),
                           T.StructField("reliability_score", T.DoubleType()),
                           T.StructField("completed_deliveries", T.LongType())])
    return rounded(RD.load_dimension(spark, path, "csv", schema))


def _orders_file(spark, sf):
    path = scratch_path(spark, "orders")
    SK.write_parquet(_d(spark, sf), path)
    return path


@query("scan_orders")
def q_scan_orders(spark, sf):
    return rounded(RD.load_orders(spark, _orders_file(spark, sf), "parquet", "2024-01-05", "2024-01-20"))


@query("scan_orders_limit")
def q_scan_orders_limit(spark, sf):
    return rounded(RD.load_orders(spark, _orders_file(spark, sf), "parquet", None, "2024-01-20", limit=500))


@query("scan_orders_csv")
def q_scan_csv(spark, sf):
    path = scratch_path(spark, "orders-csv")
    SK.write_csv(_d(spark, sf), path)
    return rounded(RD.load_csv_orders(spark, path))


@query("load_training_data")
def q_load_training(spark, sf):
    db = {"url": "jdbc:dropcast-unavailable://nowhere/db", "dbtable": "delivery_orders"}
    return rounded(RD.load_training_data(spark, db, _orders_file(spark, sf), "parquet", "2024-01-05", "2024-01-20"))


@query("load_validated")
def q_load_validated(spark, sf):
    return rounded(RD.load_validated(_d(spark, sf)))


@query("sink_clean_csv")
def q_sink_clean(spark, sf):
    res = C.clean_orders(_raw(spark, sf))
    path = scratch_path(spark, "clean")
    SK.write_csv(res.df, path)
    from ..sources.readers import ORDER_SCHEMA
    return rounded(RD.load_csv_orders(spark, path, ORDER_SCHEMA))


@query("sink_segment_csv")
def q_sink_segment(spark, sf):
    """Both segment tables, each written and read back: by hour and by weekday."""
    p = _pred(spark, sf).withColumns({"hour_of_day": F.hour("order_timestamp"), "day_of_week": F.weekday("order_timestamp")})
    parts = []
    for by in ("hour_of_day", "day_of_week"):
        seg = M.segment_metrics(p, by).withColumn("segment", F.col("segment").cast("long"))
        path = scratch_path(spark, f"segments-{by}")
        SK.write_csv(seg, path)
        parts.append(RD.load_dimension(spark, path, "csv", seg.schema).withColumn("segment_by", F.lit(by)))
    return rounded(parts[0].unionByName(parts[1]))


@query("sink_report_json")
def q_sink_report(spark, sf):
    rep = M.regression_metrics(_pred(spark, sf), with_percentiles=False)
    path = scratch_path(spark, "report")
    SK.write_json(rep, path)
    return rounded(spark.read.schema(rep.schema).json(path))


@query("register_model_version")
def q_register(spark, sf):
    p = _pred(spark, sf)
    def entry(df, version, stage):
        m = M.regression_metrics(df, with_percentiles=False)
        return m.select(F.lit("eta_model").alias("model_name"), F.lit(version).alias("version"),
                        F.lit(stage).alias("stage"), "mae", "rmse", "r2",
                        F.lit(f"models/eta_model/{version}").alias("artifact_path"))
    registry = entry(_train(p), "v1", "production")
    incoming = entry(_test(p), "v1", "staging").unionByName(entry(_test(p), "v2", "staging"))
    return rounded(SK.register_model_version(registry, incoming))


@query("prediction_log_sink")
def q_pred_log(spark, sf):
    p = _pred(spark, sf).withColumn("prediction_id", X.prediction_id(F.col("order_id"), F.lit("v1")))
    log = SK.prediction_log(p, ["prep_time_minutes", "traffic_multiplier", "weather_condition"], model_version="v1")
    path = scratch_path(spark, "predlog")
    SK.write_parquet(log, path)
    back = spark.read.parquet(path)
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("prep_time_minutes", T.DoubleType()),
                           T.StructField("traffic_multiplier", T.DoubleType()),
                           T.StructField("weather_condition", T.StringType())])
    return rounded(back.select("prediction_id", "request_timestamp", "zone_id", "predicted_eta_minutes", "model_version",
                               F.from_json("features_json", schema).alias("f")).select(
        "prediction_id", "request_timestamp", "zone_id", "predicted_eta_minutes", "model_version", "f.*"))


# ---- 2.9 drift and quality ------------------------------------------------------------

from ..operators import drift as DR  # noqa: E402

DRIFT_NUMERIC = ["pickup_lat", "pickup_lng", "dropoff_lat", "dropoff_lng", "rider_avg_speed_kmh", "traffic_multiplier",
                 "prep_time_minutes", "weather_multiplier", "zone_id"]
DRIFT_CATEGORICAL = ["restaurant_type", "weather_condition", "restaurant_id"]


def _ref_cur(spark, sf, shift: float = 0.0):
    p = _pred(spark, sf)
    cur = _test(p)
    if shift:
        cur = cur.withColumn("actual_eta_minutes", F.col("actual_eta_minutes") + shift)
    return _train(p), cur


@query("column_drift_numeric")
def q_drift_num(spark, sf):
    ref, cur = _ref_cur(spark, sf)
    return rounded(DR.column_drift_numeric(ref, cur, DRIFT_NUMERIC))


@query("column_drift_categorical")
def q_drift_cat(spark, sf):
    ref, cur = _ref_cur(spark, sf)
    return rounded(DR.column_drift_categorical(ref, cur, DRIFT_CATEGORICAL))


@query("dataset_drift")
def q_dataset_drift(spark, sf):
    ref, cur = _ref_cur(spark, sf)
    row = DR.dataset_drift(ref, cur, DRIFT_NUMERIC, DRIFT_CATEGORICAL)
    text = F.transform("drifted", lambda d: F.format_string("%s:%s:%.4f", d["column"], d["test"], d["score"]))
    return rounded(row.withColumn("drifted", F.array_join(text, ",")))


@query("monitoring_gauges")
def q_monitoring_gauges(spark, sf):
    ref, cur = _ref_cur(spark, sf)
    row = DR.dataset_drift(ref, cur, DRIFT_NUMERIC, DRIFT_CATEGORICAL)
    return rounded(M.monitoring_gauges(row, len(DRIFT_NUMERIC) + len(DRIFT_CATEGORICAL)))


@query("target_drift")
def q_target_drift(spark, sf):
    ref, cur = _ref_cur(spark, sf, shift=20.0)
    return rounded(DR.target_drift(ref, cur, "actual_eta_minutes"))


@query("prediction_drift")
def q_prediction_drift(spark, sf):
    ref, cur = _ref_cur(spark, sf)
    return rounded(DR.column_drift_numeric(ref, cur, ["predicted_eta_minutes"]))


@query("prediction_quality")
def q_prediction_quality(spark, sf):
    _, cur = _ref_cur(spark, sf)
    return rounded(DR.prediction_quality(cur, "actual_eta_minutes", "predicted_eta_minutes"))


@query("drift_test_suite")
def q_test_suite(spark, sf):
    ref, cur = _ref_cur(spark, sf)
    return rounded(DR.drift_test_suite(DR.column_drift(ref, cur, DRIFT_NUMERIC, DRIFT_CATEGORICAL)))


@query("monitoring_report")
def q_monitoring_report(spark, sf):
    ref, cur = _ref_cur(spark, sf, shift=20.0)
    return rounded(DR.monitoring_report(ref, cur, DRIFT_NUMERIC, DRIFT_CATEGORICAL, "actual_eta_minutes",
                                        "predicted_eta_minutes"))


@query("should_retrain")
def q_should_retrain(spark, sf):
    ref, cur = _ref_cur(spark, sf, shift=20.0)
    rep = DR.monitoring_report(ref, cur, DRIFT_NUMERIC, DRIFT_CATEGORICAL, "actual_eta_minutes", "predicted_eta_minutes")
    return DR.should_retrain(rep)


@query("append_drift_report")
def q_append_drift(spark, sf):
    ref, cur = _ref_cur(spark, sf)
    cd = DR.column_drift(ref, cur, DRIFT_NUMERIC, DRIFT_CATEGORICAL)
    row = SK.drift_report_row(cd, "2024-02-01 00:00:00")
    path = scratch_path(spark, "drift-reports")
    SK.write_parquet(row, path, mode="append")
    back = spark.read.parquet(path)
    return rounded(back.select("report_timestamp", "drift_detected", "drift_share",
                               F.array_join("drifted_columns", ",").alias("drifted_columns")))


# ---- 2.4 monitoring counters over a prediction log -------------------------------------

def _monitor_log(spark, sf):
    r = LK.request_validity(_requests(spark, sf, ("order_timestamp", "actual_eta_minutes", "restaurant_type")))
    pred = X.component_eta(X.geodesic_km(*GEO_ARGS), "prep_time_minutes", "rider_avg_speed_kmh", "traffic_multiplier",
                           X.weather_multiplier("weather_condition"))
    ts = F.col("keep_order_timestamp")
    return r.select(
        X.prediction_id(F.col("order_id"), F.lit("v1")).alias("prediction_id"),
        ts.alias("request_timestamp"), F.col("keep_restaurant_type").alias("restaurant_type"),
        F.when(F.col("is_valid"), F.lit("success")).otherwise(F.lit("error")).alias("status"),
        F.when(ts < F.lit(SPLIT_TS).cast("timestamp_ntz"), F.lit("v1")).otherwise(F.lit("v2")).alias("model_version"),
        ((F.col("event_id") % 997) / F.lit(10000.0)).alias("latency_s"),
        pred.alias("predicted_eta_minutes"), F.col("keep_actual_eta_minutes").alias("actual_eta_minutes"),
    )


def _access_log(spark, sf):
    log = _monitor_log(spark, sf)
    return log.select(
        F.lit("POST").alias("method"),
        F.when(F.col("restaurant_type").isin("view", "click"), F.lit("/predict/realtime")).otherwise(F.lit("/predict/batch")).alias("endpoint"),
        F.when(F.col("status") == "success", F.lit(200)).otherwise(F.lit(422)).cast("long").alias("status_code"),
        "latency_s",
    )


@query("prediction_counter")
def q_pred_counter(spark, sf):
    return M.prediction_counter(_monitor_log(spark, sf))


@query("request_counter")
def q_req_counter(spark, sf):
    return M.request_counter(_access_log(spark, sf))


@query("request_latency_hist")
def q_req_latency(spark, sf):
    from ..constants import REQUEST_LATENCY_BUCKETS
    return rounded(M.request_latency_hist(_access_log(spark, sf), REQUEST_LATENCY_BUCKETS))


@query("prediction_histograms")
def q_pred_hist(spark, sf):
    return rounded(M.prediction_histograms(_monitor_log(spark, sf)))


@query("prediction_histograms_serving")
def q_pred_hist_serving(spark, sf):
    return rounded(M.prediction_histograms(_monitor_log(spark, sf), bucket_set="serving"))


@query("abs_error_summary")
def q_abs_err(spark, sf):
    return rounded(M.abs_error_summary(_monitor_log(spark, sf)))


@query("last_value_gauges")
def q_gauges(spark, sf):
    return rounded(M.last_value_gauges(_monitor_log(spark, sf)))


# ---- 2.8 model operators (no SQL oracle: learned models) ---------------------------------

from . import training as TR  # noqa: E402

TUNE_TRIALS = 50
CV_FOLDS = 5
_MEMO: dict = {}


def _trained(spark, sf):
    """Prepared data and GBT fitted with the published settings, memoised per session and input folder."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _MEMO:
        prep = TR.prepare_data(_d(spark, sf))
        model = TR.train_gbt(prep.train, prep.features, TR.gbt_params())
        _MEMO[key] = (prep, model)
    return _MEMO[key]


@query("train_gbt")
def q_train_gbt(spark, sf):
    prep, model = _trained(spark, sf)
    return rounded(TR.predict(model, prep.test).select("order_id", "actual_eta_minutes", "predicted_eta_minutes"))


@query("train_alt_model")
def q_train_alt(spark, sf):
    prep = TR.prepare_data(_d(spark, sf))
    m = TR.train_alt_model(prep.train, prep.features, TR.gbt_params())
    return rounded(TR.predict(m, prep.test).select("order_id", "actual_eta_minutes", "predicted_eta_minutes"))


@query("cross_validate_time")
def q_cv(spark, sf):
    prep = TR.prepare_data(_d(spark, sf))
    fm, _ = TR.cross_validate_time(prep.train, prep.features, TR.gbt_params(), CV_FOLDS)
    return rounded(fm)


@query("tune_hyperparameters")
def q_tune(spark, sf):
    prep = TR.prepare_data(_d(spark, sf))
    table, _ = TR.tune_hyperparameters(prep.train, prep.features, n_trials=TUNE_TRIALS, n_splits=CV_FOLDS)
    return rounded(table)


@query("predict_batch")
def q_predict_batch(spark, sf):
    prep, model = _trained(spark, sf)
    full = TR.scoring_model(prep, model)
    out = TR.predict(full, _d(spark, sf))
    return rounded(out.select("order_id", "predicted_eta_minutes"))


@query("predict_one")
def q_predict_one(spark, sf):
    prep, model = _trained(spark, sf)
    full = TR.scoring_model(prep, model)
    mae = TR.evaluate(model, prep.test).first()["mae"]
    out = TR.predict(full, _d(spark, sf))
    iv = X.prediction_interval("predicted_eta_minutes", mae)
    return out.select(X.prediction_id(F.col("order_id"), F.lit("gbt-v1")).alias("prediction_id"), "order_id",
                      *[c.alias(n) for n, c in iv.items()], F.lit("gbt-v1").alias("model_version"))


@query("feature_importance")
def q_importance(spark, sf):
    prep, model = _trained(spark, sf)
    return rounded(TR.feature_importance(model, prep.features, spark))


@query("top_k_importance")
def q_top_k(spark, sf):
    prep, model = _trained(spark, sf)
    return rounded(TR.top_k_importance(TR.feature_importance(model, prep.features, spark), 10))


@query("sink_importance_csv")
def q_sink_importance(spark, sf):
    prep, model = _trained(spark, sf)
    imp = TR.feature_importance(model, prep.features, spark)
    path = scratch_path(spark, "importance")
    SK.write_csv(imp, path)
    return rounded(RD.load_dimension(spark, path, "csv", imp.schema))


@query("save_model")
def q_save_model(spark, sf):
    prep, model = _trained(spark, sf)
    full = TR.scoring_model(prep, model)
    path = scratch_path(spark, "model")
    full.write().overwrite().save(path)
    loaded = FE.PipelineModel.load(path)
    return rounded(TR.predict(loaded, _d(spark, sf)).select("order_id", "predicted_eta_minutes"))


@query("evaluation_report")
def q_eval_report(spark, sf):
    prep, model = _trained(spark, sf)
    rep = TR.evaluation_report(model, prep)
    # one table: a row per split, then a row per hour and per weekday of the test rows
    out = rep.metrics.withColumn("part", F.col("split"))
    for name, seg in (("hour_of_day", rep.hour_segments), ("day_of_week", rep.dow_segments)):
        out = out.unionByName(seg.withColumn("part", F.lit(name)), allowMissingColumns=True)
    sizes = {"n_train": F.lit(prep.train.count()), "n_test": F.lit(prep.test.count())}
    return rounded(out.withColumns(sizes))


@query("target_met")
def q_target_met(spark, sf):
    prep, model = _trained(spark, sf)
    return rounded(TR.target_met(TR.evaluate(model, prep.test)))


@query("prediction_records")
def q_prediction_records(spark, sf):
    """Every order scored by the fitted pipeline as a batch and again as a request with id and interval: whether both
    give the same prediction (rounded as in the response), and whether the interval holds it and keeps its lower bound."""
    prep, model = _trained(spark, sf)
    full = TR.scoring_model(prep, model)
    mae = TR.evaluate(model, prep.test).first()["mae"]
    batch = TR.predict(full, _d(spark, sf)).select("order_id", X.round_1dp(F.col("predicted_eta_minutes")).alias("batch"))
    iv = X.prediction_interval("predicted_eta_minutes", mae)
    one = TR.predict(full, _d(spark, sf)).select("order_id", *[c.alias(n) for n, c in iv.items()])
    p, lo, hi = F.col("predicted_eta_minutes"), F.col("confidence_interval_lower"), F.col("confidence_interval_upper")
    return one.join(batch, "order_id").select(
        "order_id", X.prediction_id(F.col("order_id"), F.lit("gbt-v1")).alias("prediction_id"), F.lit("gbt-v1").alias("model_version"),
        p.eqNullSafe(F.col("batch")).alias("same"), F.coalesce((lo <= p) & (p <= hi) & (lo >= 1.0), F.lit(False)).alias("in_interval"))


@query("importance_records")
def q_importance_records(spark, sf):
    """A row per model feature: whether its importance is a share of one, whether the table's order is descending up to
    it, whether it survives the CSV sink, and whether the top 10 are the features of the ranks up to 10."""
    prep, model = _trained(spark, sf)
    imp = TR.feature_importance(model, prep.features, spark)
    path = scratch_path(spark, "importance")
    SK.write_csv(imp, path)
    back = RD.load_dimension(spark, path, "csv", imp.schema).select("feature", F.col("importance").alias("read"))
    rows = imp.collect()  # one row per feature
    total = sum(r["importance"] for r in rows)
    place = [(r["feature"], k + 1, k == 0 or rows[k - 1]["importance"] >= r["importance"]) for k, r in enumerate(rows)]
    top = TR.top_k_importance(imp, 10).select("feature", F.lit(True).alias("top"))
    return (spark.createDataFrame(place, "feature string, place int, descending boolean").join(imp, "feature").join(back, "feature", "left")
            .join(top, "feature", "left").select(
                "feature", F.lit(abs(total - 1.0) < 1e-9).alias("sums_to_one"), "descending",
                (F.abs(F.col("importance") - F.col("read")) < 1e-12).alias("same_in_csv"),
                (F.coalesce(F.col("top"), F.lit(False)) == (F.col("place") <= 10)).alias("top_agrees")))


@query("evaluation_records")
def q_evaluation_records(spark, sf):
    """The evaluation report against its own written predictions: rows of both splits and of every hour and weekday of
    the test rows, and whether the report's MAE is that of the predictions read back."""
    prep, model = _trained(spark, sf)
    rep = TR.evaluation_report(model, prep)
    path = scratch_path(spark, "evaluated")
    for split, rows in (("train", prep.train), ("test", prep.test)):
        TR.predict(model, rows).select("order_timestamp", "actual_eta_minutes", "predicted_eta_minutes").write.parquet(f"{path}/split={split}")
    log = spark.read.parquet(path).withColumn("error", F.abs(F.col("actual_eta_minutes") - F.col("predicted_eta_minutes")))
    sums = [F.count(F.lit(1)).alias("n_rows"), F.avg("error").alias("again")]
    test = log.filter("split = 'test'")
    hour, day = F.hour("order_timestamp"), F.weekday("order_timestamp")
    parts = [(rep.metrics.select(F.col("split").alias("part"), F.lit(-1).cast("long").alias("segment"), "mae", F.col("n").cast("long").alias("n")),
              log.groupBy(F.col("split").alias("part"), F.lit(-1).cast("long").alias("segment")).agg(*sums))]
    parts += [(seg.select(F.lit(name).alias("part"), F.col("segment").cast("long").alias("segment"), "mae", F.col("count").alias("n")),
               test.groupBy(F.lit(name).alias("part"), key.cast("long").alias("segment")).agg(*sums))
              for name, key, seg in (("hour_of_day", hour, rep.hour_segments), ("day_of_week", day, rep.dow_segments))]
    both = [a.join(b, ["part", "segment"], "full") for a, b in parts]
    return both[0].unionByName(both[1]).unionByName(both[2]).select(
        "part", "segment", "n", F.coalesce((F.col("n") == F.col("n_rows")) & (F.abs(F.col("mae") - F.col("again")) < 1e-9), F.lit(False)).alias("same_mae"),
        F.lit(len(prep.features)).cast("long").alias("n_features"))


# ---- 2.10 streaming (availableNow runs into file sinks) ------------------------------------

from ..streaming import jobs as ST  # noqa: E402


def _stream_paths(spark, name):
    return scratch_path(spark, f"{name}-sink"), scratch_path(spark, f"{name}-ckpt")


@query("stream_score_orders")
def q_stream_score(spark, sf):
    sink, ck = _stream_paths(spark, "score")
    out = ST.run_score_orders(spark, sf, sink, ck)
    return rounded(out.select("order_id", "is_valid", "raw_prediction", "predicted_eta_minutes"))


@query("stream_score_orders_model")
def q_stream_score_model(spark, sf):
    """Scoring with the fitted pipeline and the zone table, both inside the stream; every row is compared with its batch score."""
    prep, model = _trained(spark, sf)
    full = TR.scoring_model(prep, model)
    d = _d(spark, sf)
    mae = TR.evaluate(model, prep.test).first()["mae"]
    zones = scratch_path(spark, "zone-stats")
    _zone_stats_model(d)._tables["zone_id"].write.parquet(zones)
    sink, ck = _stream_paths(spark, "score-model")
    out = ST.run_score_orders(spark, sf, sink, ck, model=full, zone_path=zones, mae=mae, model_version="gbt-v1")
    batch = ST.score_orders(d, spark.read.parquet(zones), full, mae, "gbt-v1").select(
        "prediction_id", F.col("raw_prediction").alias("batch_prediction"))
    p, lo, hi = F.col("predicted_eta_minutes"), F.col("confidence_interval_lower"), F.col("confidence_interval_upper")
    return out.join(batch, "prediction_id", "left").select(
        "order_id", "prediction_id", "is_valid", "zone_stats_hit",
        F.coalesce(F.abs(F.col("raw_prediction") - F.col("batch_prediction")) < 1e-9, F.lit(False)).alias("equals_batch"),
        F.coalesce((lo <= p) & (p <= hi), F.lit(False)).alias("in_interval"))


@query("stream_prediction_metrics")
def q_stream_metrics(spark, sf):
    sink, ck = _stream_paths(spark, "metrics")
    return rounded(ST.run_prediction_metrics(spark, sf, sink, ck, "1 hour"))


@query("stream_feedback_join")
def q_stream_feedback(spark, sf):
    sink, ck = _stream_paths(spark, "feedback")
    return rounded(ST.run_feedback_join(spark, sf, sink, ck))


@query("stream_drift_batches")
def q_stream_drift(spark, sf):
    sink, ck = _stream_paths(spark, "drift")
    ref = _train(_d(spark, sf))
    out = ST.run_drift_batches(spark, sf, ref, DRIFT_NUMERIC, DRIFT_CATEGORICAL, sink, ck)
    return rounded(out.drop("drifted"))


# ---- schema-level operators (work still grows with the table) -------------------------------

@query("detect_feature_types")
def q_detect_types(spark, sf):
    d = _d(spark, sf)
    num, cat = C.detect_feature_types(d)
    kinds = [(c, "numeric") for c in num] + [(c, "categorical") for c in cat]
    counts = d.agg(*[F.count(c).alias(c) for c, _ in kinds]).first()
    # one row per detected column with its non-NULL count (computed over the whole table)
    return spark.createDataFrame([(c, k, int(counts[c])) for c, k in kinds], "column string, kind string, non_null long")


@query("drop_target")
def q_drop_target(spark, sf):
    return rounded(FE.drop_target(_d(spark, sf)))


@query("validate_schema")
def q_validate_schema(spark, sf):
    d = _d(spark, sf)
    ok, missing = RD.validate_schema(d, ["order_id", "order_timestamp", "pickup_lat", "pickup_lng", "dropoff_lat",
                                         "dropoff_lng", "actual_eta_minutes", "rider_id"])
    return d.agg(F.lit(ok).alias("is_valid"), F.lit(",".join(missing)).alias("missing"),
                 F.count(F.lit(1)).alias("n_rows"))


@query("load_model")
def q_load_model(spark, sf):
    """The model that a training run registered, found through its registry, against the one still at hand: every order,
    whether both predict the same, the features it was trained on, and whether the registry holds the test set's error."""
    from . import jobs as J

    prep, model = _trained(spark, sf)
    path = scratch_path(spark, "training-run")
    report = TR.evaluation_report(model, prep)
    J.save_run(spark, prep, model, report, path, "eta_model", "v1")
    loaded, entry = J.load_registered(spark, f"{path}/model_registry", "eta_model")
    mae = report.metrics.filter("split = 'test'").first()["mae"]
    d = _d(spark, sf)
    both = TR.predict(loaded, d).select("order_id", "predicted_eta_minutes").join(
        TR.predict(TR.scoring_model(prep, model), d).select("order_id", F.col("predicted_eta_minutes").alias("own")), "order_id")
    return both.select("order_id", F.col("predicted_eta_minutes").eqNullSafe(F.col("own")).alias("same"), F.lit(entry["version"]).alias("version"),
                       F.lit(len(entry["features"])).cast("long").alias("n_features"), F.lit(entry["mae"] == mae).alias("same_mae"))


@query("scan_dims_csv")
def q_scan_dims_csv(spark, sf):
    from pyspark.sql import types as T
    path = scratch_path(spark, "restaurants-csv")
    SK.write_csv(FX.restaurants(spark, sf), path)
    schema = T.StructType([T.StructField("restaurant_id", T.StringType()), T.StructField("zone_id", T.IntegerType()),
                           T.StructField("restaurant_type", T.StringType()), T.StructField("lat", T.DoubleType()),
                           T.StructField("lng", T.DoubleType()), T.StructField("base_prep_time", T.DoubleType()),
                           T.StructField("order_volume", T.LongType())])
    return rounded(RD.load_dimension(spark, path, "csv", schema))

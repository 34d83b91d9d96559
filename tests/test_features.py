"""Feature estimators: the reference's feature tests re-expressed, plus leakage/persistence invariants."""
import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from dropcast.constants import MODEL_FEATURES
from dropcast.operators import features as FE
from dropcast.sources import fixtures as FX

from conftest import SF01


@pytest.fixture(scope="module")
def orders(spark):
    """100 orders like the reference fixture: hourly from 2023-01-01, 4 zones, 3 types."""
    rng = np.random.default_rng(42)
    n = 100
    rows = []
    for i in range(n):
        rows.append((f"O{i:05d}", i, int(rng.integers(1, 5)), ["fast_food", "casual", "fine_dining"][i % 3],
                     f"R{i % 10:04d}", float(rng.uniform(37.7, 37.8)), float(rng.uniform(-122.5, -122.4)),
                     float(rng.uniform(37.7, 37.8)), float(rng.uniform(-122.5, -122.4)),
                     float(rng.uniform(0.8, 1.5)), ["clear", "rain", "cloudy"][i % 3], float(rng.uniform(1.0, 1.3)),
                     float(rng.uniform(5, 25)), float(rng.uniform(15, 35)), float(rng.uniform(0.8, 1.0)),
                     float(rng.uniform(10, 50))))
    df = spark.createDataFrame(rows, "order_id string, h int, zone_id int, restaurant_type string, restaurant_id string, "
                                     "pickup_lat double, pickup_lng double, dropoff_lat double, dropoff_lng double, "
                                     "traffic_multiplier double, weather_condition string, weather_multiplier double, "
                                     "prep_time_minutes double, rider_avg_speed_kmh double, rider_reliability double, "
                                     "actual_eta_minutes double")
    return df.withColumn("order_timestamp", F.expr("TIMESTAMP_NTZ'2023-01-01 00:00:00' + make_interval(0,0,0,0,h,0,0)")).drop("h")


def test_geo_features(orders):
    out = FE.GeoFeatures().fit(orders).transform(orders)
    for c in ["haversine_distance_km", "bearing", "bearing_sin", "bearing_cos", "lat_diff", "lng_diff",
              "manhattan_proxy", "dist_to_zone_centroid"]:
        assert c in out.columns
    r = out.agg(F.min("bearing"), F.max("bearing"), F.min("manhattan_proxy"), F.min("dist_to_zone_centroid")).first()
    assert 0 <= r[0] and r[1] < 360 and r[2] >= 0 and r[3] >= 0


def test_unknown_zone_centroid_is_zero(spark, orders):
    m = FE.GeoFeatures().fit(orders.filter("zone_id <= 2"))
    out = m.transform(orders).filter("zone_id > 2").agg(F.max("dist_to_zone_centroid")).first()[0]
    assert out == 0.0


def test_temporal_features(orders):
    out = FE.TemporalFeatures().transform(orders)
    r = out.agg(F.min("hour_of_day"), F.max("hour_of_day"), F.min("day_of_week"), F.max("day_of_week")).first()
    assert r[0] >= 0 and r[1] <= 23 and r[2] >= 0 and r[3] <= 6
    for c in ["is_morning_rush", "is_lunch_rush", "is_dinner_rush", "is_late_night", "is_weekend"]:
        assert set(x[0] for x in out.select(c).distinct().collect()) <= {0, 1}


def test_target_encoder_unseen_gets_global_mean(spark, orders):
    m = FE.TargetEncoder(columns=["zone_id"]).fit(orders)
    gm = orders.agg(F.avg("actual_eta_minutes")).first()[0]
    new = orders.limit(3).withColumn("zone_id", F.lit(999))
    vals = [r[0] for r in m.transform(new).select("zone_id_encoded").collect()]
    assert all(v == pytest.approx(gm) for v in vals)


def test_more_smoothing_lowers_variance(orders):
    def var(m):
        enc = FE.TargetEncoder(columns=["restaurant_id"], smoothing=m).fit(orders).transform(orders)
        return enc.agg(F.var_pop("restaurant_id_encoded")).first()[0]
    assert var(100.0) < var(1.0)


def test_min_samples_filters_rare_categories(orders):
    m = FE.TargetEncoder(columns=["restaurant_id"], minSamples=11).fit(orders)
    assert m._tables["restaurant_id"].count() == 0  # every restaurant has 10 rows


def test_group_stats_and_fills(orders):
    m = FE.GroupStats(keys=["zone_id"]).fit(orders.filter("zone_id <= 2"))
    out = m.transform(orders)
    r = out.agg(F.min("zone_id_eta_std"), F.min("zone_id_eta_mean")).first()
    assert r[0] >= 0 and r[1] > 0
    miss = out.filter("zone_id > 2").select("zone_id_order_count").distinct().collect()
    assert [x[0] for x in miss] == [0]
    assert out.filter(F.col("zone_id_eta_mean").isNull()).count() == 0


def test_pipeline_train_test_same_columns_and_no_nulls(orders):
    train = orders.filter("order_timestamp < TIMESTAMP_NTZ'2023-01-04 00:00:00'")
    test = orders.filter("order_timestamp >= TIMESTAMP_NTZ'2023-01-04 00:00:00'")
    model = FE.feature_pipeline().fit(train)
    a, b = model.transform(train), model.transform(test)
    assert a.columns == b.columns
    for c in ["haversine_distance_km", "zone_id_encoded", "zone_id_eta_mean", "weather_encoded"]:
        assert b.filter(F.col(c).isNull()).count() == 0
    assert set(MODEL_FEATURES) <= set(a.columns)


def test_one_row_and_missing_weather(orders):
    model = FE.feature_pipeline().fit(orders)
    one = orders.limit(1).drop("weather_condition")
    out = model.transform(one)
    assert out.count() == 1 and "weather_encoded" not in out.columns


def test_one_hot_of_a_vocabulary_wider_than_the_column_limit(spark, orders, tmp_path):
    names = [f"w{i:04d}" for i in range(5000)]
    rows = [(i, n) for i, n in enumerate(names)] + [(5000, "w0007"), (5001, None), (5002, "unseen")]
    df = spark.createDataFrame(rows, "i int, weather_condition string")
    model = FE.WeatherFeatures().fit(df.filter("i < 5001"))
    out = model.transform(df)
    assert out.columns == ["i", "weather_condition", "weather_encoded", "weather_multiplier", "weather_one_hot"]
    got = {r.i: r.weather_one_hot for r in out.select("i", "weather_one_hot").collect()}
    assert len(got) == 5003 and all(v.size == 4999 for v in got.values())
    assert all(list(got[i].indices) == [i - 1] and list(got[i].values) == [1.0] for i in range(1, 5000))
    assert list(got[5000].indices) == [6]
    assert all(len(got[i].indices) == 0 for i in (0, 5001, 5002))  # first category, NULL, unseen
    model.write().overwrite().save(str(tmp_path / "weather"))
    back = FE.WeatherFeaturesModel.load(str(tmp_path / "weather")).transform(df)
    assert {r.i: r.weather_one_hot for r in back.select("i", "weather_one_hot").collect()} == got


def test_sparse_one_hot_has_the_entries_of_the_columns(orders):
    wide = FE.WeatherFeatures().fit(orders).transform(orders)
    sparse = FE.WeatherFeatures(maxColumns=2).fit(orders).transform(orders)
    expected = {r.order_id: [r.weather_cloudy, r.weather_rain] for r in wide.collect()}  # clear is the first, dropped
    assert {r.order_id: list(r.weather_one_hot.toArray()) for r in sparse.collect()} == expected


def test_no_leak_train_features_independent_of_test(spark):
    d = FX.deliveries(spark, SF01)
    train = d.filter("order_timestamp < TIMESTAMP_NTZ'2024-01-16 00:00:00'")
    test = d.filter("order_timestamp >= TIMESTAMP_NTZ'2024-01-16 00:00:00'")
    m1 = FE.feature_pipeline().fit(train)
    m2 = FE.feature_pipeline().fit(train)
    a = m1.transform(train).select("order_id", "zone_id_encoded", "zone_id_eta_mean")
    shifted = test.withColumn("actual_eta_minutes", F.col("actual_eta_minutes") + 100)
    b = m2.transform(train.unionByName(shifted)).join(train.select("order_id"), "order_id").select(
        "order_id", "zone_id_encoded", "zone_id_eta_mean")
    assert a.exceptAll(b).count() == 0


def test_pipeline_save_load_roundtrip(spark, orders, tmp_path):
    model = FE.feature_pipeline(add_lag_features=True).fit(orders)
    path = str(tmp_path / "fp")
    model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    cols = ["order_id", "zone_id_encoded", "zone_id_eta_median", "dist_to_zone_centroid",
            "zone_id_actual_eta_minutes_lag_1", "zone_id_actual_eta_minutes_rolling_mean"]
    a = model.transform(orders).select(*cols)
    b = loaded.transform(orders).select(*cols)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_lag_features_match_pandas(spark, orders):
    m = FE.LagFeatures(groupCols=["zone_id"], lags=[1, 3]).fit(orders)
    got = m.transform(orders).select("order_id", "zone_id_actual_eta_minutes_lag_1", "zone_id_actual_eta_minutes_lag_3",
                                     "zone_id_actual_eta_minutes_rolling_mean").toPandas().set_index("order_id").sort_index()
    p = orders.toPandas().sort_values(["order_timestamp", "order_id"])
    mean = p.actual_eta_minutes.mean()
    g = p.groupby("zone_id")["actual_eta_minutes"]
    p["l1"] = g.shift(1).fillna(mean)
    p["l3"] = g.shift(3).fillna(mean)
    p["rm"] = g.transform(lambda x: x.shift(1).rolling(5, min_periods=1).mean()).fillna(mean)
    p = p.set_index("order_id").sort_index()
    assert np.allclose(got["zone_id_actual_eta_minutes_lag_1"], p["l1"])
    assert np.allclose(got["zone_id_actual_eta_minutes_lag_3"], p["l3"])
    assert np.allclose(got["zone_id_actual_eta_minutes_rolling_mean"], p["rm"])


def test_lag_buckets_give_same_result(spark, orders):
    """Tiny buckets force the context-row path (long groups split across window partitions)."""
    full = FE.lag_window_features(orders, "zone_id", "actual_eta_minutes", [1, 3, 7], 5, 30.0, bucket_rows=1 << 20)
    small = FE.lag_window_features(orders, "zone_id", "actual_eta_minutes", [1, 3, 7], 5, 30.0, bucket_rows=8)
    cols = [c for c in full.columns if "lag" in c or "rolling" in c] + ["order_id"]
    assert full.select(*cols).exceptAll(small.select(*cols)).count() == 0
    assert small.count() == orders.count()


def test_complete_features_and_drop_target(orders):
    out = FE.complete_features(FE.drop_target(orders), keep=["order_id"])
    assert out.columns == ["order_id"] + MODEL_FEATURES
    assert out.filter(F.col("hour_sin").isNotNull() & (F.col("hour_sin") == 0.0)).count() == out.count()


def test_concurrent_fit_equals_sequential_pipeline(orders):
    seq = FE.feature_pipeline().fit(orders)
    par = FE.fit_feature_pipeline(orders)
    cols = ["order_id", "zone_id_encoded", "restaurant_type_encoded", "zone_id_eta_mean", "zone_id_eta_median",
            "zone_id_eta_std", "dist_to_zone_centroid", "weather_encoded"]
    a, b = seq.transform(orders).select(*cols), par.transform(orders).select(*cols)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0

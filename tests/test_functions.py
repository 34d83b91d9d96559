"""Scalar column functions on hand-made rows (geo, calendar, weather, ETA)."""
import math

import pytest
from pyspark.sql import functions as F

from dropcast import functions as X


def _one(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


GEO_SCHEMA = "lat1 double, lng1 double, lat2 double, lng2 double"


def test_sf_oakland_distance(spark):
    d = _one(spark, [(37.7749, -122.4194, 37.8044, -122.2712)], GEO_SCHEMA,
             X.geodesic_km("lat1", "lng1", "lat2", "lng2"))[0]
    assert 10 < d < 16
    assert abs(d - 13.458) < 0.01  # ellipsoidal reference distance


def test_geodesic_vs_haversine_close(spark):
    rows = [(37.70, -122.50, 37.85, -122.35), (37.77, -122.42, 37.78, -122.41)]
    g = _one(spark, rows, GEO_SCHEMA, X.geodesic_km("lat1", "lng1", "lat2", "lng2"))
    h = _one(spark, rows, GEO_SCHEMA, X.haversine_km("lat1", "lng1", "lat2", "lng2"))
    for a, b in zip(g, h):
        assert abs(a - b) / a < 0.005


def test_zero_invalid_and_null_distance(spark):
    rows = [(37.77, -122.42, 37.77, -122.42), (100.0, -122.42, 37.78, -122.41), (None, -122.42, 37.78, -122.41)]
    d = _one(spark, rows, GEO_SCHEMA, X.geodesic_km("lat1", "lng1", "lat2", "lng2"))
    assert d[0] == pytest.approx(0.0, abs=0.01)
    assert d[1] == 0.0 and d[2] == 0.0


def test_bearing_range_and_encoding(spark):
    rows = [(37.7749, -122.4194, 37.8044, -122.2712), (37.77, -122.42, 37.78, -122.41), (37.8, -122.4, 37.7, -122.5)]
    df = spark.createDataFrame(rows, GEO_SCHEMA)
    b = X.bearing_deg("lat1", "lng1", "lat2", "lng2")
    out = df.select(b.alias("b"), X.bearing_sin(b).alias("s"), X.bearing_cos(b).alias("c"),
                    X.coordinate_diffs("lat1", "lng1", "lat2", "lng2")["manhattan_proxy"].alias("m")).collect()
    for r in out:
        assert 0 <= r.b < 360
        assert -1 <= r.s <= 1 and -1 <= r.c <= 1
        assert r.m >= 0
        assert r.s ** 2 + r.c ** 2 == pytest.approx(1.0)
    # north-east then south-west
    assert 0 < out[0].b < 90 and 180 < out[2].b < 270


def test_temporal_parts_and_flags(spark):
    df = spark.sql("SELECT explode(sequence(TIMESTAMP_NTZ'2024-01-01 00:00:00', TIMESTAMP_NTZ'2024-01-07 23:00:00', INTERVAL 1 HOUR)) AS ts")
    parts = X.temporal_parts("ts")
    out = df.select(*[c.alias(n) for n, c in parts.items()]).select("*", *[c.alias(n) for n, c in X.rush_flags().items()],
                                                                     X.weekend_flag().alias("is_weekend")).collect()
    assert {r.hour_of_day for r in out} == set(range(24))
    assert {r.day_of_week for r in out} == set(range(7))
    monday = [r for r in out if r.day_of_month == 1]
    assert all(r.day_of_week == 0 for r in monday)  # 2024-01-01 is a Monday
    for r in out:
        assert r.is_morning_rush == int(7 <= r.hour_of_day <= 9)
        assert r.is_lunch_rush == int(11 <= r.hour_of_day <= 14)
        assert r.is_dinner_rush == int(17 <= r.hour_of_day <= 21)
        assert r.is_late_night == int(r.hour_of_day >= 22 or r.hour_of_day <= 5)
        assert r.is_weekend == int(r.day_of_week >= 5)
    assert out[0].week_of_year == 1


def test_cyclical(spark):
    df = spark.createDataFrame([(0, 0, 1), (6, 3, 6), (23, 6, 12)], "hour_of_day int, day_of_week int, month int")
    out = df.select(*[c.alias(n) for n, c in X.cyclical_features().items()]).collect()
    assert out[0].hour_sin == pytest.approx(0.0, abs=1e-12) and out[0].hour_cos == pytest.approx(1.0)
    assert out[1].hour_sin == pytest.approx(1.0)


def test_weather(spark):
    df = spark.createDataFrame([("clear",), ("heavy_rain",), ("snow",), (None,)], "weather_condition string")
    out = df.select(X.weather_ordinal().alias("e"), X.weather_multiplier().alias("m")).collect()
    assert [r.e for r in out] == [0, 4, 0, 0]
    assert [r.m for r in out] == [1.0, 1.5, 1.0, 1.0]
    hot = X.weather_one_hot(["rain", "clear", "cloudy"])
    assert sorted(hot) == ["weather_cloudy", "weather_rain"]  # alphabetically first dropped
    out = df.select(*[c.alias(n) for n, c in hot.items()]).collect()
    assert all(v in (0, 1) for r in out for v in r)


def test_component_eta_floor_and_nulls(spark):
    df = spark.createDataFrame([(0.0, 1.0, 20.0, 1.0, 1.0), (10.0, 15.0, 20.0, 1.2, 1.3), (5.0, 10.0, None, 1.0, 1.0),
                                (5.0, 10.0, 0.0, 1.0, 1.0)], "d double, prep double, speed double, t double, w double")
    out = _one(spark, df.collect(), df.schema, X.component_eta("d", "prep", "speed", "t", "w"))
    assert out[0] == 5.0
    assert out[1] == pytest.approx(15 + 10 / 20 * 60 * 1.2 * 1.3 + 3)
    assert out[2] is None and out[3] is None


def test_traffic_profile_and_interval(spark):
    df = spark.createDataFrame([(8, 0, 30.0), (8, 6, 2.0)], "h int, dow int, p double")
    out = df.select(X.traffic_multiplier("h", "dow").alias("t"),
                    *[c.alias(n) for n, c in X.prediction_interval("p", 4.5).items()]).collect()
    assert out[0].t == pytest.approx(1.6) and out[1].t == pytest.approx(1.6 * 0.85)
    assert out[0].confidence_interval_lower == pytest.approx(23.3)
    assert out[1].confidence_interval_lower == 1.0  # floored at 1
    assert out[0].confidence_interval_upper == pytest.approx(36.8)


def test_ids_and_json(spark):
    df = spark.createDataFrame([(1, '{"zone_id_eta_mean": 21.5, "zone_id_order_count": 7}')], "n long, j string")
    r = df.select(X.format_id("R", "n", 4).alias("rid"), X.prediction_id(F.col("n")).alias("pid"),
                  X.parse_json_object("j", X.eta.STATS_JSON_SCHEMA).alias("s")).first()
    assert r.rid == "R0001" and len(r.pid) == 12
    assert r.s.zone_id_eta_mean == 21.5 and r.s.zone_id_order_count == 7 and r.s.zone_id_eta_std is None


def test_offset_point_roundtrip(spark):
    df = spark.createDataFrame([(37.77, -122.42, 2.0, 0.0)], "lat double, lng double, d double, a double")
    p = X.offset_point("lat", "lng", "d", "a")
    r = df.select(p["lat"].alias("la"), p["lng"].alias("lo")).first()
    assert r.la == pytest.approx(37.77 + 2 / 111) and r.lo == pytest.approx(-122.42)
    assert math.isfinite(r.la)

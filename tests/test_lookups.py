"""Request validation/defaults, lookups with defaults, joins."""
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from dropcast.operators import lookups as LK
from dropcast.streaming.jobs import score_orders

REQ = ("order_id string, order_timestamp timestamp_ntz, pickup_lat double, pickup_lng double, dropoff_lat double, "
       "dropoff_lng double, zone_id int, restaurant_type string, traffic_multiplier double, weather_condition string, "
       "prep_time_minutes double, rider_avg_speed_kmh double")


def _req(spark, rows):
    return spark.createDataFrame(rows, REQ)


def test_invalid_requests_rejected(spark):
    t = datetime(2024, 1, 1, 12)
    rows = [
        ("ok", t, 37.78, -122.40, 37.77, -122.41, 1, "casual", 1.2, "clear", 15.0, 25.0),
        ("lat", t, 100.0, -122.40, 37.77, -122.41, 1, "casual", 1.2, "clear", 15.0, 25.0),
        ("lng", t, 37.78, -200.0, 37.77, -122.41, 1, "casual", 1.2, "clear", 15.0, 25.0),
        ("traffic", t, 37.78, -122.40, 37.77, -122.41, 1, "casual", 5.0, "clear", 15.0, 25.0),
        ("missing", t, 37.78, None, 37.77, -122.41, 1, "casual", 1.2, "clear", 15.0, 25.0),
    ]
    out = {r.order_id: r for r in LK.request_validity(_req(spark, rows)).collect()}
    assert out["ok"].is_valid and out["ok"].errors == []
    for k in ["lat", "lng", "traffic", "missing"]:
        assert not out[k].is_valid
    assert out["missing"].errors == ["pickup_lng: missing"]


def test_minimal_request_gets_defaults(spark):
    rows = [("min", None, 37.78, -122.40, 37.77, -122.41, None, "", 0.0, None, None, None)]
    r = LK.request_defaults(_req(spark, rows), now=F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")).first()
    assert (r.zone_id, r.restaurant_type, r.traffic_multiplier, r.weather_condition, r.prep_time_minutes,
            r.rider_avg_speed_kmh, r.rider_reliability) == (1, "casual", 1.2, "clear", 15.0, 25.0, 0.95)
    assert r.order_time == datetime(2024, 2, 1)


@pytest.mark.parametrize("n", [0, 1, 2])
def test_batch_sizes_score_same_count(spark, n):
    t = datetime(2024, 1, 1, 12)
    rows = [(f"o{i}", t, 37.78, -122.40, 37.77, -122.41, 1, "casual", 1.2, "clear", 15.0, 25.0) for i in range(n)]
    out = score_orders(_req(spark, rows))
    assert out.count() == n
    if n:
        r = out.first()
        assert r.confidence_interval_lower <= r.predicted_eta_minutes <= r.confidence_interval_upper


def test_zone_lookup_defaults_on_miss(spark):
    stats = spark.createDataFrame([(1, 20.0, 19.0, 5.0, 10)],
                                  "zone_id int, zone_id_eta_mean double, zone_id_eta_median double, zone_id_eta_std double, zone_id_order_count long")
    df = spark.createDataFrame([(1,), (7,), (None,)], "zone_id int")
    out = {r.zone_id: r for r in LK.lookup_zone_stats_with_defaults(df, stats).collect()}
    assert out[1].zone_id_eta_mean == 20.0 and out[1].zone_stats_hit
    assert out[7].zone_id_eta_mean == 25.0 and out[7].zone_id_order_count == 1000 and not out[7].zone_stats_hit
    assert out[None].zone_id_eta_median == 23.0


def test_distance_matrix_of_requested_pairs(spark):
    o = spark.createDataFrame([(1, 37.77, -122.42), (2, None, -122.4)], "origin_idx long, lat double, lng double")
    d = spark.createDataFrame([("a", 37.78, -122.41), ("b", 37.80, -122.27)], "dest_idx string, lat double, lng double")
    pairs = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (3, "a")], "origin_idx long, dest_idx string")
    out = LK.distance_matrix(o, d, pairs).collect()
    # an origin with a missing coordinate and an unknown one are left out
    assert sorted((r.origin_idx, r.dest_idx) for r in out) == [(1, "a"), (1, "b")]
    assert all(r.distance_km > 0 for r in out)


def test_feedback_join_left(spark):
    p = spark.createDataFrame([("a", 20.0), ("b", 30.0)], "prediction_id string, predicted_eta_minutes double")
    a = spark.createDataFrame([("a", 25.0)], "prediction_id string, actual_eta_minutes double")
    out = {r.prediction_id: r for r in LK.join_prediction_feedback(p, a).collect()}
    assert out["a"].error == -5.0 and out["b"].actual_eta_minutes is None


def test_broadcast_bounds(spark):
    from dropcast.operators.joins import broadcast_ok, checked_broadcast, estimated_row_bytes
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("v", T.DoubleType())])
    assert estimated_row_bytes(schema) == 28
    assert broadcast_ok(1000, schema) and not broadcast_ok(3_000_000, schema)
    wide = T.StructType([T.StructField(f"s{i}", T.StringType()) for i in range(100)])
    assert not broadcast_ok(100_000, wide)  # few rows but wide: over the byte budget
    small = spark.createDataFrame([(1, 2.0)], schema)
    plan = spark.range(5).join(checked_broadcast(small.withColumnRenamed("k", "id")), "id")._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" in plan


def test_side_of_long_strings_is_not_broadcast(spark):
    from dropcast.operators.joins import checked_broadcast, measured_size

    side = spark.range(200).select(F.col("id").alias("k"), F.repeat(F.lit("x"), 10_000).alias("text"), F.array(F.col("id")).alias("list"))
    n, size = measured_size(side)
    assert n == 200 and size >= 200 * 10_000
    assert measured_size(side.limit(0))[0] == 0 and measured_size(side.withColumn("text", F.lit(None).cast("string")))[1] < 200 * 200
    joined = lambda s: spark.range(10).withColumnRenamed("id", "k").join(s, "k")._jdf.queryExecution().logical().toString()
    assert "broadcast" in joined(checked_broadcast(side))
    assert "broadcast" not in joined(checked_broadcast(side, max_bytes=1 << 20))  # 64 bytes a string would be within it

"""Cleaning operators on small frames, and invariants of the composite."""
import pytest
from pyspark.sql import functions as F

from dropcast.operators import clean as C
from dropcast.operators import metrics as M
from dropcast.sources import fixtures as FX

from conftest import SF01

SCHEMA = ("order_id string, order_timestamp timestamp_ntz, event_id long, weather_condition string, "
          "prep_time_minutes double, pickup_lat double, pickup_lng double, dropoff_lat double, dropoff_lng double, "
          "traffic_multiplier double, actual_eta_minutes double")


def _rows(spark):
    from datetime import datetime as dt
    rows = [
        ("O1", dt(2024, 1, 1, 10), 1, "rain", 10.0, 37.7, -122.4, 37.8, -122.3, 1.0, 20.0),
        ("O1", dt(2024, 1, 1, 11), 2, "clear", 99.0, 37.7, -122.4, 37.8, -122.3, 1.0, 25.0),  # later duplicate
        ("O2", dt(2024, 1, 1, 12), 3, None, None, 95.0, -122.4, 37.8, -122.3, 5.0, 200.0),  # bad lat
        ("O3", dt(2024, 1, 1, 13), 4, "clear", 20.0, None, -122.4, 37.8, -122.3, 0.1, 0.5),  # NULL lat kept
        ("O4", dt(2024, 1, 1, 14), 5, "rain", 30.0, 37.7, -122.4, 37.8, -122.3, 2.0, 30.0),
        (None, dt(2024, 1, 1, 15), 6, "clear", 40.0, 37.7, -122.4, 37.8, -122.3, 2.0, 30.0),
        (None, dt(2024, 1, 1, 16), 7, "clear", 40.0, 37.7, -122.4, 37.8, -122.3, 2.0, 30.0),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_dedupe_keeps_first_and_nulls_as_one(spark):
    out = C.dedupe_first(_rows(spark)).collect()
    ids = sorted((r.order_id or "") for r in out)
    assert ids == ["", "O1", "O2", "O3", "O4"]
    o1 = [r for r in out if r.order_id == "O1"][0]
    assert o1.event_id == 1
    assert M.duplicate_count(_rows(spark)).first().duplicates == 2


def test_impute_mode_ties_smallest_and_median(spark):
    df = C.dedupe_first(_rows(spark))
    res = C.impute_missing(df)
    # weather counts after dedupe: clear 2, rain 2 -> tie -> smallest 'clear'
    assert res.fills["weather_condition"] == "clear"
    assert res.fills["prep_time_minutes"] == pytest.approx(25.0)  # median of 10, 20, 30, 40
    assert res.df.filter(F.col("weather_condition").isNull()).count() == 0
    assert res.cells_filled == 3  # weather 1, prep 1, pickup_lat 1


def test_ranges_drop_coordinates_clip_others(spark):
    out = C.range_filter_or_clip(_rows(spark)).collect()
    assert all(r.order_id != "O2" for r in out)  # latitude 95 dropped
    assert any(r.order_id == "O3" for r in out)  # NULL latitude is not out of range
    o3 = [r for r in out if r.order_id == "O3"][0]
    assert o3.traffic_multiplier == 0.5 and o3.actual_eta_minutes == 1.0


def test_outlier_methods(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 100]], "actual_eta_minutes double")
    out, (lo, hi), _ = C.bounds_clip(df, method="iqr")
    assert (lo, hi) == (2 - 1.5 * 2, 4 + 1.5 * 2)
    assert max(r[0] for r in out.collect()) == 7.0
    _, (zlo, zhi), _ = C.bounds_clip(df, method="zscore")
    assert zlo < 22 < zhi
    _, b, _ = C.bounds_clip(df, method="bounds")
    assert b == (1.0, 180.0)


@pytest.mark.parametrize("method", ["bounds", "iqr"])
def test_cleaning_is_idempotent(spark, method):
    raw = FX.deliveries_raw(spark, SF01)
    once = C.clean_orders(raw, outlier_method=method).df
    twice = C.clean_orders(once, outlier_method=method).df
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0


def test_cleaning_ignores_input_row_order(spark):
    raw = FX.deliveries_raw(spark, SF01)
    shuffled = raw.repartition(13, F.rand(seed=3)).sortWithinPartitions(F.rand(seed=4))
    a = C.clean_orders(raw).df
    b = C.clean_orders(shuffled).df
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_clean_report_counts(spark):
    res = C.clean_orders(FX.deliveries_raw(spark, SF01))
    r = res.report
    assert r["original_rows"] == 11000 and r["duplicates_removed"] == 1000
    assert r["invalid_range_rows_removed"] == 100 and r["final_rows"] == 9900
    assert r["missing_values_filled"] > 0


def test_validate_and_profile(spark):
    v = C.validate_target(_rows(spark)).first()
    assert v["count"] == 7 and v.null_count == 0 and not v.is_valid  # 200 and 0.5 out of [1, 180]
    prof = {r.column: r for r in C.data_quality_profile(_rows(spark)).collect()}
    assert prof["prep_time_minutes"].null_count == 1
    assert prof["order_id"].mean is None and prof["actual_eta_minutes"].max == 200.0
    assert C.detect_feature_types(_rows(spark))[1] == ["order_id", "weather_condition"]


def test_coerce_bad_text(spark):
    df = spark.createDataFrame([("2024-01-01 10:00:00", "3", "1.5", "true"), ("nope", "x", "n/a", "maybe")],
                               "order_timestamp string, zone_id string, prep_time_minutes string, is_weekend string")
    out = C.coerce_types(df).collect()
    assert out[0].zone_id == 3 and out[0].prep_time_minutes == 1.5 and out[0].is_weekend is True
    assert out[1].order_timestamp is None and out[1].zone_id is None and out[1].prep_time_minutes is None

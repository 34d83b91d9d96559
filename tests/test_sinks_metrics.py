"""Sinks (insert-if-absent, change stamps, registry, logs) and metric aggregates on small frames."""
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from dropcast.operators import metrics as M
from dropcast.sources import readers as RD
from dropcast.sources import sinks as SK


def test_insert_if_absent_keeps_existing(spark):
    old = spark.createDataFrame([(1, 10.0), (2, 20.0)], "zone_id int, v double")
    new = spark.createDataFrame([(2, 99.0), (3, 30.0)], "zone_id int, v double")
    out = {r.zone_id: r.v for r in SK.insert_if_absent(old, new, ["zone_id"]).collect()}
    assert out == {1: 10.0, 2: 20.0, 3: 30.0}


def test_touch_updated_at(spark):
    t0 = datetime(2024, 1, 1)
    old = spark.createDataFrame([(1, 5, t0), (2, 6, t0), (3, 7, t0)], "k int, v int, updated_at timestamp_ntz")
    new = spark.createDataFrame([(1, 5), (2, 60), (4, 8)], "k int, v int")
    out = {r.k: r for r in SK.touch_updated_at(old, new, ["k"], ["v"], "2024-02-01 00:00:00").collect()}
    assert out[1].updated_at == t0 and out[3].updated_at == t0  # unchanged / not in new
    assert out[2].v == 60 and out[2].updated_at == datetime(2024, 2, 1)
    assert out[4].updated_at == datetime(2024, 2, 1)


def test_registry_unique_versions(spark):
    reg = spark.createDataFrame([("m", "v1", "prod")], "model_name string, version string, stage string")
    inc = spark.createDataFrame([("m", "v1", "staging"), ("m", "v2", "staging")], "model_name string, version string, stage string")
    out = sorted((r.version, r.stage) for r in SK.register_model_version(reg, inc).collect())
    assert out == [("v1", "prod"), ("v2", "staging")]


def test_csv_roundtrip_keeps_microseconds(spark, tmp_path):
    df = spark.createDataFrame([("O1", datetime(2024, 1, 1, 0, 0, 7, 179123))], "order_id string, order_timestamp timestamp_ntz")
    path = str(tmp_path / "c")
    SK.write_csv(df, path)
    back = RD.load_csv_orders(spark, path, df.schema).first()
    assert back.order_timestamp == datetime(2024, 1, 1, 0, 0, 7, 179123)


def test_load_training_data_falls_back_and_validates(spark, tmp_path):
    df = spark.createDataFrame([(f"O{i}", datetime(2024, 1, 1 + i % 20), float(i)) for i in range(1200)],
                               "order_id string, order_timestamp timestamp_ntz, actual_eta_minutes double")
    path = str(tmp_path / "p")
    SK.write_parquet(df, path)
    out = RD.load_training_data(spark, {"url": "jdbc:none://x", "dbtable": "t"}, path, "parquet", "2024-01-05", "2024-01-10")
    assert out.count() == 6 * 60  # inclusive both ends
    assert RD.load_validated(out, min_rows=100) is out
    with pytest.raises(ValueError):
        RD.load_validated(out, min_rows=1000)
    with pytest.raises(ValueError):
        RD.load_training_data(spark, {"url": "jdbc:none://x", "dbtable": "t"}, None)
    assert RD.validate_schema(out, ["order_id", "nope"]) == (False, ["nope"])


def test_load_training_data_raises_what_is_no_connection_error(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.createDataFrame([("O1", datetime(2024, 1, 1))], "order_id string, order_timestamp timestamp_ntz").write.parquet(path)
    with pytest.raises(Exception, match="dbtable|query"):  # a wrong request, not an unreachable database
        RD.load_training_data(spark, {"url": "jdbc:none://x"}, path)
    with pytest.raises(ValueError, match="partitionColumn"):
        RD.load_training_data(spark, {"url": "jdbc:none://x", "dbtable": "t", "numPartitions": "8"}, path)


def test_unreachable_tells_connection_errors_from_others(spark):
    sql = spark.sparkContext._jvm.java.sql
    assert RD._unreachable(sql.SQLException("gone", "08006"))
    assert not RD._unreachable(sql.SQLException("password", "28P01"))
    assert RD._unreachable(spark.sparkContext._jvm.java.lang.RuntimeException(sql.SQLException("no driver", "08001")))
    assert RD._unreachable(spark.sparkContext._jvm.java.net.ConnectException("refused"))
    assert not RD._unreachable(spark.sparkContext._jvm.java.lang.RuntimeException("other"))


def test_attached_row_without_rows_is_null(spark):
    df = spark.createDataFrame([(1,), (2,)], "a int")
    one = spark.createDataFrame([(0.1, "x")], "m double, s string")
    assert [tuple(r) for r in M.attach_row(df, one).collect()] == [(1, 0.1, "x"), (2, 0.1, "x")]
    assert [tuple(r) for r in M.attach_row(df, one.limit(0)).collect()] == [(1, None, None), (2, None, None)]
    assert "Cartesian" not in M.attach_row(df, one)._jdf.queryExecution().toString()


def test_regression_metrics_match_numpy(spark):
    rng = np.random.default_rng(5)
    y = rng.uniform(10, 60, 500)
    p = y + rng.normal(0, 5, 500)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "actual_eta_minutes double, predicted_eta_minutes double")
    r = M.regression_metrics(df).first()
    e = y - p
    assert r.mae == pytest.approx(np.mean(np.abs(e)))
    assert r.rmse == pytest.approx(np.sqrt(np.mean(e * e)))
    assert r.r2 == pytest.approx(1 - np.sum(e * e) / np.sum((y - y.mean()) ** 2))
    assert r.std_error == pytest.approx(np.std(e)) and r.mean_error == pytest.approx(np.mean(e))
    assert r.p90_error == pytest.approx(np.percentile(np.abs(e), 90))
    assert r.within_5min_pct == pytest.approx(np.mean(np.abs(e) <= 5) * 100)


def test_histogram_and_buckets(spark):
    df = spark.createDataFrame([(float(v), 0.0) for v in [0, 1, 2, 3, 10]], "actual_eta_minutes double, predicted_eta_minutes double")
    h = {(r.kind, r.bin): r["count"] for r in M.error_histogram(df, bins=5).collect()}
    assert h[("error", 0)] == 2 and h[("error", 1)] == 2 and h[("error", 4)] == 1  # max lands in the last bin
    log = df.select(F.col("actual_eta_minutes").alias("v"))
    b = {r.le: r["count"] for r in M.cumulative_buckets(log, "v", [1, 5], "m").collect()}
    assert b == {"1.0": 2, "5.0": 4, "+Inf": 5}


def test_segment_min_count(spark):
    df = spark.createDataFrame([("a", 10.0, 12.0)] * 3 + [("b", 10.0, 20.0)], "s string, actual_eta_minutes double, predicted_eta_minutes double")
    out = M.segment_metrics_min_count(df, "s", min_count=2).collect()
    assert [r.segment for r in out] == ["a"] and out[0].median_ae == 2.0

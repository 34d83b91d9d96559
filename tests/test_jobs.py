"""End-to-end batch jobs: clean -> train -> score -> monitor on derived sf0.001 orders."""
import json
import os

from pyspark.sql import functions as F

from dropcast.plans import jobs as J
from dropcast.sources import fixtures as FX

from conftest import SF01


def test_jobs_end_to_end(spark, tmp_path):
    raw = str(tmp_path / "raw")
    FX.deliveries_raw(spark, SF01).write.parquet(raw)
    rep = J.clean_job(spark, raw, str(tmp_path / "clean"))
    assert rep["cleaning"]["final_rows"] > 0 and "in_range_pct" in rep["target_validation"]
    clean = str(tmp_path / "clean" / "orders")
    small = dict(n_estimators=4, learning_rate=0.2, max_depth=3, min_child_samples=5, subsample=1.0,
                 colsample_bytree=1.0)
    out = J.train_job(spark, clean, str(tmp_path / "model"), params=small, cv_folds=2)
    assert set(out["metrics"]) == {"train", "test"} and "mae_mean" in out["cv"]
    assert os.path.isdir(tmp_path / "model" / "model")
    reg = spark.read.parquet(str(tmp_path / "model" / "model_registry"))
    assert reg.count() == 1
    J.train_job(spark, clean, str(tmp_path / "model"), params=small)  # same version again: registry stays unique
    assert spark.read.parquet(str(tmp_path / "model" / "model_registry")).count() == 1
    scored = J.score_job(spark, clean, str(tmp_path / "model" / "model"), str(tmp_path / "scored"))
    assert scored.count() == spark.read.parquet(clean).count()
    assert scored.filter(F.col("predicted_eta_minutes").isNull()).count() == 0
    ref = str(tmp_path / "ref")
    cur = str(tmp_path / "cur")
    s = spark.read.parquet(clean).withColumn("predicted_eta_minutes", F.col("actual_eta_minutes") + 1)
    s.filter("order_timestamp < TIMESTAMP_NTZ'2024-01-16 00:00:00'").write.parquet(ref)
    s.filter("order_timestamp >= TIMESTAMP_NTZ'2024-01-16 00:00:00'").write.parquet(cur)
    m = J.monitor_job(spark, ref, cur, str(tmp_path / "mon"), numeric=["traffic_multiplier", "prep_time_minutes"],
                      categorical=["weather_condition"])
    assert "should_retrain" in m["retrain"] and m["report"]["n_tests"] == 3
    text = spark.read.text(str(tmp_path / "mon" / "monitoring_report")).first()[0]
    assert json.loads(text)["retrain"]["n_reasons"] >= 0

"""Streaming runs (availableNow) equal the batch result."""
from pyspark.sql import functions as F

from dropcast.plans import catalog as CAT
from dropcast.session import scratch_path
from dropcast.streaming import jobs as ST

from conftest import SF001


def test_stream_scoring_equals_batch(spark):
    sink, ck = scratch_path(spark, "t-sink"), scratch_path(spark, "t-ck")
    streamed = ST.run_score_orders(spark, SF001, sink, ck).select("order_id", "raw_prediction")
    batch = ST.score_orders(CAT._d(spark, SF001)).select("order_id", "raw_prediction")
    assert streamed.count() == batch.count() > 0
    assert streamed.exceptAll(batch).count() == 0


def test_stream_feedback_matches_batch_join_for_matched_rows(spark):
    sink, ck = scratch_path(spark, "t-fb"), scratch_path(spark, "t-fbck")
    out = ST.run_feedback_join(spark, SF001, sink, ck)
    matched = out.filter(F.col("actual_eta_minutes").isNotNull())
    d = CAT._d(spark, SF001)
    exp = d.filter((F.col("event_id") % 3 != 0) & (F.floor("actual_eta_minutes") <= 180)).count()
    assert matched.count() == exp
    assert out.select("prediction_id").distinct().count() == out.count()


def test_stream_windowed_metrics(spark):
    sink, ck = scratch_path(spark, "t-m"), scratch_path(spark, "t-mck")
    out = ST.run_prediction_metrics(spark, SF001, sink, ck)
    assert out.count() > 0
    assert out.filter(F.col("window_end") <= F.col("window_start")).count() == 0


def test_stream_scoring_with_fitted_pipeline(spark):
    """The fitted features + imputer + GBT PipelineModel runs inside a streaming query."""
    from dropcast.plans import training as TR

    prep = TR.prepare_data(CAT._d(spark, SF001))
    small = dict(n_estimators=3, learning_rate=0.3, max_depth=3, min_child_samples=5, subsample=1.0, colsample_bytree=1.0)
    model = TR.scoring_model(prep, TR.train_gbt(prep.train, prep.features, TR.gbt_params(**small)))
    sink, ck = scratch_path(spark, "t-gbt"), scratch_path(spark, "t-gbtck")
    out = ST.run_score_orders(spark, SF001, sink, ck, model=model)
    batch = ST.score_orders(CAT._d(spark, SF001), model=model)
    assert out.count() == batch.count() > 0
    assert out.filter(F.col("raw_prediction").isNull()).count() == 0
    a = out.select("order_id", F.round("raw_prediction", 9).alias("p"))
    b = batch.select("order_id", F.round("raw_prediction", 9).alias("p"))
    assert a.exceptAll(b).count() == 0


def _rows(df):
    return sorted(tuple(f"{v:.9f}" if isinstance(v, float) else str(v) for v in r) for r in df.collect())


def test_files_in_any_order_lose_no_row(spark, tmp_path):
    """Event times that are mixed over part files, read one file a batch, give the rows of one batch over all."""
    spark.read.parquet(f"{SF001}/events.parquet").repartition(4, F.hash("event_id")).write.parquet(
        f"{tmp_path}/events.parquet")
    for run in (ST.run_prediction_metrics, ST.run_feedback_join, ST.run_score_orders):
        one = run(spark, SF001, scratch_path(spark, "t-one"), scratch_path(spark, "t-oneck"))
        many = run(spark, str(tmp_path), scratch_path(spark, "t-many"), scratch_path(spark, "t-manyck"),
                   max_files_per_trigger=1)
        assert _rows(one.select(sorted(one.columns))) == _rows(many.select(sorted(one.columns)))
    total = spark.read.parquet(f"{SF001}/events.parquet").count()
    metrics = ST.run_prediction_metrics(spark, str(tmp_path), scratch_path(spark, "t-c"), scratch_path(spark, "t-cck"))
    assert metrics.agg(F.sum("count")).first()[0] == total
    feedback = ST.run_feedback_join(spark, str(tmp_path), scratch_path(spark, "t-f"), scratch_path(spark, "t-fck"))
    assert feedback.count() == total


def _parts(spark, tmp_path, n=3):
    spark.read.parquet(f"{SF001}/events.parquet").repartition(n, F.hash("event_id")).write.parquet(f"{tmp_path}/events.parquet")
    return str(tmp_path)


def test_drift_batches_read_the_reference_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def mark(v):
        seen.add(1)
        return v

    d = CAT._d(spark, SF001)
    ref = d.filter("order_timestamp < TIMESTAMP_NTZ'2024-01-16 00:00:00'")
    n = ref.count()
    counted = ref.withColumn("zone_id", mark("zone_id"))
    sink, ck = scratch_path(spark, "t-d"), scratch_path(spark, "t-dck")
    folder = _parts(spark, tmp_path)
    out = ST.run_drift_batches(spark, folder, counted, ["zone_id", "prep_time_minutes"], ["weather_condition"], sink, ck,
                               max_files_per_trigger=1)
    rows = {r.batch_id: r for r in out.collect()}
    assert len(rows) == 3 and seen.value == n
    assert sum(r.n_current_samples for r in rows.values()) == d.count()
    assert {r.n_reference_samples for r in rows.values()} == {n}

    # a later run knows the reference by its stored counts alone, and gives what a plain comparison gives
    sink2, ck2 = scratch_path(spark, "t-d2"), scratch_path(spark, "t-d2ck")
    again = ST.run_drift_batches(spark, SF001, None, ["zone_id", "prep_time_minutes"], ["weather_condition"], sink2, ck2,
                                 counts_path=f"{ck}/reference_counts").drop("batch_id")
    plain = ST.DR.dataset_drift(ref, d, ["zone_id", "prep_time_minutes"], ["weather_condition"])
    assert seen.value == n
    assert _rows(again.select(plain.columns)) == _rows(plain)


def test_refreshed_zone_table_is_used_from_the_next_batch_on(spark, tmp_path):
    folder, zones = _parts(spark, tmp_path), str(tmp_path / "zones")
    schema = "zone_id int, zone_id_eta_mean double"
    sink, ck = scratch_path(spark, "t-z"), scratch_path(spark, "t-zck")
    spark.createDataFrame([(1, 20.0)], schema).write.parquet(zones)
    first = ST.run_score_orders(spark, folder, sink, ck, zone_path=zones)
    assert first.filter("zone_stats_hit AND zone_id <> 1").count() == 0 < first.filter("zone_stats_hit").count()
    n, hits = first.count(), first.filter("zone_stats_hit").count()
    # new orders and a table with another zone; the stored rows stay as they were scored
    spark.createDataFrame([(1, 20.0), (2, 30.0)], schema).write.mode("overwrite").parquet(zones)
    spark.read.parquet(f"{SF001}/events.parquet").limit(500).withColumn("event_id", F.col("event_id") + 10**8).coalesce(1).write.mode(
        "append").parquet(f"{tmp_path}/events.parquet")
    second = ST.run_score_orders(spark, folder, sink, ck, zone_path=zones)
    assert second.count() == n + 500
    assert second.filter("zone_stats_hit AND zone_id = 1").count() > hits
    assert second.filter("zone_stats_hit AND zone_id = 2").count() > 0

"""Structured Streaming jobs: scoring, windowed prediction metrics, late feedback
join and per-batch drift. Each job takes a streaming source DataFrame and
writes to a fault-tolerant file sink with a checkpoint location; ``run_*``
helpers drive them with ``trigger(availableNow=True)`` for batch-like runs.

A batch holds at most ``FILES_PER_BATCH`` new files unless told otherwise, so that a backlog is not one batch.
No job has a watermark: what a batch writes (rows, partial sums, drift rows) is
merged on read, so no row is too late in whatever order the files arrive.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import functions as X
from ..operators import drift as DR
from ..operators import lookups as LK
from ..sources.fixtures import deliveries_from_events

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])

FILES_PER_BATCH = 1000
GEO = ("pickup_lat", "pickup_lng", "dropoff_lat", "dropoff_lng")


def events_stream(spark: SparkSession, folder: str, max_files_per_trigger: int | None = FILES_PER_BATCH) -> DataFrame:
    """File stream of the event table in ``folder``: one file ``events.parquet`` or a folder of part files
    (declared schema, no inference). With the limit None, all files that are there are one batch."""
    reader = spark.readStream.format("parquet").schema(EVENTS_SCHEMA)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(f"{folder.rstrip('/')}/events.parquet*")


def score_orders(orders: DataFrame, zone_stats: DataFrame | None = None, model: PipelineModel | None = None,
                 mae: float = 4.5, model_version: str = "baseline") -> DataFrame:
    """Stateless scoring: validity -> defaults -> static lookups -> prediction -> interval -> id.

    With ``zone_stats``, ``zone_stats_hit`` says whether the order's zone was found there."""
    v = LK.request_validity(orders)
    now = F.col("order_timestamp") if "order_timestamp" in orders.columns else F.localtimestamp()
    v = LK.request_defaults(v, now=now)
    if "order_timestamp" not in v.columns:
        v = v.withColumn("order_timestamp", F.col("order_time"))
    if zone_stats is not None:
        v = LK.lookup_zone_stats_with_defaults(v, zone_stats)
    if model is not None:
        scored = model.transform(v).drop("features")
    else:
        if "weather_multiplier" not in v.columns:
            v = v.withColumn("weather_multiplier", X.weather_multiplier("weather_condition"))
        scored = v.withColumn("predicted_eta_minutes", X.component_eta(
            X.geodesic_km(*GEO), "prep_time_minutes", "rider_avg_speed_kmh", "traffic_multiplier", "weather_multiplier"))
    iv = X.prediction_interval("predicted_eta_minutes", mae)
    return scored.select(
        X.prediction_id(F.col("order_id"), F.lit(model_version)).alias("prediction_id"),
        "order_id", "order_timestamp", "zone_id", "is_valid",
        F.col("predicted_eta_minutes").alias("raw_prediction"),
        *[c.alias(n) for n, c in iv.items()],
        F.lit(model_version).alias("model_version"),
        *(["zone_stats_hit"] if zone_stats is not None else []),
    )


def metric_partials(scored: DataFrame, window: str = "1 hour") -> DataFrame:
    """Counts and prediction sums per tumbling window, status and model version; they add up over batches."""
    s = scored.withColumn("status", F.when(F.col("is_valid"), F.lit("success")).otherwise(F.lit("error")))
    agg = (s.groupBy(F.window(F.col("order_timestamp").cast("timestamp"), window), "status", "model_version")
           .agg(F.count(F.lit(1)).alias("rows"), F.count("raw_prediction").alias("predictions"),
                F.sum("raw_prediction").alias("total")))
    return agg.select(F.col("window.start").cast("timestamp_ntz").alias("window_start"),
                      F.col("window.end").cast("timestamp_ntz").alias("window_end"),
                      "status", "model_version", "rows", "predictions", "total")


def prediction_metrics(partials: DataFrame) -> DataFrame:
    """Count and mean prediction per window, status and model version, over the partials of all batches."""
    return partials.groupBy("window_start", "window_end", "status", "model_version").agg(
        F.sum("rows").alias("count"), F.try_divide(F.sum("total"), F.sum("predictions")).alias("avg_predicted"))


def feedback_join(predictions: DataFrame, actuals: DataFrame, max_delay: str = "3 hours") -> DataFrame:
    """Every stored prediction with its actual in [pred_ts, pred_ts + max_delay], however late that arrived;
    NULL where there is none (so far)."""
    p = predictions.select("prediction_id", "pred_ts", "predicted_eta_minutes")
    a = actuals.select(F.col("prediction_id").alias("a_prediction_id"), "actual_ts", "actual_eta_minutes")
    cond = ((F.col("prediction_id") == F.col("a_prediction_id"))
            & (F.col("actual_ts") >= F.col("pred_ts"))
            & (F.col("actual_ts") <= F.col("pred_ts") + F.expr(f"INTERVAL {max_delay}")))
    return p.join(a, cond, "leftOuter").select(
        "prediction_id", "pred_ts", "predicted_eta_minutes", "actual_eta_minutes",
        (F.col("predicted_eta_minutes") - F.col("actual_eta_minutes")).alias("error"))


def _run(df: DataFrame, sink: str, checkpoint: str, mode: str = "append", timeout_s: int | None = None) -> None:
    q = (df.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint)
         .outputMode(mode).trigger(availableNow=True).start())
    q.awaitTermination() if timeout_s is None else q.awaitTermination(timeout_s)
    if q.isActive:
        q.stop()
        raise TimeoutError("streaming query did not finish within the time budget")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def _run_batches(df: DataFrame, per_batch, sink: str, checkpoint: str) -> None:
    """Write ``per_batch`` of each micro-batch to a folder of that batch: a batch that runs again after a
    failure replaces its rows instead of adding them twice."""

    def write(batch: DataFrame, epoch_id: int) -> None:
        per_batch(batch).write.mode("overwrite").parquet(f"{sink.rstrip('/')}/batch_id={int(epoch_id)}")

    q = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def run_score_orders(spark: SparkSession, folder: str, sink: str, checkpoint: str, zone_stats: DataFrame | None = None,
                     model: PipelineModel | None = None, max_files_per_trigger: int | None = FILES_PER_BATCH,
                     zone_path: str | None = None, mae: float = 4.5, model_version: str = "baseline") -> DataFrame:
    """Score the orders as they come, with the fitted ``model`` or else by components.

    ``zone_stats`` is one table for the whole run; ``zone_path`` names a Parquet table that every batch reads anew, so
    that statistics refreshed meanwhile are used from the next batch on."""
    orders = deliveries_from_events(events_stream(spark, folder, max_files_per_trigger))
    if zone_path is None:
        _run(score_orders(orders, zone_stats, model, mae, model_version), sink, checkpoint)
        return spark.read.parquet(sink)
    _run_batches(orders, lambda batch: score_orders(batch, spark.read.parquet(zone_path), model, mae, model_version),
                 sink, checkpoint)
    return spark.read.parquet(sink).drop("batch_id")


def run_prediction_metrics(spark: SparkSession, folder: str, sink: str, checkpoint: str, window: str = "1 hour",
                           max_files_per_trigger: int | None = FILES_PER_BATCH) -> DataFrame:
    """Partials per micro-batch, merged on read: no row is late, and all windows come out, the last ones too."""
    orders = deliveries_from_events(events_stream(spark, folder, max_files_per_trigger))
    _run_batches(score_orders(orders), lambda batch: metric_partials(batch, window), sink, checkpoint)
    return prediction_metrics(spark.read.parquet(sink))


def run_feedback_join(spark: SparkSession, folder: str, sink: str, checkpoint: str,
                      max_files_per_trigger: int | None = FILES_PER_BATCH) -> DataFrame:
    """Predictions and actuals are appended to one table each by streams of their own and joined on read."""
    ev = events_stream(spark, folder, max_files_per_trigger)
    orders = deliveries_from_events(ev)
    preds = score_orders(orders).select("prediction_id", F.col("order_timestamp").alias("pred_ts"),
                                        F.col("raw_prediction").alias("predicted_eta_minutes"))
    ev2 = events_stream(spark, folder, max_files_per_trigger).filter(F.col("event_id") % 3 != 0)
    acts = deliveries_from_events(ev2).select(
        X.prediction_id(F.col("order_id"), F.lit("baseline")).alias("prediction_id"),
        (F.col("order_timestamp") + F.make_dt_interval(mins=F.floor("actual_eta_minutes").cast("int"))).alias("actual_ts"),
        "actual_eta_minutes")
    tables = [f"{sink.rstrip('/')}/{name}" for name in ("predictions", "actuals")]
    for df, path, name in zip((preds, acts), tables, ("predictions", "actuals")):
        _run(df, path, f"{checkpoint.rstrip('/')}/{name}")
    return feedback_join(*[spark.read.parquet(path) for path in tables])


def store_reference(reference: DataFrame, numeric: list[str], categorical: list[str], path: str) -> None:
    """The value counts of the reference, written once and read by every batch of the drift job."""
    DR.reference_counts(reference, numeric, categorical).write.mode("overwrite").parquet(path)


def run_drift_batches(spark: SparkSession, folder: str, reference: DataFrame | None, numeric: list[str],
                      categorical: list[str], sink: str, checkpoint: str, counts_path: str | None = None,
                      max_files_per_trigger: int | None = FILES_PER_BATCH) -> DataFrame:
    """foreachBatch: dataset drift of each micro-batch against the reference, appended per batch.

    The reference is read once, for its value counts at ``counts_path`` (by default a folder of the checkpoint); with
    ``reference`` None the counts that ``store_reference`` left there before are used."""
    counts_path = counts_path or f"{checkpoint.rstrip('/')}/reference_counts"
    if reference is not None:
        store_reference(reference, numeric, categorical, counts_path)
    stored = spark.read.parquet(counts_path)
    orders = deliveries_from_events(events_stream(spark, folder, max_files_per_trigger))

    def drift(batch: DataFrame) -> DataFrame:
        vc = DR.value_counts_with(stored, batch, numeric, categorical)
        return DR.dataset_drift_from_counts(vc, numeric, categorical)

    _run_batches(orders, drift, sink, checkpoint)
    return spark.read.parquet(sink).withColumn("batch_id", F.col("batch_id").cast("long"))

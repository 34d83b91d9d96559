"""Evaluation metrics and monitoring aggregates (all single-pass aggregations
with map-side partial aggregation; exact percentiles go through ``rank``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import (
    ERROR_PERCENTILES,
    LATENCY_BUCKETS,
    PREDICTED_ETA_BUCKETS,
    PREDICTION_ERROR_BUCKETS,
    SEGMENT_MIN_COUNT,
    SERVING_LATENCY_BUCKETS,
    SERVING_PREDICTED_BUCKETS,
    WITHIN_K_MINUTES,
)
from .rank import exact_percentiles, grouped_percentiles

MACHINE_EPS = 2.220446049250313e-16


def exact_sum(c: Column) -> Column:
    """Sum of doubles through DECIMAL(38,10): exact and independent of row order, so a
    total over billions of rows does not depend on partitioning (returned as double)."""
    return F.sum(c.cast("decimal(38,10)")).cast("double")


def round_significant(c: Column, digits: int = 12) -> Column:
    """Round to ``digits`` significant digits (for metrics whose magnitude can be huge,
    e.g. MAPE when some actuals are 0: decimals beyond double precision carry no value)."""
    k = F.floor(F.log10(F.abs(c))) + 1 - digits
    up = F.round(c / F.pow(F.lit(10.0), k)) * F.pow(F.lit(10.0), k)
    down = F.round(c * F.pow(F.lit(10.0), -k)) / F.pow(F.lit(10.0), -k)
    return F.when(c.isNull() | (c == 0), c).when(k >= 0, up).otherwise(down)


def attach_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row frame to every row as constants (NULL where that frame has no row)."""
    row = one_row.first()
    return df.withColumns({f.name: F.lit(None if row is None else row[f.name]).cast(f.dataType) for f in one_row.schema})


def residuals(df: DataFrame, actual: str, predicted: str, keys: list[str] | tuple = ()) -> DataFrame:
    e = F.col(actual) - F.col(predicted)
    return df.select(*keys, F.col(actual).alias("actual"), F.col(predicted).alias("predicted"),
                     e.alias("residual"), F.abs(e).alias("abs_error"))


_METRIC_NAMES = ["n", "mae", "rmse", "r2", "mape", "mean_error", "std_error", "max_error"] + [
    f"within_{k}min_pct" for k in WITHIN_K_MINUTES]


def _metric_aggs(y: Column, p: Column, aliased: bool = True) -> list[Column]:
    e = y - p
    ae = F.abs(e)
    aggs = [
        F.count(F.lit(1)),
        F.avg(ae),
        F.sqrt(F.avg(e * e)),
        F.lit(1.0) - F.try_divide(F.sum(e * e), F.var_pop(y) * F.count(F.lit(1))),
        F.avg(ae / F.greatest(F.abs(y), F.lit(MACHINE_EPS))) * 100.0,
        F.avg(e),
        F.stddev_pop(e),
        F.max(ae),
    ] + [F.avg((ae <= k).cast("double")) * 100.0 for k in WITHIN_K_MINUTES]
    return [a.alias(n) for a, n in zip(aggs, _METRIC_NAMES)] if aliased else aggs


def regression_metrics(df: DataFrame, actual: str = "actual_eta_minutes", predicted: str = "predicted_eta_minutes",
                       with_percentiles: bool = True) -> DataFrame:
    """One row: n, MAE, RMSE, R2, MAPE, mean/std/max error, within-k %, median AE and AE percentiles.

    Error = actual - predicted. R2 = 1 - SSE / (n * var_pop(actual)). With
    percentiles, the moments and the exact percentiles come from one
    aggregation over the ranked rows (one read of the input).
    """
    base = df.select(F.col(actual).cast("double").alias("_y"), F.col(predicted).cast("double").alias("_p"))
    aggs = _metric_aggs(F.col("_y"), F.col("_p"))
    if not with_percentiles:
        return base.agg(*aggs)
    probs = [0.5] + [p / 100.0 for p in ERROR_PERCENTILES]
    names = ["median_ae"] + [f"p{p}_error" for p in ERROR_PERCENTILES]
    with_ae = base.withColumn("_ae", F.abs(F.col("_y") - F.col("_p")))
    extra = dict(zip(_METRIC_NAMES, _metric_aggs(F.col("_y"), F.col("_p"), aliased=False)))
    return exact_percentiles(with_ae, "_ae", probs, names=names, carry=["_y", "_p"], extra_aggs=extra)


def within_k_pct(df: DataFrame, abs_error: str = "abs_error", ks: list[int] = WITHIN_K_MINUTES) -> DataFrame:
    return df.agg(*[(F.avg((F.col(abs_error) <= k).cast("double")) * 100.0).alias(f"within_{k}min_pct") for k in ks])


def error_percentiles(df: DataFrame, abs_error: str = "abs_error", ps: list[int] = ERROR_PERCENTILES) -> DataFrame:
    return exact_percentiles(df, abs_error, [p / 100.0 for p in ps], names=[f"p{p}_error" for p in ps])


def segment_metrics(df: DataFrame, segment: str, actual: str = "actual_eta_minutes",
                    predicted: str = "predicted_eta_minutes", min_count: int | None = None) -> DataFrame:
    """Per segment: mae, median_ae, std_ae, count, avg/std actual, within-5 %; ordered by mae.

    Moments come from one aggregation, the exact medians from refined bucket counts of all
    segments at once (a hot segment is combined map-side like any other).
    """
    base = df.select(F.col(segment).alias("segment"), F.col(actual).alias("_y"),
                     F.abs(F.col(actual) - F.col(predicted)).alias("_ae"))
    extra = {
        "mae": F.avg("_ae"),
        "std_ae": F.stddev_samp("_ae"),
        "count": F.count(F.lit(1)),
        "avg_actual_eta": F.avg("_y"),
        "std_actual_eta": F.stddev_samp("_y"),
        "within_5min_pct": F.avg((F.col("_ae") <= 5).cast("double")) * 100.0,
    }
    out = grouped_percentiles(base, "_ae", [0.5], ["segment"], names=["median_ae"], carry=["_y"], extra_aggs=extra)
    if min_count is not None:
        out = out.filter(F.col("count") >= min_count)
    out = out.select("segment", "mae", "median_ae", "std_ae", "count", "avg_actual_eta", "std_actual_eta",
                     "within_5min_pct")
    return out.orderBy("mae", "segment")


def segment_metrics_min_count(df: DataFrame, segment: str, min_count: int = SEGMENT_MIN_COUNT, **kw) -> DataFrame:
    return segment_metrics(df, segment, min_count=min_count, **kw)


def error_histogram(df: DataFrame, actual: str = "actual_eta_minutes", predicted: str = "predicted_eta_minutes",
                    bins: int = 50) -> DataFrame:
    """Equal-width histogram of signed and absolute error: (kind, bin, lower, upper, count), empty bins included."""
    e = F.col(actual) - F.col(predicted)
    long = df.select(F.explode(F.array(
        F.struct(F.lit("error").alias("kind"), e.alias("v")),
        F.struct(F.lit("abs_error").alias("kind"), F.abs(e).alias("v")),
    )).alias("kv")).select("kv.kind", "kv.v").filter(F.col("v").isNotNull())
    rng = long.groupBy("kind").agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    j = long.join(F.broadcast(rng), "kind")  # two rows
    width = (F.col("hi") - F.col("lo")) / bins
    b = F.least(F.coalesce(F.floor(F.try_divide(F.col("v") - F.col("lo"), width)), F.lit(0)), F.lit(bins - 1)).cast("int")
    h = j.withColumn("bin", b).groupBy("kind", "bin").agg(F.count(F.lit(1)).alias("n"))
    grid = rng.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return grid.join(h, ["kind", "bin"], "left").select(
        "kind", "bin", (F.col("lo") + F.col("bin") * width).alias("lower"),
        (F.col("lo") + (F.col("bin") + 1) * width).alias("upper"), F.coalesce("n", F.lit(0)).alias("count"))


def cumulative_buckets(df: DataFrame, value: str, bounds: list[float], metric: str) -> DataFrame:
    """Cumulative 'le' buckets plus +Inf, sum and count in one pass: (metric, le, count) rows."""
    v = F.col(value)
    aggs = [F.count_if(v <= F.lit(float(b))).alias(f"b{i}") for i, b in enumerate(bounds)]
    aggs += [F.count(v).alias("inf"), exact_sum(v).alias("sum")]
    row = df.agg(*aggs)
    entries = [F.struct(F.lit(str(float(b))).alias("le"), F.col(f"b{i}").cast("long").alias("count"))
               for i, b in enumerate(bounds)]
    entries.append(F.struct(F.lit("+Inf").alias("le"), F.col("inf").cast("long").alias("count")))
    return row.select(F.lit(metric).alias("metric"), F.explode(F.array(*entries)).alias("b"),
                      F.col("sum").alias("sum"), F.col("inf").alias("total")).select(
        "metric", "b.le", "b.count", "sum", "total")


def prediction_histograms(log: DataFrame, latency: str = "latency_s", predicted: str = "predicted_eta_minutes",
                          actual: str = "actual_eta_minutes", bucket_set: str = "monitoring") -> DataFrame:
    """Cumulative buckets for latency, predicted minutes and signed error (predicted - actual),
    all from one aggregation pass over the log. ``bucket_set='serving'`` uses the
    serving-side latency and predicted-minute bounds (no error histogram there)."""
    if bucket_set == "serving":
        specs = [("prediction_latency_seconds", F.col(latency), SERVING_LATENCY_BUCKETS),
                 ("predicted_eta_minutes", F.col(predicted), SERVING_PREDICTED_BUCKETS)]
    else:
        specs = [("prediction_latency_seconds", F.col(latency), LATENCY_BUCKETS),
                 ("predicted_eta_minutes", F.col(predicted), PREDICTED_ETA_BUCKETS),
                 ("prediction_error_minutes", F.col(predicted) - F.col(actual), PREDICTION_ERROR_BUCKETS)]
    aggs = []
    for m, (_, v, bounds) in enumerate(specs):
        aggs += [F.count_if(v <= F.lit(float(b))).alias(f"m{m}_b{i}") for i, b in enumerate(bounds)]
        aggs += [F.count(v).alias(f"m{m}_inf"), exact_sum(v).alias(f"m{m}_sum")]
    row = log.agg(*aggs)
    entries = []
    for m, (name, _, bounds) in enumerate(specs):
        for i, b in enumerate(list(bounds) + ["+Inf"]):
            cnt = F.col(f"m{m}_inf") if b == "+Inf" else F.col(f"m{m}_b{i}")
            entries.append(F.struct(F.lit(name).alias("metric"), F.lit("+Inf" if b == "+Inf" else str(float(b))).alias("le"),
                                    cnt.cast("long").alias("count"), F.col(f"m{m}_sum").alias("sum"),
                                    F.col(f"m{m}_inf").alias("total")))
    return row.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def abs_error_summary(log: DataFrame, predicted: str = "predicted_eta_minutes", actual: str = "actual_eta_minutes") -> DataFrame:
    ae = F.abs(F.col(predicted) - F.col(actual))
    return log.agg(exact_sum(ae).alias("abs_error_sum"), F.count(ae).alias("abs_error_count"))


def cv_summary(fold_metrics: DataFrame, metrics: tuple = ("mae", "rmse", "r2")) -> DataFrame:
    aggs = []
    for m in metrics:
        aggs += [F.avg(m).alias(f"{m}_mean"), F.stddev_pop(m).alias(f"{m}_std")]
    return fold_metrics.agg(*aggs)


def duplicate_count(df: DataFrame, key: str = "order_id") -> DataFrame:
    """Rows that are not the first of their key (all NULL keys form one group)."""
    k = F.col(key)
    return df.agg(
        (F.count(F.lit(1)) - F.count_distinct(k) - F.max(F.when(k.isNull(), 1).otherwise(0))).cast("long").alias("duplicates")
    )


def prediction_counter(log: DataFrame) -> DataFrame:
    return log.groupBy("status", "model_version").agg(F.count(F.lit(1)).alias("count"))


def request_counter(access_log: DataFrame) -> DataFrame:
    return access_log.groupBy("method", "endpoint", "status_code").agg(F.count(F.lit(1)).alias("count"))


def request_latency_hist(access_log: DataFrame, bounds: list[float]) -> DataFrame:
    """Cumulative latency buckets per (method, endpoint)."""
    v = F.col("latency_s")
    aggs = [F.count_if(v <= F.lit(float(b))).alias(f"b{i}") for i, b in enumerate(bounds)]
    g = access_log.groupBy("method", "endpoint").agg(*aggs, F.count(v).alias("inf"), exact_sum(v).alias("sum"))
    entries = [F.struct(F.lit(str(float(b))).alias("le"), F.col(f"b{i}").cast("long").alias("count"))
               for i, b in enumerate(bounds)]
    entries.append(F.struct(F.lit("+Inf").alias("le"), F.col("inf").cast("long").alias("count")))
    return g.select("method", "endpoint", F.explode(F.array(*entries)).alias("b"), "sum").select(
        "method", "endpoint", "b.le", "b.count", "sum")


def last_value_gauges(log: DataFrame, ts: str = "request_timestamp", group: str = "model_version") -> DataFrame:
    """Latest prediction time and the value logged at that time, per model version."""
    return log.groupBy(group).agg(
        F.max(ts).alias("last_prediction_ts"),
        F.max_by("predicted_eta_minutes", F.struct(F.col(ts), F.col("prediction_id"))).alias("last_predicted_eta"),
        F.count(F.lit(1)).alias("n_predictions"),
    )


def monitoring_gauges(drift: DataFrame, n_features: int) -> DataFrame:
    """(gauge, value) of the latest state: drift flag as 0 or 1, share of drifted columns, features of the model.

    ``drift`` is the one row of a drift report; a share that is not known counts as no drift and a NULL share."""
    pairs = {"data_drift_detected": F.coalesce(F.col("drift_detected").cast("double"), F.lit(0.0)),
             "data_drift_share": F.col("drift_share").cast("double"), "model_feature_count": F.lit(float(n_features))}
    return drift.select(F.explode(F.array(*[F.struct(F.lit(name).alias("gauge"), value.alias("value"))
                                            for name, value in pairs.items()])).alias("g")).select("g.*")


def feature_quality_counters(df: DataFrame, ranges: dict[str, tuple]) -> DataFrame:
    """Missing and out-of-range counts per feature (NULL is missing, never out of range)."""
    cols = [c for c in ranges if c in df.columns]
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("v"),
                 F.lit(float(ranges[c][0])).alias("lo"), F.lit(float(ranges[c][1])).alias("hi"))
        for c in cols])).alias("kv")).select("kv.*")
    return long.groupBy("feature").agg(
        F.count_if(F.col("v").isNull()).alias("missing_count"),
        F.count_if((F.col("v") < F.col("lo")) | (F.col("v") > F.col("hi"))).alias("out_of_range_count"),
    )


def lookup_hit_rate(joined: DataFrame, lookup_type: str, key: str, marker: str) -> DataFrame:
    """Hits (the lookup side matched) and misses after a LEFT join, one row per lookup type."""
    return joined.agg(
        F.lit(lookup_type).alias("lookup_type"),
        F.count_if(F.col(marker).isNotNull()).alias("hits"),
        F.count_if(F.col(marker).isNull()).alias("misses"),
    )

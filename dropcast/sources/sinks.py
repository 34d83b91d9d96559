"""Sinks: files, keyed tables with insert-if-absent, registries and logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# Microsecond text timestamps so CSV round trips keep full precision.
CSV_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    (df.write.mode(mode).option("header", True).option("timestampNTZFormat", CSV_TS_FORMAT)
     .option("timestampFormat", CSV_TS_FORMAT).csv(path))
    return path


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> str:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).json(path)
    return path


def insert_if_absent(existing: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``incoming`` whose key is absent from ``existing`` are added (ON CONFLICT DO NOTHING)."""
    new_rows = incoming.join(existing.select(*keys).distinct(), keys, "left_anti")
    return existing.unionByName(new_rows, allowMissingColumns=True)


def touch_updated_at(old: DataFrame, new: DataFrame, keys: list[str], value_cols: list[str], as_of,
                     updated_col: str = "updated_at") -> DataFrame:
    """Merge ``new`` into ``old``: changed or inserted rows get ``updated_at = as_of``.

    Unchanged rows keep their timestamp; rows only in ``old`` stay as they are.
    """
    o = old.select(*keys, *[F.col(c).alias(f"_o_{c}") for c in value_cols], F.col(updated_col).alias("_o_upd"))
    n = new.select(*keys, *[F.col(c).alias(f"_n_{c}") for c in value_cols], F.lit(True).alias("_in_new"))
    j = o.join(n, keys, "full_outer")
    changed = F.lit(False)
    for c in value_cols:
        changed = changed | ~F.col(f"_o_{c}").eqNullSafe(F.col(f"_n_{c}"))
    in_new = F.coalesce(F.col("_in_new"), F.lit(False))
    stamp = F.lit(as_of).cast(old.schema[updated_col].dataType)
    cols = [F.when(in_new, F.col(f"_n_{c}")).otherwise(F.col(f"_o_{c}")).alias(c) for c in value_cols]
    upd = F.when(in_new & (changed | F.col("_o_upd").isNull()), stamp).otherwise(F.col("_o_upd")).alias(updated_col)
    return j.select(*keys, *cols, upd)


def register_model_version(registry: DataFrame, entry: DataFrame) -> DataFrame:
    """Append (model_name, version, ...) rows; (model_name, version) stays unique."""
    return insert_if_absent(registry, entry, ["model_name", "version"])


def drift_report_row(column_scores: DataFrame, report_ts, drift_share_threshold: float = 0.5) -> DataFrame:
    """One report row with ``array<string>`` of drifted columns from a per-column drift table."""
    return column_scores.agg(
        F.lit(report_ts).cast("timestamp_ntz").alias("report_timestamp"),
        (F.avg(F.col("drift_detected").cast("double")) >= drift_share_threshold).alias("drift_detected"),
        F.avg(F.col("drift_detected").cast("double")).alias("drift_share"),
        F.array_sort(F.collect_list(F.when(F.col("drift_detected"), F.col("column")))).alias("drifted_columns"),
        F.count(F.lit(1)).alias("n_columns"),
    )


def prediction_log(scored: DataFrame, feature_cols: list[str], id_col: str = "prediction_id",
                   ts_col: str = "order_timestamp", model_version: str = "unknown") -> DataFrame:
    """Scored rows in log layout with the features as a JSON object."""
    return scored.select(
        F.col(id_col).alias("prediction_id"),
        F.col(ts_col).alias("request_timestamp"),
        "pickup_lat", "pickup_lng", "dropoff_lat", "dropoff_lng",
        "restaurant_id", "zone_id",
        F.col("predicted_eta_minutes"),
        F.lit(model_version).alias("model_version"),
        F.to_json(F.struct(*feature_cols)).alias("features_json"),
    )

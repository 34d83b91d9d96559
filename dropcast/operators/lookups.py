"""Lookups and request handling: stats with defaults, star join, distance matrix,
feedback join, request validity and defaults."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import functions as X
from ..constants import (
    FALLBACK_SPEED_KMH,
    REQUEST_DEFAULTS,
    REQUEST_RANGES,
    REQUIRED_REQUEST_COLUMNS,
    ZONE_STATS_DEFAULTS,
)
from .joins import checked_broadcast

ZONE_STAT_COLUMNS = ["zone_id_eta_mean", "zone_id_eta_median", "zone_id_eta_std", "zone_id_order_count"]


def lookup_zone_stats_with_defaults(df: DataFrame, zone_stats: DataFrame, known_rows: int | None = None) -> DataFrame:
    """LEFT join per-zone statistics; a miss or absent zone gets the serving defaults.

    ``zone_stats`` has zone_id plus any of the stat columns (and optional encodings).
    Adds ``zone_stats_hit`` (true when the zone was found).
    """
    stat_cols = [c for c in ZONE_STATS_DEFAULTS if c in zone_stats.columns]
    side = zone_stats.select("zone_id", *stat_cols, F.lit(True).alias("zone_stats_hit"))
    j = df.join(checked_broadcast(side, known_rows=known_rows), "zone_id", "left")
    cols = {c: F.coalesce(F.col(c), F.lit(v)) for c, v in ZONE_STATS_DEFAULTS.items() if c in stat_cols}
    for c, v in ZONE_STATS_DEFAULTS.items():
        if c not in stat_cols:
            cols[c] = F.lit(v)
    cols["zone_stats_hit"] = F.coalesce(F.col("zone_stats_hit"), F.lit(False))
    return j.withColumns(cols)


def enrich_orders_with_dims(facts: DataFrame, dims: list[tuple[DataFrame, str | list[str]]]) -> DataFrame:
    """Star join: each dimension LEFT-joined on its key, broadcast only when its size is proven small."""
    out = facts
    for dim, key in dims:
        out = out.join(checked_broadcast(dim), key, "left")
    return out


def distance_matrix(origins: DataFrame, destinations: DataFrame, pairs: DataFrame,
                    speed_kmh: float = FALLBACK_SPEED_KMH) -> DataFrame:
    """Requested origin-destination pairs with geodesic distance and duration at a fixed speed.

    ``pairs`` names the entries of the matrix that are wanted; both sides are joined to it by their index, so
    nothing larger than the request is made. Pairs with missing coordinates are left out (status not OK).
    Inputs: origins(origin_idx, lat, lng), destinations(dest_idx, lat, lng), pairs(origin_idx, dest_idx).
    """
    o = origins.select(F.col("origin_idx"), F.col("lat").alias("o_lat"), F.col("lng").alias("o_lng"))
    d = destinations.select(F.col("dest_idx"), F.col("lat").alias("d_lat"), F.col("lng").alias("d_lng"))
    pairs = pairs.select("origin_idx", "dest_idx").join(o, "origin_idx").join(d, "dest_idx")
    ok = F.col("o_lat").isNotNull() & F.col("o_lng").isNotNull() & F.col("d_lat").isNotNull() & F.col("d_lng").isNotNull()
    km = X.geodesic_km("o_lat", "o_lng", "d_lat", "d_lng")
    minutes = km / speed_kmh * 60.0
    return pairs.filter(ok).select("origin_idx", "dest_idx", km.alias("distance_km"), minutes.alias("duration_minutes"),
                                   (minutes * 1.2).alias("duration_in_traffic_minutes"))


def join_prediction_feedback(predictions: DataFrame, actuals: DataFrame) -> DataFrame:
    """Late actuals matched to logged predictions (LEFT join on prediction_id); error = predicted - actual."""
    a = actuals.select("prediction_id", F.col("actual_eta_minutes"))
    j = predictions.join(a, "prediction_id", "left")
    return j.withColumn("error", F.col("predicted_eta_minutes") - F.col("actual_eta_minutes"))


def request_validity(df: DataFrame) -> DataFrame:
    """Adds ``errors`` (array of reasons) and ``is_valid``; coordinates are required."""
    checks: list[Column] = []
    for c in REQUIRED_REQUEST_COLUMNS:
        if c in df.columns:
            checks.append(F.when(F.col(c).isNull(), F.lit(f"{c}: missing")))
        else:
            checks.append(F.lit(f"{c}: missing"))
    for c, (lo, hi) in REQUEST_RANGES.items():
        if c in df.columns:
            checks.append(F.when((F.col(c) < lo) | (F.col(c) > hi), F.lit(f"{c}: out of range [{lo}, {hi}]")))
    errors = F.array_compact(F.array(*checks))
    return df.withColumn("errors", errors).withColumn("is_valid", F.size("errors") == 0)


def request_defaults(df: DataFrame, now: Column | None = None) -> DataFrame:
    """Missing optional fields take the serving defaults; as in Python ``or``, empty
    strings and zeros count as missing. The order time defaults to ``now``."""
    now = now if now is not None else F.localtimestamp()
    cols = {}
    for c, v in REQUEST_DEFAULTS.items():
        if c not in df.columns:
            cols[c] = F.lit(v)
            continue
        col = F.col(c)
        if isinstance(v, str):
            cols[c] = F.coalesce(F.nullif(col, F.lit("")), F.lit(v))
        else:
            cols[c] = F.coalesce(F.nullif(col, F.lit(0).cast(df.schema[c].dataType)), F.lit(v).cast(df.schema[c].dataType))
    if "order_time" in df.columns:
        cols["order_time"] = F.coalesce(F.col("order_time"), now)
    else:
        cols["order_time"] = now
    return df.withColumns(cols)

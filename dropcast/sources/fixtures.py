"""Adapters that derive delivery-order tables from the driver's generic tables.

``deliveries``      clean orders derived row-for-row from ``events``
``deliveries_raw``  the same with injected defects and duplicated rows
All derivations are column expressions on a parquet scan, so they prune and
push down like any other scan and grow with the source table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.eta import format_id

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _scaled(eid: Column, mult: int, base: float, span: float) -> Column:
    return F.lit(base) + (eid * mult % 1000) / F.lit(1000.0) * F.lit(span)


def _case(eid: Column, values: list) -> Column:
    expr = None
    for i, v in enumerate(values):
        expr = (F.when(eid % len(values) == i, F.lit(v)) if expr is None else expr.when(eid % len(values) == i, F.lit(v)))
    return expr


WEATHER_CYCLE = ["clear", "cloudy", "rain", "heavy_rain", "fog"]
WEATHER_CYCLE_MULT = [1.0, 1.05, 1.3, 1.5, 1.15]


def deliveries_from_events(events: DataFrame) -> DataFrame:
    eid = F.col("event_id")
    uid = F.col("user_id")
    return events.select(
        format_id("O", eid, 7).alias("order_id"),
        eid.alias("event_id"),
        F.col("ts").alias("order_timestamp"),
        format_id("R", uid % 50, 4).alias("restaurant_id"),
        (uid % 8 + 1).cast("int").alias("zone_id"),
        F.col("event_type").alias("restaurant_type"),
        _scaled(eid, 7919, 37.70, 0.15).alias("pickup_lat"),
        _scaled(eid, 10007, -122.52, 0.17).alias("pickup_lng"),
        _scaled(eid, 5261, 37.70, 0.15).alias("dropoff_lat"),
        _scaled(eid, 3571, -122.52, 0.17).alias("dropoff_lng"),
        (F.lit(15.0) + eid % 20).alias("rider_avg_speed_kmh"),
        (F.lit(0.85) + (eid % 15) / F.lit(100.0)).alias("rider_reliability"),
        (F.lit(0.5) + (eid % 26) / F.lit(10.0)).alias("traffic_multiplier"),
        _case(eid, WEATHER_CYCLE).alias("weather_condition"),
        _case(eid, WEATHER_CYCLE_MULT).alias("weather_multiplier"),
        (F.lit(3.0) + (eid % 40) / F.lit(2.0)).alias("prep_time_minutes"),
        F.col("value").alias("actual_eta_minutes"),
    )


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean delivery orders (one per event)."""
    return deliveries_from_events(table(spark, sf_dir, "events"))


def deliveries_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty orders: bad latitudes/traffic, missing weather/prep, duplicated ids."""
    clean = deliveries(spark, sf_dir)
    eid = F.col("event_id")
    dirty = clean.withColumns(
        {
            "pickup_lat": F.when(eid % 101 == 0, F.lit(95.0)).otherwise(F.col("pickup_lat")),
            "traffic_multiplier": F.when(eid % 53 == 0, F.lit(5.0)).otherwise(F.col("traffic_multiplier")),
            "weather_condition": F.when(eid % 17 == 0, F.lit(None).cast("string")).otherwise(F.col("weather_condition")),
            "prep_time_minutes": F.when(eid % 19 == 0, F.lit(None).cast("double")).otherwise(F.col("prep_time_minutes")),
        }
    )
    dupes = clean.filter(eid % 10 == 0).withColumn(
        "order_timestamp", F.col("order_timestamp") + F.expr("INTERVAL 1 MINUTE")
    )
    return dirty.unionByName(dupes)


def restaurants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Restaurant dimension derived from the orders (one row per restaurant)."""
    d = deliveries(spark, sf_dir)
    return d.groupBy("restaurant_id").agg(
        F.min("zone_id").alias("zone_id"),
        F.min("restaurant_type").alias("restaurant_type"),
        F.avg("pickup_lat").alias("lat"),
        F.avg("pickup_lng").alias("lng"),
        F.avg("prep_time_minutes").alias("base_prep_time"),
        F.count(F.lit(1)).alias("order_volume"),
    )


def riders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rider dimension derived from the event users."""
    ev = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    return ev.groupBy("user_id").agg(
        F.avg(F.lit(15.0) + eid % 20).alias("avg_speed_kmh"),
        F.avg(F.lit(0.85) + (eid % 15) / F.lit(100.0)).alias("reliability_score"),
        F.count(F.lit(1)).alias("completed_deliveries"),
    ).select(format_id("D", F.col("user_id"), 4).alias("rider_id"), "avg_speed_kmh", "reliability_score", "completed_deliveries")

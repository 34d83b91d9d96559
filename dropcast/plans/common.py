"""Helpers shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import component_eta, geodesic_km

DIGITS = 6


SIGNIFICANT = {"mape": 12}  # metrics that can be astronomically large (MAPE with zero actuals)


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every double column (results are compared across engines); a few
    unbounded metrics are rounded to significant digits instead."""
    from ..operators.metrics import round_significant

    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if not isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(c)
        elif f.name in SIGNIFICANT:
            cols.append(round_significant(c, SIGNIFICANT[f.name]).alias(f.name))
        else:
            cols.append(F.round(c, digits).alias(f.name))
    return df.select(*cols)


def with_component_prediction(df: DataFrame, out: str = "predicted_eta_minutes") -> DataFrame:
    """Baseline predictor: component ETA from geodesic distance and the order's factors."""
    dist = geodesic_km("pickup_lat", "pickup_lng", "dropoff_lat", "dropoff_lng")
    return df.withColumn(out, component_eta(dist, "prep_time_minutes", "rider_avg_speed_kmh",
                                            "traffic_multiplier", "weather_multiplier"))

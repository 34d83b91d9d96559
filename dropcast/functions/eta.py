"""ETA formulas, identifiers and small conversions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import (
    ETA_FLOOR_MINUTES,
    ETA_OVERHEAD_MINUTES,
    FALLBACK_SPEED_KMH,
    FALLBACK_TRAFFIC_BUFFER,
    HOURLY_TRAFFIC,
    INTERVAL_DEFAULT_MAE,
    INTERVAL_MAE_FACTOR,
    WEEKEND_TRAFFIC_FACTOR,
)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _lit_or_col(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def traffic_multiplier(hour="hour_of_day", dow="day_of_week") -> Column:
    """Hourly traffic profile, x0.85 on weekends (noise-free)."""
    profile = F.array(*[F.lit(float(v)) for v in HOURLY_TRAFFIC])
    base = F.coalesce(F.try_element_at(profile, (_c(hour) + 1).cast("int")), F.lit(1.0))
    return base * F.when(_c(dow) >= 5, F.lit(WEEKEND_TRAFFIC_FACTOR)).otherwise(F.lit(1.0))


def component_eta(distance_km, prep, speed, traffic, weather_mult, overhead=ETA_OVERHEAD_MINUTES) -> Column:
    """max(5, prep + distance/speed*60*traffic*weather + overhead); NULL input or speed 0 -> NULL.

    ``total`` sits in the (always evaluated) CASE condition, so the distance
    expression inside it is eligible for common-subexpression elimination;
    a heavy expression only inside a CASE branch would not be.
    """
    travel = F.try_divide(_c(distance_km), _c(speed)) * 60.0 * _c(traffic) * _c(weather_mult)
    total = _c(prep) + travel + _lit_or_col(overhead)
    return F.when(total.isNull(), F.lit(None).cast("double")).otherwise(F.greatest(F.lit(ETA_FLOOR_MINUTES), total))


def baseline_eta(distance_km, speed_kmh: float = FALLBACK_SPEED_KMH, source: str = "haversine_fallback") -> Column:
    """Fallback estimate at a fixed speed: struct(duration, duration_in_traffic, distance, source)."""
    d = _c(distance_km)
    minutes = d / float(speed_kmh) * 60.0
    return F.struct(
        minutes.alias("duration_minutes"),
        (minutes * FALLBACK_TRAFFIC_BUFFER).alias("duration_in_traffic_minutes"),
        d.alias("distance_km"),
        F.lit(source).alias("source"),
    )


def seconds_to_minutes(s) -> Column:
    return _c(s) / 60.0


def metres_to_km(m) -> Column:
    return _c(m) / 1000.0


def prediction_interval(pred, mae=INTERVAL_DEFAULT_MAE, factor: float = INTERVAL_MAE_FACTOR) -> dict[str, Column]:
    """Rounded prediction with lower = max(1, p - 1.5*MAE) and upper = p + 1.5*MAE."""
    p = _c(pred)
    m = F.coalesce(_lit_or_col(mae).cast("double"), F.lit(INTERVAL_DEFAULT_MAE))
    return {
        "predicted_eta_minutes": F.round(p, 1),
        "confidence_interval_lower": F.round(F.greatest(F.lit(1.0), p - m * factor), 1),
        "confidence_interval_upper": F.round(p + m * factor, 1),
    }


def prediction_id(*parts) -> Column:
    """Deterministic 12-hex identifier from the given columns."""
    return F.substring(F.md5(F.concat_ws("-", *[_c(p).cast("string") for p in parts])), 1, 12)


def format_id(prefix: str, n, width: int) -> Column:
    """Zero-padded identifier such as R0001 / O0000001."""
    return F.concat(F.lit(prefix), F.lpad(_c(n).cast("string"), width, "0"))


def round_1dp(c) -> Column:
    return F.round(_c(c), 1)


STATS_JSON_SCHEMA = T.StructType(
    [
        T.StructField("zone_id_eta_mean", T.DoubleType()),
        T.StructField("zone_id_eta_median", T.DoubleType()),
        T.StructField("zone_id_eta_std", T.DoubleType()),
        T.StructField("zone_id_order_count", T.LongType()),
        T.StructField("zone_id_encoded", T.DoubleType()),
        T.StructField("restaurant_type_encoded", T.DoubleType()),
    ]
)


def parse_json_object(c, schema) -> Column:
    """JSON object text -> struct (bad text -> NULL fields)."""
    return F.from_json(_c(c), schema, {"mode": "PERMISSIVE"})

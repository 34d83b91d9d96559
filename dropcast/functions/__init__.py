"""Pure column builders (no actions, no UDFs)."""

from .eta import (  # noqa: F401
    baseline_eta,
    component_eta,
    format_id,
    metres_to_km,
    parse_json_object,
    prediction_id,
    prediction_interval,
    round_1dp,
    seconds_to_minutes,
    traffic_multiplier,
)
from .geo import (  # noqa: F401
    bearing_cos,
    bearing_deg,
    bearing_sin,
    clip,
    coordinate_diffs,
    geodesic_km,
    haversine_km,
    offset_point,
)
from .timeparts import cyclical, cyclical_features, rush_flags, temporal_parts, weekend_flag  # noqa: F401
from .weather import weather_multiplier, weather_one_hot, weather_ordinal  # noqa: F401

"""Domain constants.

FIXED VALUES: the values below must equal the published behaviour of the
system this library re-creates (encodings, multipliers, valid ranges,
serving defaults, bucket bounds, feature list). They are stated plainly and
in their natural order; do not edit them to make a result fit.
"""

from __future__ import annotations

TARGET = "actual_eta_minutes"
PREDICTION = "predicted_eta_minutes"
TIME_COL = "order_timestamp"
ID_COL = "order_id"

# ---- FIXED VALUES -------------------------------------------------------

# Ordinal code per weather condition; unknown or missing -> 0.
WEATHER_ENCODING = {"clear": 0, "cloudy": 1, "fog": 2, "rain": 3, "heavy_rain": 4}

# Travel-time multiplier per weather condition.
WEATHER_MULTIPLIER = {"clear": 1.0, "cloudy": 1.05, "rain": 1.3, "heavy_rain": 1.5, "fog": 1.15}

# Traffic multiplier by hour of day 0..23; weekend hours are scaled by 0.85.
HOURLY_TRAFFIC = [
    0.8, 0.75, 0.7, 0.7, 0.75, 0.85,
    1.0, 1.4, 1.6, 1.3, 1.1, 1.2,
    1.35, 1.25, 1.1, 1.1, 1.3, 1.6,
    1.7, 1.5, 1.2, 1.0, 0.9, 0.85,
]
WEEKEND_TRAFFIC_FACTOR = 0.85

# Valid ranges (inclusive). Coordinates out of range drop the row, the rest clip.
VALID_RANGES = {
    "pickup_lat": (-90.0, 90.0),
    "pickup_lng": (-180.0, 180.0),
    "dropoff_lat": (-90.0, 90.0),
    "dropoff_lng": (-180.0, 180.0),
    "haversine_distance_km": (0.0, 100.0),
    "hour_of_day": (0.0, 23.0),
    "day_of_week": (0.0, 6.0),
    "traffic_multiplier": (0.5, 3.0),
    "actual_eta_minutes": (1.0, 180.0),
}
CRITICAL_RANGE_COLUMNS = ["pickup_lat", "pickup_lng", "dropoff_lat", "dropoff_lng"]

# Coercion groups.
BOOL_COLUMNS = ["is_weekend", "is_lunch_rush", "is_dinner_rush"]
INT_COLUMNS = ["zone_id", "hour_of_day", "day_of_week", "rider_completed_deliveries"]
FLOAT_COLUMNS = [
    "pickup_lat", "pickup_lng", "dropoff_lat", "dropoff_lng",
    "haversine_distance_km", "traffic_multiplier", "weather_multiplier",
    "prep_time_minutes", "actual_eta_minutes", "rider_avg_speed_kmh",
    "rider_reliability",
]
CATEGORICAL_COLUMNS = ["restaurant_id", "restaurant_type", "weather_condition", "rider_id"]

# Target-encoding defaults.
TE_SMOOTHING = 10.0
TE_MIN_SAMPLES = 5
LAG_FALLBACK = 30.0

# Serving defaults for missing request fields.
REQUEST_DEFAULTS = {
    "zone_id": 1,
    "restaurant_type": "casual",
    "traffic_multiplier": 1.2,
    "weather_condition": "clear",
    "prep_time_minutes": 15.0,
    "rider_avg_speed_kmh": 25.0,
    "rider_reliability": 0.95,
}

# Request validity ranges (inclusive).
REQUEST_RANGES = {
    "pickup_lat": (-90.0, 90.0),
    "pickup_lng": (-180.0, 180.0),
    "dropoff_lat": (-90.0, 90.0),
    "dropoff_lng": (-180.0, 180.0),
    "zone_id": (1, 100),
    "traffic_multiplier": (0.5, 3.0),
    "prep_time_minutes": (1.0, 60.0),
    "rider_avg_speed_kmh": (5.0, 50.0),
}
REQUIRED_REQUEST_COLUMNS = ["pickup_lat", "pickup_lng", "dropoff_lat", "dropoff_lng"]

# Zone statistics used when a lookup misses.
ZONE_STATS_DEFAULTS = {
    "zone_id_eta_mean": 25.0,
    "zone_id_eta_median": 23.0,
    "zone_id_eta_std": 8.0,
    "zone_id_order_count": 1000,
    "zone_id_encoded": 0.0,
    "restaurant_type_encoded": 0.0,
}

# Fallback travel estimate.
FALLBACK_SPEED_KMH = 25.0
FALLBACK_TRAFFIC_BUFFER = 1.2
ETA_OVERHEAD_MINUTES = 3.0
ETA_FLOOR_MINUTES = 5.0

# Prediction interval: +-1.5 x training MAE, lower bound floored at 1; MAE default 4.5.
INTERVAL_MAE_FACTOR = 1.5
INTERVAL_DEFAULT_MAE = 4.5

# Histogram bucket upper bounds (a +Inf bucket is always added).
LATENCY_BUCKETS = [0.001, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5]
PREDICTED_ETA_BUCKETS = [5, 10, 15, 20, 25, 30, 40, 50, 60, 90, 120, 180]
PREDICTION_ERROR_BUCKETS = [0, 1, 2, 3, 4, 5, 7, 10, 15, 20, 30]
REQUEST_LATENCY_BUCKETS = [0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0]
SERVING_LATENCY_BUCKETS = [0.01, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0]
SERVING_PREDICTED_BUCKETS = [5, 10, 15, 20, 25, 30, 40, 50, 60, 90, 120]

# Business thresholds.
MAE_TARGET_MINUTES = 5.0
RETRAIN_MAE_THRESHOLD = 5.0
RETRAIN_DRIFT_SHARE = 0.15
TARGET_VALID_MIN_IN_RANGE_PCT = 95.0
WITHIN_K_MINUTES = [5, 10, 15]
ERROR_PERCENTILES = [50, 75, 90, 95, 99]
SEGMENT_MIN_COUNT = 100

# Model input: 28 features in this order.
MODEL_FEATURES = [
    "haversine_distance_km",
    "bearing_sin",
    "bearing_cos",
    "lat_diff",
    "lng_diff",
    "manhattan_proxy",
    "hour_of_day",
    "day_of_week",
    "hour_sin",
    "hour_cos",
    "dow_sin",
    "dow_cos",
    "is_morning_rush",
    "is_lunch_rush",
    "is_dinner_rush",
    "is_late_night",
    "is_weekend",
    "zone_id_encoded",
    "restaurant_type_encoded",
    "zone_id_eta_mean",
    "zone_id_eta_std",
    "zone_id_order_count",
    "weather_encoded",
    "weather_multiplier",
    "traffic_multiplier",
    "rider_avg_speed_kmh",
    "rider_reliability",
    "prep_time_minutes",
]

# Engineered feature names (the wider set reported by the feature pipeline, 35 names).
FEATURE_NAMES = [
    "haversine_distance_km", "bearing", "bearing_sin", "bearing_cos", "lat_diff", "lng_diff", "manhattan_proxy",
    "dist_to_zone_centroid",
    "hour_of_day", "day_of_week", "month", "hour_sin", "hour_cos", "dow_sin", "dow_cos", "month_sin", "month_cos",
    "is_morning_rush", "is_lunch_rush", "is_dinner_rush", "is_late_night", "is_weekend",
    "zone_id_encoded", "restaurant_type_encoded",
    "zone_id_eta_mean", "zone_id_eta_median", "zone_id_eta_std", "zone_id_order_count",
    "weather_encoded", "weather_multiplier",
    "traffic_multiplier", "rider_avg_speed_kmh", "rider_reliability", "rider_completed_deliveries", "prep_time_minutes",
]

# Boosted-tree defaults (n_estimators, learning_rate, max_depth, min_child_samples,
# subsample, colsample_bytree, early-stopping rounds).
GBT_DEFAULTS = {
    "n_estimators": 1000,
    "learning_rate": 0.05,
    "max_depth": 8,
    "min_child_samples": 20,
    "subsample": 0.8,
    "colsample_bytree": 0.8,
    "early_stopping_rounds": 50,
}

# Hyper-parameter search space: (low, high, log-scale).
SEARCH_SPACE = {
    "n_estimators": (100, 2000, False),
    "learning_rate": (0.01, 0.3, True),
    "max_depth": (3, 12, False),
    "min_child_samples": (5, 100, False),
    "subsample": (0.5, 1.0, False),
    "colsample_bytree": (0.5, 1.0, False),
}

# ---- end of FIXED VALUES ------------------------------------------------

# Drift defaults (published definitions, chosen by this library).
DRIFT_NUMERIC_THRESHOLD = 0.1   # Wasserstein-1 / reference std
DRIFT_CATEGORICAL_THRESHOLD = 0.1  # Jensen-Shannon distance
DATASET_DRIFT_SHARE = 0.5

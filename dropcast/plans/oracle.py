"""DuckDB oracle SQL, written independently of the Spark code path.

Each entry computes the same result as the registered Spark query from the
raw driver views, rounding doubles to 6 places the same way.
"""

from __future__ import annotations

F_WGS = "(1.0e0/298.257223563e0)"
A_KM = "6378.137e0"

DELIVERIES = """
SELECT concat('O', lpad(CAST(event_id AS STRING), 7, '0')) AS order_id, event_id, ts AS order_timestamp,
  concat('R', lpad(CAST(user_id % 50 AS STRING), 4, '0')) AS restaurant_id,
  CAST(user_id % 8 + 1 AS INT) AS zone_id, event_type AS restaurant_type,
  37.70e0   + ((event_id * 7919)  % 1000) / 1000e0 * 0.15e0 AS pickup_lat,
  -122.52e0 + ((event_id * 10007) % 1000) / 1000e0 * 0.17e0 AS pickup_lng,
  37.70e0   + ((event_id * 5261)  % 1000) / 1000e0 * 0.15e0 AS dropoff_lat,
  -122.52e0 + ((event_id * 3571)  % 1000) / 1000e0 * 0.17e0 AS dropoff_lng,
  15e0 + (event_id % 20) AS rider_avg_speed_kmh,
  0.85e0 + (event_id % 15) / 100e0 AS rider_reliability,
  0.5e0 + (event_id % 26) / 10e0 AS traffic_multiplier,
  CASE event_id % 5 WHEN 0 THEN 'clear' WHEN 1 THEN 'cloudy' WHEN 2 THEN 'rain'
                    WHEN 3 THEN 'heavy_rain' ELSE 'fog' END AS weather_condition,
  CASE event_id % 5 WHEN 0 THEN 1e0 WHEN 1 THEN 1.05e0 WHEN 2 THEN 1.3e0
                    WHEN 3 THEN 1.5e0 ELSE 1.15e0 END AS weather_multiplier,
  3e0 + (event_id % 40) / 2e0 AS prep_time_minutes,
  value AS actual_eta_minutes
FROM events
"""

RAW = """
SELECT order_id, event_id, order_timestamp, restaurant_id, zone_id, restaurant_type,
  CASE WHEN event_id % 101 = 0 THEN 95e0 ELSE pickup_lat END AS pickup_lat,
  pickup_lng, dropoff_lat, dropoff_lng, rider_avg_speed_kmh, rider_reliability,
  CASE WHEN event_id % 53 = 0 THEN 5e0 ELSE traffic_multiplier END AS traffic_multiplier,
  CASE WHEN event_id % 17 = 0 THEN NULL ELSE weather_condition END AS weather_condition,
  weather_multiplier,
  CASE WHEN event_id % 19 = 0 THEN NULL ELSE prep_time_minutes END AS prep_time_minutes,
  actual_eta_minutes
FROM d
UNION ALL
SELECT order_id, event_id, order_timestamp + INTERVAL '1' MINUTE, restaurant_id, zone_id, restaurant_type,
  pickup_lat, pickup_lng, dropoff_lat, dropoff_lng, rider_avg_speed_kmh, rider_reliability, traffic_multiplier,
  weather_condition, weather_multiplier, prep_time_minutes, actual_eta_minutes
FROM d WHERE event_id % 10 = 0
"""

D_COLS = ("order_id, event_id, order_timestamp, restaurant_id, zone_id, restaurant_type, pickup_lat, pickup_lng, "
          "dropoff_lat, dropoff_lng, rider_avg_speed_kmh, rider_reliability, traffic_multiplier, weather_condition, "
          "weather_multiplier, prep_time_minutes, actual_eta_minutes")


def r6(expr: str) -> str:
    return f"round({expr}, 6)"


def with_d(body: str, raw: bool = False, extra: str = "") -> str:
    ctes = [f"d AS ({DELIVERIES})"]
    if raw:
        ctes.append(f"raw AS ({RAW})")
    if extra:
        ctes.append(extra)
    return "WITH " + ",\n".join(ctes) + "\n" + body


def geo_ctes(src: str, prefix: str, la1: str, lo1: str, la2: str, lo2: str, out: str) -> str:
    """Three CTEs (<prefix>1..3) adding ``out`` = ellipsoidal distance (Lambert) to ``src``."""
    p = prefix
    return f"""
{p}1 AS (SELECT *, atan((1e0 - {F_WGS}) * tan(radians({la1}))) AS {p}_b1,
                   atan((1e0 - {F_WGS}) * tan(radians({la2}))) AS {p}_b2,
                   radians({lo2} - {lo1}) AS {p}_dl FROM {src}),
{p}2 AS (SELECT *, 2e0 * asin(sqrt(least(pow(sin(({p}_b2 - {p}_b1) / 2e0), 2) + cos({p}_b1) * cos({p}_b2) * pow(sin({p}_dl / 2e0), 2), 1e0))) AS {p}_s,
                   ({p}_b1 + {p}_b2) / 2e0 AS {p}_P, ({p}_b2 - {p}_b1) / 2e0 AS {p}_Q FROM {p}1),
{p}3 AS (SELECT * EXCLUDE ({p}_b1, {p}_b2, {p}_dl, {p}_s, {p}_P, {p}_Q),
    CASE WHEN {la1} IS NULL OR {lo1} IS NULL OR {la2} IS NULL OR {lo2} IS NULL
              OR abs({la1}) > 90 OR abs({la2}) > 90 THEN 0e0
         WHEN {p}_s = 0 THEN 0e0
         ELSE {A_KM} * ({p}_s - {F_WGS} / 2e0 * (
              ({p}_s - sin({p}_s)) * pow(sin({p}_P), 2) * pow(cos({p}_Q), 2) / pow(cos({p}_s / 2e0), 2)
            + ({p}_s + sin({p}_s)) * pow(cos({p}_P), 2) * pow(sin({p}_Q), 2) / pow(sin({p}_s / 2e0), 2))) END AS {out}
  FROM {p}2)"""


def geo_d(src: str = "d") -> str:
    return geo_ctes(src, "g", "pickup_lat", "pickup_lng", "dropoff_lat", "dropoff_lng", "dist")


def bearing_sql(la1="pickup_lat", lo1="pickup_lng", la2="dropoff_lat", lo2="dropoff_lng") -> str:
    x = f"sin(radians({lo2} - {lo1})) * cos(radians({la2}))"
    y = (f"cos(radians({la1})) * sin(radians({la2})) - sin(radians({la1})) * cos(radians({la2})) * "
         f"cos(radians({lo2} - {lo1}))")
    return f"fmod(degrees(atan2({x}, {y})) + 360e0, 360e0)"


COMPONENT = ("greatest(5e0, prep_time_minutes + dist / rider_avg_speed_kmh * 60e0 * traffic_multiplier * "
             "weather_multiplier + 3e0)")

# predictions: d + dist + predicted_eta_minutes
PRED = "p AS (SELECT *, " + COMPONENT + " AS predicted_eta_minutes FROM g3)"


def with_pred(body: str) -> str:
    return with_d(body, extra=geo_d().strip() + ",\n" + PRED)


def half_up_1dp(expr: str) -> str:
    return f"CAST(round(CAST({expr} AS DECIMAL(38,12)), 1) AS DOUBLE)"


SQL: dict[str, str] = {}

SQL["geodesic_km"] = with_d(f"SELECT order_id, {r6('dist')} AS distance_km FROM g3", extra=geo_d().strip())
SQL["haversine_km"] = with_d(
    "SELECT order_id, round(2e0 * 6371.0088e0 * asin(sqrt(least(pow(sin((radians(dropoff_lat) - radians(pickup_lat)) / 2e0), 2)"
    " + cos(radians(pickup_lat)) * cos(radians(dropoff_lat)) * pow(sin(radians(dropoff_lng - pickup_lng) / 2e0), 2), 1e0))), 6)"
    " AS haversine_km FROM d")
SQL["bearing_deg"] = with_d(f"SELECT order_id, {r6(bearing_sql())} AS bearing FROM d")
SQL["bearing_sin_cos"] = with_d(
    f"SELECT order_id, {r6('sin(radians(b))')} AS bearing_sin, {r6('cos(radians(b))')} AS bearing_cos "
    f"FROM (SELECT order_id, {bearing_sql()} AS b FROM d)")
SQL["coordinate_diffs"] = with_d(
    "SELECT order_id, round(abs(dropoff_lat - pickup_lat), 6) AS lat_diff, round(abs(dropoff_lng - pickup_lng), 6) AS lng_diff,"
    " round(abs(dropoff_lat - pickup_lat) + abs(dropoff_lng - pickup_lng), 6) AS manhattan_proxy FROM d")
SQL["offset_point"] = with_d(
    "SELECT order_id,"
    " round(CASE WHEN la < 37.70e0 THEN 37.70e0 WHEN la > 37.85e0 THEN 37.85e0 ELSE la END, 6) AS offset_lat,"
    " round(CASE WHEN lo < -122.52e0 THEN -122.52e0 WHEN lo > -122.35e0 THEN -122.35e0 ELSE lo END, 6) AS offset_lng"
    f" FROM (SELECT order_id, pickup_lat + dist / 111e0 * cos(radians({bearing_sql()})) AS la,"
    f" pickup_lng + dist / (111e0 * cos(radians(pickup_lat))) * sin(radians({bearing_sql()})) AS lo FROM g3)",
    extra=geo_d().strip())
SQL["temporal_parts"] = with_d(
    "SELECT order_id, CAST(hour(order_timestamp) AS BIGINT) AS hour_of_day, CAST(isodow(order_timestamp) - 1 AS BIGINT) AS day_of_week,"
    " CAST(month(order_timestamp) AS BIGINT) AS month, CAST(day(order_timestamp) AS BIGINT) AS day_of_month,"
    " CAST(weekofyear(order_timestamp) AS BIGINT) AS week_of_year FROM d")
SQL["cyclical_features"] = with_d(
    "SELECT order_id, round(sin(2e0 * pi() * h / 24e0), 6) AS hour_sin, round(cos(2e0 * pi() * h / 24e0), 6) AS hour_cos,"
    " round(sin(2e0 * pi() * w / 7e0), 6) AS dow_sin, round(cos(2e0 * pi() * w / 7e0), 6) AS dow_cos,"
    " round(sin(2e0 * pi() * m / 12e0), 6) AS month_sin, round(cos(2e0 * pi() * m / 12e0), 6) AS month_cos"
    " FROM (SELECT order_id, hour(order_timestamp) AS h, isodow(order_timestamp) - 1 AS w, month(order_timestamp) AS m FROM d)")
RUSH = ("CAST(h BETWEEN 7 AND 9 AS BIGINT) AS is_morning_rush, CAST(h BETWEEN 11 AND 14 AS BIGINT) AS is_lunch_rush,"
        " CAST(h BETWEEN 17 AND 21 AS BIGINT) AS is_dinner_rush, CAST(h >= 22 OR h <= 5 AS BIGINT) AS is_late_night")
SQL["rush_flags"] = with_d(
    f"SELECT order_id, {RUSH}, CAST(w >= 5 AS BIGINT) AS is_weekend"
    " FROM (SELECT order_id, hour(order_timestamp) AS h, isodow(order_timestamp) - 1 AS w FROM d)")
SQL["weekend_flag"] = with_d("SELECT order_id, CAST(isodow(order_timestamp) - 1 >= 5 AS BIGINT) AS is_weekend FROM d")
WEATHER_ORD = ("CASE weather_condition WHEN 'clear' THEN 0 WHEN 'cloudy' THEN 1 WHEN 'fog' THEN 2 WHEN 'rain' THEN 3"
               " WHEN 'heavy_rain' THEN 4 ELSE 0 END")
WEATHER_MULT = ("CASE weather_condition WHEN 'clear' THEN 1.0e0 WHEN 'cloudy' THEN 1.05e0 WHEN 'rain' THEN 1.3e0"
                " WHEN 'heavy_rain' THEN 1.5e0 WHEN 'fog' THEN 1.15e0 ELSE 1.0e0 END")
SQL["weather_ordinal"] = with_d(f"SELECT order_id, order_timestamp, CAST({WEATHER_ORD} AS BIGINT) AS weather_encoded FROM raw", raw=True)
SQL["weather_one_hot"] = with_d(
    "SELECT order_id, order_timestamp,"
    " CAST(coalesce(weather_condition = 'cloudy', false) AS BIGINT) AS weather_cloudy,"
    " CAST(coalesce(weather_condition = 'fog', false) AS BIGINT) AS weather_fog,"
    " CAST(coalesce(weather_condition = 'heavy_rain', false) AS BIGINT) AS weather_heavy_rain,"
    " CAST(coalesce(weather_condition = 'rain', false) AS BIGINT) AS weather_rain FROM raw", raw=True)
SQL["weather_multiplier"] = with_d(f"SELECT order_id, order_timestamp, round({WEATHER_MULT}, 6) AS weather_multiplier FROM raw", raw=True)
SQL["traffic_multiplier"] = with_d(
    "SELECT order_id, round([0.8e0, 0.75e0, 0.7e0, 0.7e0, 0.75e0, 0.85e0, 1.0e0, 1.4e0, 1.6e0, 1.3e0, 1.1e0, 1.2e0,"
    " 1.35e0, 1.25e0, 1.1e0, 1.1e0, 1.3e0, 1.6e0, 1.7e0, 1.5e0, 1.2e0, 1.0e0, 0.9e0, 0.85e0][hour(order_timestamp) + 1]"
    " * CASE WHEN isodow(order_timestamp) - 1 >= 5 THEN 0.85e0 ELSE 1.0e0 END, 6) AS traffic_profile FROM d")
SQL["component_eta"] = with_pred(f"SELECT order_id, {r6('predicted_eta_minutes')} AS predicted_eta_minutes FROM p")
SQL["baseline_eta"] = with_d(
    "SELECT order_id, round(dist / 25e0 * 60e0, 6) AS duration_minutes, round(dist / 25e0 * 60e0 * 1.2e0, 6) AS duration_in_traffic_minutes,"
    " round(dist, 6) AS distance_km, 'haversine_fallback' AS source FROM g3", extra=geo_d().strip())
SQL["unit_convert"] = with_d(
    "SELECT order_id, round(actual_eta_minutes * 60e0 / 60e0, 6) AS duration_minutes, round(dist * 1000e0 / 1000e0, 6) AS distance_km FROM g3",
    extra=geo_d().strip())
SQL["prediction_id"] = with_d("SELECT order_id, substring(md5(concat_ws('-', order_id, 'v1')), 1, 12) AS prediction_id FROM d")
SQL["format_id"] = ("SELECT event_id, concat('O', lpad(CAST(event_id AS VARCHAR), 7, '0')) AS order_id,"
                    " concat('R', lpad(CAST(user_id % 50 AS VARCHAR), 4, '0')) AS restaurant_id FROM events")
SQL["round_1dp"] = with_d(f"SELECT order_id, {half_up_1dp('actual_eta_minutes')} AS eta_1dp FROM d")
SQL["parse_stats_json"] = "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events"
SQL["with_prediction_interval"] = with_pred(
    f"SELECT order_id, {half_up_1dp('predicted_eta_minutes')} AS predicted_eta_minutes,"
    f" {half_up_1dp('greatest(1e0, predicted_eta_minutes - m * 1.5e0)')} AS confidence_interval_lower,"
    f" {half_up_1dp('predicted_eta_minutes + m * 1.5e0')} AS confidence_interval_upper"
    " FROM p, (SELECT avg(abs(actual_eta_minutes - predicted_eta_minutes)) AS m FROM p) mm")

SQL["residuals"] = with_pred(
    "SELECT order_id, round(actual_eta_minutes, 6) AS actual, round(predicted_eta_minutes, 6) AS predicted,"
    " round(actual_eta_minutes - predicted_eta_minutes, 6) AS residual, round(abs(actual_eta_minutes - predicted_eta_minutes), 6) AS abs_error FROM p")

REG = """SELECT count(*) AS n, round(avg(abs(e)), 6) AS mae, round(sqrt(avg(e * e)), 6) AS rmse,
  round(1e0 - sum(e * e) / (var_pop(y) * count(*)), 6) AS r2,
  CASE WHEN (avg(abs(e) / greatest(abs(y), 2.220446049250313e-16)) * 100e0) IS NULL OR (avg(abs(e) / greatest(abs(y), 2.220446049250313e-16)) * 100e0) = 0 THEN (avg(abs(e) / greatest(abs(y), 2.220446049250313e-16)) * 100e0) WHEN (floor(log10(abs(avg(abs(e) / greatest(abs(y), 2.220446049250313e-16)) * 100e0))) + 1 - 12) >= 0 THEN round((avg(abs(e) / greatest(abs(y), 2.220446049250313e-16)) * 100e0) / pow(10e0, (floor(log10(abs(avg(abs(e) / greatest(abs(y), 2.220446049250313e-16)) * 100e0))) + 1 - 12))) * pow(10e0, (floor(log10(abs(avg(abs(e) / greatest(abs(y), 2.220446049250313e-16)) * 100e0))) + 1 - 12)) ELSE round((avg(abs(e) / greatest(abs(y), 2.220446049250313e-16)) * 100e0) * pow(10e0, -(floor(log10(abs(avg(abs(e) / greatest(abs(y), 2.220446049250313e-16)) * 100e0))) + 1 - 12))) / pow(10e0, -(floor(log10(abs(avg(abs(e) / greatest(abs(y), 2.220446049250313e-16)) * 100e0))) + 1 - 12)) END AS mape,
  round(avg(e), 6) AS mean_error, round(stddev_pop(e), 6) AS std_error, round(max(abs(e)), 6) AS max_error,
  round(avg(CASE WHEN abs(e) <= 5 THEN 1e0 ELSE 0e0 END) * 100e0, 6) AS within_5min_pct,
  round(avg(CASE WHEN abs(e) <= 10 THEN 1e0 ELSE 0e0 END) * 100e0, 6) AS within_10min_pct,
  round(avg(CASE WHEN abs(e) <= 15 THEN 1e0 ELSE 0e0 END) * 100e0, 6) AS within_15min_pct,
  round(quantile_cont(abs(e), 0.5), 6) AS median_ae, round(quantile_cont(abs(e), 0.5), 6) AS p50_error,
  round(quantile_cont(abs(e), 0.75), 6) AS p75_error, round(quantile_cont(abs(e), 0.9), 6) AS p90_error,
  round(quantile_cont(abs(e), 0.95), 6) AS p95_error, round(quantile_cont(abs(e), 0.99), 6) AS p99_error
FROM (SELECT actual_eta_minutes AS y, actual_eta_minutes - predicted_eta_minutes AS e FROM {src})"""
SQL["regression_metrics"] = with_pred(REG.format(src="p"))
SQL["within_k_pct"] = with_pred(
    "SELECT round(avg(CASE WHEN ae <= 5 THEN 1e0 ELSE 0e0 END) * 100e0, 6) AS within_5min_pct,"
    " round(avg(CASE WHEN ae <= 10 THEN 1e0 ELSE 0e0 END) * 100e0, 6) AS within_10min_pct,"
    " round(avg(CASE WHEN ae <= 15 THEN 1e0 ELSE 0e0 END) * 100e0, 6) AS within_15min_pct"
    " FROM (SELECT abs(actual_eta_minutes - predicted_eta_minutes) AS ae FROM p)")
SQL["error_percentiles"] = with_pred(
    "SELECT round(quantile_cont(ae, 0.5), 6) AS p50_error, round(quantile_cont(ae, 0.75), 6) AS p75_error,"
    " round(quantile_cont(ae, 0.9), 6) AS p90_error, round(quantile_cont(ae, 0.95), 6) AS p95_error,"
    " round(quantile_cont(ae, 0.99), 6) AS p99_error FROM (SELECT abs(actual_eta_minutes - predicted_eta_minutes) AS ae FROM p)")

SEG = """SELECT {segcast} AS segment, round(avg(ae), 6) AS mae, round(quantile_cont(ae, 0.5), 6) AS median_ae,
  round(stddev_samp(ae), 6) AS std_ae, count(*) AS count, round(avg(y), 6) AS avg_actual_eta,
  round(stddev_samp(y), 6) AS std_actual_eta, round(avg(CASE WHEN ae <= 5 THEN 1e0 ELSE 0e0 END) * 100e0, 6) AS within_5min_pct
FROM (SELECT {seg} AS s, actual_eta_minutes AS y, abs(actual_eta_minutes - predicted_eta_minutes) AS ae FROM p)
GROUP BY s {having}"""
SQL["segment_metrics"] = with_pred(SEG.format(seg="hour(order_timestamp)", segcast="CAST(s AS BIGINT)", having=""))
SQL["segment_metrics_min_count"] = with_pred(SEG.format(seg="day(order_timestamp)", segcast="CAST(s AS BIGINT)",
                                                        having="HAVING count(*) >= 100"))
SQL["sort_segments"] = with_pred(SEG.format(seg="restaurant_id", segcast="s", having=""))
SQL["error_histogram"] = with_pred("""
SELECT kind, CAST(b AS BIGINT) AS bin, round(lo + b * (hi - lo) / 50e0, 6) AS lower,
  round(lo + (b + 1) * (hi - lo) / 50e0, 6) AS upper, count(*) FILTER (WHERE bin = b) AS count
FROM (SELECT kind, lo, hi, b, least(coalesce(floor((v - lo) / ((hi - lo) / 50e0)), 0), 49) AS bin
      FROM range(0, 50) t(b), (SELECT kind, v, min(v) OVER (PARTITION BY kind) AS lo, max(v) OVER (PARTITION BY kind) AS hi
            FROM (SELECT 'error' AS kind, actual_eta_minutes - predicted_eta_minutes AS v FROM p
                  UNION ALL SELECT 'abs_error', abs(actual_eta_minutes - predicted_eta_minutes) FROM p)))
GROUP BY kind, b, lo, hi""")
SQL["error_cdf"] = with_pred("""
SELECT abs_error, round(max(rn) / max(n) * 100e0, 6) AS cdf_pct
FROM (SELECT abs_error, row_number() OVER (ORDER BY abs_error, order_id) AS rn, count(*) OVER () AS n
      FROM (SELECT order_id, round(abs(actual_eta_minutes - predicted_eta_minutes), 6) AS abs_error FROM p))
GROUP BY abs_error""")

SQL["time_split"] = with_d("""
SELECT order_id, order_timestamp, rn <= floor(n * (1e0 - 0.2e0)) AS is_train
FROM (SELECT order_id, order_timestamp, row_number() OVER (ORDER BY order_timestamp, order_id) AS rn,
             count(*) OVER () AS n FROM d)""")
FOLDS = """
r AS (SELECT *, row_number() OVER (ORDER BY order_timestamp, order_id) AS rn, count(*) OVER () AS n FROM {src}),
f AS (SELECT r.*, CAST(fold AS BIGINT) AS fold, n - (5 - fold) * floor(n / 6) AS start, floor(n / 6) AS s
      FROM r, range(0, 5) t(fold))"""
SQL["time_series_folds"] = with_d(
    "SELECT order_id, order_timestamp, fold, rn > start AS is_val FROM f WHERE rn <= start + s",
    extra=FOLDS.format(src="d").strip())
SQL["cv_summary"] = with_d("""
SELECT round(avg(mae), 6) AS mae_mean, round(stddev_pop(mae), 6) AS mae_std, round(avg(rmse), 6) AS rmse_mean,
  round(stddev_pop(rmse), 6) AS rmse_std, round(avg(r2), 6) AS r2_mean, round(stddev_pop(r2), 6) AS r2_std
FROM (SELECT fold, avg(abs(actual_eta_minutes - predicted_eta_minutes)) AS mae,
        sqrt(avg(pow(actual_eta_minutes - predicted_eta_minutes, 2))) AS rmse,
        1e0 - sum(pow(actual_eta_minutes - predicted_eta_minutes, 2)) / (var_pop(actual_eta_minutes) * count(*)) AS r2
      FROM f WHERE rn <= start + s AND rn > start GROUP BY fold)""",
    extra=geo_d().strip() + ",\n" + PRED + "," + FOLDS.format(src="p"))
SQL["sort_by_time"] = with_d("SELECT order_id, order_timestamp, zone_id FROM d ORDER BY order_timestamp, order_id")

ROUNDED_D = ", ".join(
    f"round({c}, 6) AS {c}" if c in ("pickup_lat", "pickup_lng", "dropoff_lat", "dropoff_lng", "rider_avg_speed_kmh",
                                      "rider_reliability", "traffic_multiplier", "weather_multiplier",
                                      "prep_time_minutes", "actual_eta_minutes") else c
    for c in D_COLS.split(", "))
SQL["date_range_filter"] = with_d(
    f"SELECT {ROUNDED_D} FROM d WHERE order_timestamp >= TIMESTAMP '2024-01-05' AND order_timestamp <= TIMESTAMP '2024-01-20'")
SQL["limit_rows"] = with_d(f"SELECT {ROUNDED_D} FROM d ORDER BY order_timestamp, order_id LIMIT 100")

SQL["duplicate_count"] = with_d(
    "SELECT CAST(count(*) - count(DISTINCT order_id) - max(CASE WHEN order_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS duplicates FROM raw",
    raw=True)
SQL["validate_target"] = with_d("""
SELECT count(*) AS count, round(avg(t), 6) AS mean, round(stddev_samp(t), 6) AS std, round(min(t), 6) AS min,
  round(max(t), 6) AS max, count(*) FILTER (WHERE t IS NULL) AS null_count,
  round(count(*) FILTER (WHERE t BETWEEN 1 AND 180) / count(*) * 100e0, 6) AS in_range_pct,
  count(*) FILTER (WHERE t IS NULL) = 0 AND count(*) FILTER (WHERE t BETWEEN 1 AND 180) / count(*) * 100e0 >= 95
    AND coalesce(stddev_samp(t), 0) > 0 AS is_valid
FROM (SELECT actual_eta_minutes AS t FROM raw)""", raw=True)


def _profile_sql_named() -> str:
    cols = [("order_id", "string"), ("event_id", "bigint"), ("restaurant_id", "string"), ("zone_id", "int"),
            ("restaurant_type", "string"), ("pickup_lat", "double"), ("pickup_lng", "double"),
            ("dropoff_lat", "double"), ("dropoff_lng", "double"), ("rider_avg_speed_kmh", "double"),
            ("rider_reliability", "double"), ("traffic_multiplier", "double"), ("weather_condition", "string"),
            ("weather_multiplier", "double"), ("prep_time_minutes", "double"), ("actual_eta_minutes", "double"), ("order_timestamp", "timestamp_ntz")]
    plain = ("string", "timestamp_ntz")
    parts = []
    for c, t in cols:
        if t in plain:
            stats = ("CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS std, CAST(NULL AS DOUBLE) AS min,"
                     " CAST(NULL AS DOUBLE) AS max, CAST(NULL AS DOUBLE) AS skew")
        else:
            x = f"CAST(raw.{c} AS DOUBLE)"
            stats = (f"round(avg({x}), 6) AS mean, round(stddev_samp({x}), 6) AS std, round(min({x}), 6) AS min,"
                     f" round(max({x}), 6) AS max,"
                     f" round(CASE WHEN count({x}) > 2 THEN"
                     f" (avg(pow({x} - mu.{c}, 3)) / pow(avg(pow({x} - mu.{c}, 2)), 1.5e0))"
                     f" * sqrt(count({x}) * (count({x}) - 1e0)) / (count({x}) - 2e0) END, 6) AS skew")
        parts.append(
            f"SELECT count(*) AS total_rows, CAST({len(cols)} AS BIGINT) AS total_columns, '{c}' AS column, '{t}' AS dtype,"
            f" count(*) FILTER (WHERE raw.{c} IS NULL) AS null_count,"
            f" round(count(*) FILTER (WHERE raw.{c} IS NULL) / count(*) * 100e0, 6) AS null_pct, {stats}"
            f" FROM raw, mu")
    mu = "mu AS (SELECT " + ", ".join(f"avg(CAST({c} AS DOUBLE)) AS {c}" for c, t in cols if t not in plain) + " FROM raw)"
    return with_d("\nUNION ALL\n".join(parts), raw=True, extra=mu)


SQL["data_quality_profile"] = _profile_sql_named()
SQL["describe_summary"] = with_d("""
SELECT "column", count(v) AS count, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std, round(min(v), 6) AS min,
  round(quantile_cont(v, 0.25), 6) AS p25, round(quantile_cont(v, 0.5), 6) AS p50, round(quantile_cont(v, 0.75), 6) AS p75,
  round(max(v), 6) AS max
FROM (SELECT 'actual_eta_minutes' AS "column", actual_eta_minutes AS v FROM g3
      UNION ALL SELECT 'haversine_distance_km', dist FROM g3)
GROUP BY 1""", extra=geo_d().strip())


def _fq_sql() -> str:
    ranges = [("pickup_lat", -90, 90), ("pickup_lng", -180, 180), ("dropoff_lat", -90, 90), ("dropoff_lng", -180, 180),
              ("traffic_multiplier", 0.5, 3.0), ("actual_eta_minutes", 1, 180), ("zone_id", 1, 100),
              ("prep_time_minutes", 1, 60), ("rider_avg_speed_kmh", 5, 50)]
    parts = [f"SELECT '{c}' AS feature, count(*) FILTER (WHERE {c} IS NULL) AS missing_count,"
             f" count(*) FILTER (WHERE {c} < {lo}e0 OR {c} > {hi}e0) AS out_of_range_count FROM raw"
             for c, lo, hi in ranges]
    return with_d("\nUNION ALL\n".join(parts), raw=True)


SQL["feature_quality_counters"] = _fq_sql()


# ---- cleaning ------------------------------------------------------------------------
DD = ("dd AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY order_timestamp, event_id)"
      " AS rn FROM raw) WHERE rn = 1)")


def rounded_cols(src_alias: str = "") -> str:
    return ROUNDED_D


def impute_ctes(src: str, out: str) -> str:
    return (f"{out}_wm AS (SELECT weather_condition AS m FROM {src} WHERE weather_condition IS NOT NULL"
            f" GROUP BY 1 ORDER BY count(*) DESC, 1 ASC LIMIT 1),\n"
            f"{out}_pm AS (SELECT quantile_cont(prep_time_minutes, 0.5) AS m FROM {src}),\n"
            f"{out} AS (SELECT s.* REPLACE (coalesce(s.weather_condition, (SELECT m FROM {out}_wm)) AS weather_condition,"
            f" coalesce(s.prep_time_minutes, (SELECT m FROM {out}_pm)) AS prep_time_minutes) FROM {src} s)")


def range_cte(src: str, out: str) -> str:
    bad = " OR ".join(f"coalesce({c} < {lo}e0 OR {c} > {hi}e0, false)" for c, lo, hi in
                      [("pickup_lat", -90, 90), ("pickup_lng", -180, 180), ("dropoff_lat", -90, 90), ("dropoff_lng", -180, 180)])
    return (f"{out} AS (SELECT * REPLACE ("
            f"CASE WHEN traffic_multiplier < 0.5e0 THEN 0.5e0 WHEN traffic_multiplier > 3.0e0 THEN 3.0e0 ELSE traffic_multiplier END AS traffic_multiplier,"
            f" CASE WHEN actual_eta_minutes < 1e0 THEN 1e0 WHEN actual_eta_minutes > 180e0 THEN 180e0 ELSE actual_eta_minutes END AS actual_eta_minutes)"
            f" FROM {src} WHERE NOT ({bad}))")


def iqr_ctes(src: str, out: str, col: str = "actual_eta_minutes") -> str:
    return (f"{out}_q AS (SELECT quantile_cont({col}, 0.25) - 1.5e0 * (quantile_cont({col}, 0.75) - quantile_cont({col}, 0.25)) AS lo,"
            f" quantile_cont({col}, 0.75) + 1.5e0 * (quantile_cont({col}, 0.75) - quantile_cont({col}, 0.25)) AS hi FROM {src}),\n"
            f"{out} AS (SELECT s.* REPLACE (CASE WHEN s.{col} < q.lo THEN q.lo WHEN s.{col} > q.hi THEN q.hi ELSE s.{col} END AS {col})"
            f" FROM {src} s, {out}_q q)")


CLEAN_CTES = ",\n".join([DD, impute_ctes("dd", "im"), range_cte("im", "rg"), iqr_ctes("rg", "cl")])

SQL["dedupe_first"] = with_d(f"SELECT {ROUNDED_D} FROM dd", raw=True, extra=DD)
SQL["coerce_types"] = with_d("""
SELECT order_id, event_id, order_timestamp, CAST(CASE WHEN event_id % 29 = 0 THEN NULL ELSE zone_id END AS INT) AS zone_id,
  round(CASE WHEN event_id % 23 = 0 THEN NULL ELSE prep_time_minutes END, 6) AS prep_time_minutes,
  round(traffic_multiplier, 6) AS traffic_multiplier, round(pickup_lat, 6) AS pickup_lat FROM raw""", raw=True)
SQL["impute_missing"] = with_d(
    "SELECT order_id, event_id, order_timestamp, weather_condition, round(prep_time_minutes, 6) AS prep_time_minutes FROM im",
    raw=True, extra=impute_ctes("raw", "im"))
SQL["range_filter_or_clip"] = with_d(f"SELECT {ROUNDED_D} FROM rg", raw=True, extra=range_cte("raw", "rg"))
SQL["iqr_bounds_clip"] = with_d("SELECT order_id, round(actual_eta_minutes, 6) AS actual_eta_minutes FROM cl",
                                extra=iqr_ctes("d", "cl"))
SQL["zscore_bounds_clip"] = with_d("""
SELECT order_id, round(CASE WHEN actual_eta_minutes < lo THEN lo WHEN actual_eta_minutes > hi THEN hi ELSE actual_eta_minutes END, 6)
  AS actual_eta_minutes
FROM d, (SELECT avg(actual_eta_minutes) - 1.5e0 * stddev_samp(actual_eta_minutes) AS lo,
                avg(actual_eta_minutes) + 1.5e0 * stddev_samp(actual_eta_minutes) AS hi FROM d)""")
SQL["fixed_bounds_clip"] = with_d("""
SELECT order_id, round(CASE WHEN actual_eta_minutes < 1e0 THEN 1e0 WHEN actual_eta_minutes > 180e0 THEN 180e0
  ELSE actual_eta_minutes END, 6) AS actual_eta_minutes FROM d""")
SQL["clean_orders"] = with_d(f"SELECT {ROUNDED_D} FROM cl", raw=True, extra=CLEAN_CTES)
SQL["sink_clean_csv"] = SQL["clean_orders"]
SQL["cleaning_report"] = with_d("""
SELECT (SELECT count(*) FROM raw) AS original_rows, CAST(17 AS BIGINT) AS original_columns,
  (SELECT count(*) FROM raw) - (SELECT count(*) FROM dd) AS duplicates_removed,
  (SELECT count(*) FILTER (WHERE weather_condition IS NULL) + count(*) FILTER (WHERE prep_time_minutes IS NULL) FROM dd) AS missing_values_filled,
  (SELECT count(*) FROM dd) - (SELECT count(*) FROM rg) AS invalid_range_rows_removed,
  (SELECT count(*) FROM rg, cl_q WHERE actual_eta_minutes < lo OR actual_eta_minutes > hi) AS outliers_clipped,
  (SELECT count(*) FROM rg) AS final_rows,
  (SELECT count(*) FROM raw) - (SELECT count(*) FROM rg) AS rows_removed,
  round(((SELECT count(*) FROM raw) - (SELECT count(*) FROM rg)) / (SELECT count(*) FROM raw) * 100e0, 6) AS removal_pct""",
    raw=True, extra=CLEAN_CTES)

# ---- features ------------------------------------------------------------------------------
TRAIN = "tr AS (SELECT * FROM d WHERE order_timestamp < TIMESTAMP '2024-01-16')"
TEST = "te AS (SELECT * FROM d WHERE order_timestamp >= TIMESTAMP '2024-01-16')"

SQL["zone_centroids"] = with_d(
    "SELECT zone_id, round(avg(pickup_lat), 6) AS centroid_lat, round(avg(pickup_lng), 6) AS centroid_lng FROM d GROUP BY zone_id")
SQL["join_zone_centroid"] = with_d(
    "SELECT order_id, round(CASE WHEN centroid_lat IS NULL THEN 0e0 ELSE dc END, 6) AS dist_to_zone_centroid FROM c3",
    extra=("ce AS (SELECT zone_id, avg(pickup_lat) AS centroid_lat, avg(pickup_lng) AS centroid_lng FROM d WHERE zone_id <= 6 GROUP BY zone_id),\n"
           "dj AS (SELECT d.order_id, d.pickup_lat, d.pickup_lng, ce.centroid_lat, ce.centroid_lng FROM d LEFT JOIN ce USING (zone_id)),"
           + geo_ctes("dj", "c", "pickup_lat", "pickup_lng", "centroid_lat", "centroid_lng", "dc")))


def te_ctes(src: str, col: str, out: str, gm_name: str) -> str:
    return (f"{out} AS (SELECT {col}, (n * mu + 10e0 * (SELECT g FROM {gm_name})) / (n + 10e0) AS {col}_encoded FROM"
            f" (SELECT {col}, avg(actual_eta_minutes) AS mu, count(actual_eta_minutes) AS n FROM {src}"
            f" WHERE {col} IS NOT NULL GROUP BY {col}) WHERE n >= 5)")


SQL["target_encoding_fit"] = with_d(
    "SELECT restaurant_id, round(restaurant_id_encoded, 6) AS restaurant_id_encoded FROM ter",
    extra=TRAIN + ",\ngm AS (SELECT avg(actual_eta_minutes) AS g FROM tr),\n" + te_ctes("tr", "restaurant_id", "ter", "gm"))
SQL["join_target_encoding"] = with_d("""
SELECT d.order_id, round(coalesce(tz.zone_id_encoded, (SELECT g FROM gm)), 6) AS zone_id_encoded,
  round(coalesce(tt.restaurant_type_encoded, (SELECT g FROM gm)), 6) AS restaurant_type_encoded
FROM d LEFT JOIN tz USING (zone_id) LEFT JOIN tt USING (restaurant_type)""",
    extra=("f6 AS (SELECT * FROM d WHERE order_timestamp < TIMESTAMP '2024-01-16' AND zone_id <= 6),\n"
           "gm AS (SELECT avg(actual_eta_minutes) AS g FROM f6),\n" + te_ctes("f6", "zone_id", "tz", "gm") + ",\n"
           + te_ctes("f6", "restaurant_type", "tt", "gm")))


def stats_cte(src: str, key: str, out: str) -> str:
    return (f"{out} AS (SELECT {key}, avg(actual_eta_minutes) AS {key}_eta_mean,"
            f" quantile_cont(actual_eta_minutes, 0.5) AS {key}_eta_median,"
            f" stddev_samp(actual_eta_minutes) AS {key}_eta_std, count(actual_eta_minutes) AS {key}_order_count"
            f" FROM {src} WHERE {key} IS NOT NULL GROUP BY {key}),\n"
            f"{out}_fill AS (SELECT avg({key}_eta_mean) AS fm, avg({key}_eta_median) AS fmd,"
            f" quantile_cont({key}_eta_std, 0.5) AS fs FROM {out})")


def stats_cols(key: str, out: str, cast_count: str = "BIGINT") -> str:
    return (f"coalesce({out}.{key}_eta_mean, (SELECT fm FROM {out}_fill)) AS {key}_eta_mean,"
            f" coalesce({out}.{key}_eta_median, (SELECT fmd FROM {out}_fill)) AS {key}_eta_median,"
            f" coalesce({out}.{key}_eta_std, (SELECT fs FROM {out}_fill)) AS {key}_eta_std,"
            f" CAST(coalesce({out}.{key}_order_count, 0) AS {cast_count}) AS {key}_order_count")


SQL["group_eta_stats"] = with_d("""
SELECT restaurant_id, round(restaurant_id_eta_mean, 6) AS restaurant_id_eta_mean, round(restaurant_id_eta_median, 6) AS restaurant_id_eta_median,
  round(restaurant_id_eta_std, 6) AS restaurant_id_eta_std, restaurant_id_order_count FROM gs""",
    extra=TRAIN + ",\n" + stats_cte("tr", "restaurant_id", "gs"))
ZS6 = "f6 AS (SELECT * FROM d WHERE order_timestamp < TIMESTAMP '2024-01-16' AND zone_id <= 6),\n" + stats_cte("f6", "zone_id", "zs")
SQL["join_group_stats"] = with_d(
    "SELECT order_id, round(zone_id_eta_mean, 6) AS zone_id_eta_mean, round(zone_id_eta_median, 6) AS zone_id_eta_median,"
    " round(zone_id_eta_std, 6) AS zone_id_eta_std, zone_id_order_count"
    f" FROM (SELECT d.order_id, {stats_cols('zone_id', 'zs')} FROM d LEFT JOIN zs USING (zone_id))", extra=ZS6)
SQL["fill_group_stats"] = with_d(
    "SELECT DISTINCT zone_id, round(zone_id_eta_mean, 6) AS zone_id_eta_mean, round(zone_id_eta_median, 6) AS zone_id_eta_median,"
    " round(zone_id_eta_std, 6) AS zone_id_eta_std, zone_id_order_count"
    f" FROM (SELECT d.zone_id, {stats_cols('zone_id', 'zs')} FROM d LEFT JOIN zs USING (zone_id))", extra=ZS6)
SQL["lookup_zone_stats_with_defaults"] = with_d("""
SELECT d.order_id, round(coalesce(zs.zone_id_eta_mean, 25e0), 6) AS zone_id_eta_mean,
  round(coalesce(zs.zone_id_eta_median, 23e0), 6) AS zone_id_eta_median, round(coalesce(zs.zone_id_eta_std, 8e0), 6) AS zone_id_eta_std,
  CAST(coalesce(zs.zone_id_order_count, 1000) AS BIGINT) AS zone_id_order_count, zs.zone_id IS NOT NULL AS zone_stats_hit,
  0e0 AS zone_id_encoded, 0e0 AS restaurant_type_encoded
FROM d LEFT JOIN zs USING (zone_id)""", extra=ZS6)
SQL["lookup_hit_rate"] = with_d("""
SELECT 'zone_stats' AS lookup_type, count(*) FILTER (WHERE zs.zone_id IS NOT NULL) AS hits,
  count(*) FILTER (WHERE zs.zone_id IS NULL) AS misses FROM d LEFT JOIN zs USING (zone_id)""", extra=ZS6)
ZC = "SELECT zone_id, count(*) AS order_count, round(max(actual_eta_minutes), 6) AS max_eta FROM {src} GROUP BY zone_id"
SQL["upsert_zone_statistics"] = with_d(
    f"SELECT * FROM ex UNION ALL SELECT * FROM ({ZC.format(src='d')}) WHERE zone_id NOT IN (SELECT zone_id FROM ex)",
    extra=f"ex AS ({ZC.format(src='d WHERE order_timestamp < TIMESTAMP ' + chr(39) + '2024-01-16' + chr(39) + ' AND zone_id <= 6')})")
SQL["touch_updated_at"] = with_d("""
SELECT coalesce(o.zone_id, n.zone_id) AS zone_id,
  CASE WHEN n.zone_id IS NOT NULL THEN n.order_count ELSE o.order_count END AS order_count,
  CASE WHEN n.zone_id IS NOT NULL THEN n.max_eta ELSE o.max_eta END AS max_eta,
  CASE WHEN n.zone_id IS NOT NULL AND (o.order_count IS DISTINCT FROM n.order_count OR o.max_eta IS DISTINCT FROM n.max_eta
        OR o.updated_at IS NULL) THEN TIMESTAMP '2024-02-01 00:00:00' ELSE o.updated_at END AS updated_at
FROM o FULL OUTER JOIN n USING (zone_id)""",
    extra=(TRAIN + f",\no AS (SELECT *, TIMESTAMP '2024-01-16 00:00:00' AS updated_at FROM ({ZC.format(src='tr')})),\n"
           f"n AS ({ZC.format(src='d WHERE zone_id <= 4')} UNION ALL {ZC.format(src='tr WHERE zone_id IN (5, 6)')})"))
SQL["impute_features_train_median"] = with_d("""
SELECT order_id, event_id, order_timestamp, round(coalesce(prep_time_minutes,
  (SELECT quantile_cont(prep_time_minutes, 0.5) FROM raw WHERE order_timestamp < TIMESTAMP '2024-01-16')), 6) AS prep_time_minutes
FROM raw""", raw=True)


def pipeline_ctes(src: str, fit: str, with_restaurant_stats: bool = False, agg_keys=("zone_id",)) -> str:
    """Feature pipeline fitted on ``fit`` and applied to ``src`` -> CTE ``fp``."""
    parts = [
        f"ce AS (SELECT zone_id, avg(pickup_lat) AS centroid_lat, avg(pickup_lng) AS centroid_lng FROM {fit} WHERE zone_id IS NOT NULL GROUP BY zone_id)",
        f"gm AS (SELECT avg(actual_eta_minutes) AS g FROM {fit})",
        te_ctes(fit, "zone_id", "tz", "gm"),
        te_ctes(fit, "restaurant_type", "tt", "gm"),
    ]
    for k in agg_keys:
        parts.append(stats_cte(fit, k, f"s_{k}"))
    stat_sel = ", ".join(stats_cols(k, f"s_{k}") for k in agg_keys)
    stat_join = " ".join(f"LEFT JOIN s_{k} USING ({k})" for k in agg_keys)
    parts.append(
        f"j0 AS (SELECT x.*, ce.centroid_lat, ce.centroid_lng,"
        f" coalesce(tz.zone_id_encoded, (SELECT g FROM gm)) AS zone_id_encoded,"
        f" coalesce(tt.restaurant_type_encoded, (SELECT g FROM gm)) AS restaurant_type_encoded, {stat_sel}"
        f" FROM {src} x LEFT JOIN ce USING (zone_id) LEFT JOIN tz USING (zone_id) LEFT JOIN tt USING (restaurant_type) {stat_join})")
    parts.append(geo_ctes("j0", "g", "pickup_lat", "pickup_lng", "dropoff_lat", "dropoff_lng", "haversine_distance_km").strip())
    parts.append(geo_ctes("g3", "c", "pickup_lat", "pickup_lng", "centroid_lat", "centroid_lng", "dc").strip())
    b = bearing_sql()
    parts.append(f"""fp AS (SELECT *, CASE WHEN centroid_lat IS NULL THEN 0e0 ELSE dc END AS dist_to_zone_centroid,
  {b} AS bearing, sin(radians({b})) AS bearing_sin, cos(radians({b})) AS bearing_cos,
  abs(dropoff_lat - pickup_lat) AS lat_diff, abs(dropoff_lng - pickup_lng) AS lng_diff,
  abs(dropoff_lat - pickup_lat) + abs(dropoff_lng - pickup_lng) AS manhattan_proxy,
  CAST(hour(order_timestamp) AS BIGINT) AS hour_of_day, CAST(isodow(order_timestamp) - 1 AS BIGINT) AS day_of_week,
  CAST(month(order_timestamp) AS BIGINT) AS month, CAST(day(order_timestamp) AS BIGINT) AS day_of_month,
  CAST(weekofyear(order_timestamp) AS BIGINT) AS week_of_year,
  sin(2e0 * pi() * hour(order_timestamp) / 24e0) AS hour_sin, cos(2e0 * pi() * hour(order_timestamp) / 24e0) AS hour_cos,
  sin(2e0 * pi() * (isodow(order_timestamp) - 1) / 7e0) AS dow_sin, cos(2e0 * pi() * (isodow(order_timestamp) - 1) / 7e0) AS dow_cos,
  sin(2e0 * pi() * month(order_timestamp) / 12e0) AS month_sin, cos(2e0 * pi() * month(order_timestamp) / 12e0) AS month_cos,
  CAST(hour(order_timestamp) BETWEEN 7 AND 9 AS BIGINT) AS is_morning_rush, CAST(hour(order_timestamp) BETWEEN 11 AND 14 AS BIGINT) AS is_lunch_rush,
  CAST(hour(order_timestamp) BETWEEN 17 AND 21 AS BIGINT) AS is_dinner_rush,
  CAST(hour(order_timestamp) >= 22 OR hour(order_timestamp) <= 5 AS BIGINT) AS is_late_night,
  CAST(isodow(order_timestamp) - 1 >= 5 AS BIGINT) AS is_weekend,
  CAST({WEATHER_ORD} AS BIGINT) AS weather_encoded,
  CAST(coalesce(weather_condition = 'cloudy', false) AS BIGINT) AS weather_cloudy,
  CAST(coalesce(weather_condition = 'fog', false) AS BIGINT) AS weather_fog,
  CAST(coalesce(weather_condition = 'heavy_rain', false) AS BIGINT) AS weather_heavy_rain,
  CAST(coalesce(weather_condition = 'rain', false) AS BIGINT) AS weather_rain
  FROM c3)""")
    return ",\n".join(parts)


FEATURE_OUT = ["order_id", "haversine_distance_km", "bearing", "bearing_sin", "bearing_cos", "lat_diff", "lng_diff",
               "manhattan_proxy", "dist_to_zone_centroid", "hour_of_day", "day_of_week", "month", "day_of_month",
               "week_of_year", "hour_sin", "hour_cos", "dow_sin", "dow_cos", "month_sin", "month_cos",
               "is_morning_rush", "is_lunch_rush", "is_dinner_rush", "is_late_night", "is_weekend",
               "zone_id_encoded", "restaurant_type_encoded", "zone_id_eta_mean", "zone_id_eta_median", "zone_id_eta_std",
               "zone_id_order_count", "weather_encoded", "weather_cloudy", "weather_fog", "weather_heavy_rain", "weather_rain"]
DOUBLE_FEATURES = {"haversine_distance_km", "bearing", "bearing_sin", "bearing_cos", "lat_diff", "lng_diff",
                   "manhattan_proxy", "dist_to_zone_centroid", "hour_sin", "hour_cos", "dow_sin", "dow_cos", "month_sin",
                   "month_cos", "zone_id_encoded", "restaurant_type_encoded", "zone_id_eta_mean", "zone_id_eta_median",
                   "zone_id_eta_std", "weather_multiplier", "traffic_multiplier", "rider_avg_speed_kmh",
                   "rider_reliability", "prep_time_minutes"}


def sel(cols) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" if c in DOUBLE_FEATURES else c for c in cols)


SQL["feature_pipeline"] = with_d(f"SELECT {sel(FEATURE_OUT)} FROM fp", extra=TRAIN + ",\n" + pipeline_ctes("d", "tr"))
SQL["prepare_inference"] = with_d(f"SELECT {sel(FEATURE_OUT)} FROM fp",
                                  extra=TRAIN + ",\n" + TEST + ",\n" + pipeline_ctes("te", "tr"))
MODEL_FEATURES = ["haversine_distance_km", "bearing_sin", "bearing_cos", "lat_diff", "lng_diff", "manhattan_proxy",
                  "hour_of_day", "day_of_week", "hour_sin", "hour_cos", "dow_sin", "dow_cos", "is_morning_rush",
                  "is_lunch_rush", "is_dinner_rush", "is_late_night", "is_weekend", "zone_id_encoded",
                  "restaurant_type_encoded", "zone_id_eta_mean", "zone_id_eta_std", "zone_id_order_count",
                  "weather_encoded", "weather_multiplier", "traffic_multiplier", "rider_avg_speed_kmh",
                  "rider_reliability", "prep_time_minutes"]
SQL["select_model_features"] = with_d(f"SELECT order_id, {sel(MODEL_FEATURES)} FROM fp",
                                      extra=TRAIN + ",\n" + pipeline_ctes("d", "tr"))
SQL["complete_features"] = with_d(
    "SELECT order_id, " + ", ".join(
        f"round(coalesce(CAST({'0e0' if c == 'rider_reliability' else c} AS DOUBLE), 0e0), 6) AS {c}" for c in MODEL_FEATURES)
    + " FROM fp", extra=TRAIN + ",\n" + pipeline_ctes("d", "tr"))
PT = ["zone_id_encoded", "restaurant_type_encoded", "zone_id_eta_mean", "zone_id_eta_median", "zone_id_eta_std",
      "restaurant_id_eta_mean", "restaurant_id_eta_median", "restaurant_id_eta_std"]
SQL["prepare_training"] = with_d(
    "SELECT order_id, " + ", ".join(f"round({c}, 6) AS {c}" for c in PT) + ", zone_id_order_count, restaurant_id_order_count FROM fp",
    extra=TRAIN + ",\n" + pipeline_ctes("tr", "tr", agg_keys=("zone_id", "restaurant_id")))

LAG = """SELECT order_id, {cols} FROM (SELECT order_id, {inner} FROM d) x"""
_lag_inner = ", ".join(
    f"coalesce(lag(actual_eta_minutes, {k}) OVER (PARTITION BY zone_id ORDER BY order_timestamp, order_id),"
    f" (SELECT avg(actual_eta_minutes) FROM tr)) AS l{k}" for k in (1, 3, 7))
SQL["lag_features"] = with_d(
    LAG.format(cols=", ".join(f"round(l{k}, 6) AS zone_id_actual_eta_minutes_lag_{k}" for k in (1, 3, 7)), inner=_lag_inner),
    extra=TRAIN)
SQL["rolling_mean_prior5"] = with_d(
    "SELECT order_id, round(coalesce(avg(actual_eta_minutes) OVER (PARTITION BY restaurant_id ORDER BY order_timestamp, order_id"
    " ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING), (SELECT avg(actual_eta_minutes) FROM tr)), 6)"
    " AS restaurant_id_actual_eta_minutes_rolling_mean FROM d", extra=TRAIN)
SQL["concat_columns"] = with_d(
    f"SELECT order_id, order_timestamp, CAST({WEATHER_ORD} AS BIGINT) AS weather_encoded,"
    " CAST(coalesce(weather_condition = 'cloudy', false) AS BIGINT) AS weather_cloudy,"
    " CAST(coalesce(weather_condition = 'fog', false) AS BIGINT) AS weather_fog,"
    " CAST(coalesce(weather_condition = 'heavy_rain', false) AS BIGINT) AS weather_heavy_rain,"
    " CAST(coalesce(weather_condition = 'rain', false) AS BIGINT) AS weather_rain FROM raw", raw=True)
SQL["tagged_union"] = with_d(
    "SELECT order_id, round(actual_eta_minutes, 6) AS actual_eta_minutes, 'reference' AS w FROM d WHERE order_timestamp < TIMESTAMP '2024-01-16'"
    " UNION ALL SELECT order_id, round(actual_eta_minutes, 6), 'current' FROM d WHERE order_timestamp >= TIMESTAMP '2024-01-16'")
SQL["enrich_orders_with_dims"] = """
SELECT o.o_orderkey, round(o.o_totalprice, 6) AS o_totalprice, c.c_name, c.c_mktsegment, n.n_name
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey"""
SQL["distance_matrix"] = with_d(
    "SELECT origin_idx, dest_idx, round(km, 6) AS distance_km, round(km / 25e0 * 60e0, 6) AS duration_minutes,"
    " round(km / 25e0 * 60e0 * 1.2e0, 6) AS duration_in_traffic_minutes FROM m3",
    extra=("od AS (SELECT o.origin_idx, o.lat AS o_lat, o.lng AS o_lng, t.dest_idx, t.lat AS d_lat, t.lng AS d_lng FROM"
           " (SELECT CAST(zone_id AS BIGINT) AS origin_idx, avg(pickup_lat) AS lat, avg(pickup_lng) AS lng FROM d GROUP BY zone_id) o,"
           " (SELECT restaurant_id AS dest_idx, avg(dropoff_lat) AS lat, avg(dropoff_lng) AS lng FROM d GROUP BY restaurant_id) t,"
           " (SELECT DISTINCT zone_id, restaurant_id FROM d) q WHERE q.zone_id = o.origin_idx AND q.restaurant_id = t.dest_idx),"
           + geo_ctes("od", "m", "o_lat", "o_lng", "d_lat", "d_lng", "km")))
SQL["join_prediction_feedback"] = with_pred("""
SELECT substring(md5(concat_ws('-', order_id, 'v1')), 1, 12) AS prediction_id, round(predicted_eta_minutes, 6) AS predicted_eta_minutes,
  round(CASE WHEN event_id % 3 != 0 THEN actual_eta_minutes END, 6) AS actual_eta_minutes,
  round(predicted_eta_minutes - CASE WHEN event_id % 3 != 0 THEN actual_eta_minutes END, 6) AS error FROM p""")
REQ = """rq AS (SELECT order_id, event_id, pickup_lat, pickup_lng, dropoff_lat,
  CASE WHEN event_id % 31 = 0 THEN NULL ELSE dropoff_lng END AS dropoff_lng, zone_id,
  CASE WHEN event_id % 7 = 0 THEN '' ELSE restaurant_type END AS restaurant_type,
  CASE WHEN event_id % 13 = 0 THEN NULL ELSE order_timestamp END AS order_time,
  CASE WHEN event_id % 11 = 0 THEN 0e0 ELSE traffic_multiplier END AS traffic_multiplier, weather_condition, prep_time_minutes,
  CASE WHEN event_id % 37 = 0 THEN 60e0 ELSE rider_avg_speed_kmh END AS rider_avg_speed_kmh FROM raw)"""
_errs = [f"CASE WHEN {c} IS NULL THEN '{c}: missing' END" for c in ("pickup_lat", "pickup_lng", "dropoff_lat", "dropoff_lng")]
_errs += [f"CASE WHEN {c} < {lo} OR {c} > {hi} THEN '{c}: out of range [{lo}, {hi}]' END" for c, lo, hi in [
    ("pickup_lat", "-90.0", "90.0"), ("pickup_lng", "-180.0", "180.0"), ("dropoff_lat", "-90.0", "90.0"),
    ("dropoff_lng", "-180.0", "180.0"), ("zone_id", "1", "100"), ("traffic_multiplier", "0.5", "3.0"),
    ("prep_time_minutes", "1.0", "60.0"), ("rider_avg_speed_kmh", "5.0", "50.0")]]
SQL["request_validity"] = with_d(
    f"SELECT order_id, event_id, errors = '' AS is_valid, errors FROM (SELECT order_id, event_id, concat_ws('; ', {', '.join(_errs)}) AS errors FROM rq)",
    raw=True, extra=REQ)
SQL["request_defaults"] = with_d("""
SELECT order_id, event_id, coalesce(nullif(zone_id, 0), 1) AS zone_id, coalesce(nullif(restaurant_type, ''), 'casual') AS restaurant_type,
  round(coalesce(nullif(traffic_multiplier, 0e0), 1.2e0), 6) AS traffic_multiplier,
  coalesce(nullif(weather_condition, ''), 'clear') AS weather_condition,
  round(coalesce(nullif(prep_time_minutes, 0e0), 15e0), 6) AS prep_time_minutes,
  round(coalesce(nullif(rider_avg_speed_kmh, 0e0), 25e0), 6) AS rider_avg_speed_kmh, 0.95e0 AS rider_reliability,
  coalesce(order_time, TIMESTAMP '2024-02-01 00:00:00') AS order_time FROM rq""", raw=True, extra=REQ)

# ---- sources and sinks ------------------------------------------------------------------------
SQL["scan_restaurants"] = with_d("""
SELECT restaurant_id, min(zone_id) AS zone_id, min(restaurant_type) AS restaurant_type, round(avg(pickup_lat), 6) AS lat,
  round(avg(pickup_lng), 6) AS lng, round(avg(prep_time_minutes), 6) AS base_prep_time, count(*) AS order_volume
FROM d GROUP BY restaurant_id""")
SQL["scan_riders"] = """
SELECT concat('D', lpad(CAST(user_id AS VARCHAR), 4, '0')) AS rider_id, round(avg(15e0 + event_id % 20), 6) AS avg_speed_kmh,
  round(avg(0.85e0 + (event_id % 15) / 100e0), 6) AS reliability_score, count(*) AS completed_deliveries
FROM events GROUP BY user_id"""
SQL["scan_orders"] = SQL["date_range_filter"]
SQL["load_training_data"] = SQL["date_range_filter"]
SQL["scan_orders_limit"] = with_d(
    f"SELECT {ROUNDED_D} FROM d WHERE order_timestamp <= TIMESTAMP '2024-01-20' ORDER BY order_timestamp, order_id LIMIT 500")
SQL["scan_orders_csv"] = with_d(f"SELECT {ROUNDED_D} FROM d")
SQL["load_validated"] = SQL["scan_orders_csv"]
SQL["load_model"] = with_d("SELECT order_id, true AS same, 'v1' AS version, 28 AS n_features, true AS same_mae FROM d")
SQL["prediction_records"] = with_d("""
SELECT order_id, substring(md5(concat_ws('-', order_id, 'gbt-v1')), 1, 12) AS prediction_id, 'gbt-v1' AS model_version,
  true AS same, true AS in_interval FROM d""")
SQL["importance_records"] = (
    "SELECT unnest([" + ", ".join(f"'{c}'" for c in MODEL_FEATURES) + "]) AS feature, true AS sums_to_one, true AS descending,"
    " true AS same_in_csv, true AS top_agrees")
SQL["evaluation_records"] = with_d("""
SELECT part, segment, count(*) AS n, true AS same_mae, 28 AS n_features
FROM (SELECT unnest(CASE WHEN is_train THEN [{'part': 'train', 'segment': CAST(-1 AS BIGINT)}]
                    ELSE [{'part': 'test', 'segment': CAST(-1 AS BIGINT)}, {'part': 'hour_of_day', 'segment': CAST(hour(order_timestamp) AS BIGINT)},
                          {'part': 'day_of_week', 'segment': CAST(isodow(order_timestamp) - 1 AS BIGINT)}] END, recursive := true)
      FROM (SELECT *, row_number() OVER (ORDER BY order_timestamp, order_id) <= floor(count(*) OVER () * (1e0 - 0.2e0)) AS is_train FROM d))
GROUP BY part, segment""")
SQL["sink_segment_csv"] = with_pred(" UNION ALL ".join(
    f"SELECT '{name}' AS segment_by, * FROM ({SEG.format(seg=seg, segcast='CAST(s AS BIGINT)', having='')})"
    for name, seg in (("hour_of_day", "hour(order_timestamp)"), ("day_of_week", "isodow(order_timestamp) - 1"))))
SQL["sink_report_json"] = with_pred("""SELECT count(*) AS n, round(avg(abs(e)), 6) AS mae, round(sqrt(avg(e * e)), 6) AS rmse,
  round(1e0 - sum(e * e) / (var_pop(y) * count(*)), 6) AS r2,
  CASE WHEN (avg(abs(e) / greatest(abs(y), 2.220446049250313e-16)) * 100e0) IS NULL OR (avg(abs(e) / greatest(abs(y), 2.220446049250313e-16)) * 100e0) = 0 THEN (avg(abs(e) / greatest(abs(y), 2.220446049250313e-16)) * 100e0) WHEN (floor(log10(abs(avg(abs(e) / greatest(abs(y), 2.220446049250313e-16)) * 100e0))) + 1 - 12) >= 0 THEN round((avg(abs(e) / greatest(abs(y), 2.220446049250313e-16)) * 100e0) / pow(10e0, (floor(log10(abs(avg(abs(e) / greatest(abs(y), 2.220446049250313e-16)) * 100e0))) + 1 - 12))) * pow(10e0, (floor(log10(abs(avg(abs(e) / greatest(abs(y), 2.220446049250313e-16)) * 100e0))) + 1 - 12)) ELSE round((avg(abs(e) / greatest(abs(y), 2.220446049250313e-16)) * 100e0) * pow(10e0, -(floor(log10(abs(avg(abs(e) / greatest(abs(y), 2.220446049250313e-16)) * 100e0))) + 1 - 12))) / pow(10e0, -(floor(log10(abs(avg(abs(e) / greatest(abs(y), 2.220446049250313e-16)) * 100e0))) + 1 - 12)) END AS mape,
  round(avg(e), 6) AS mean_error, round(stddev_pop(e), 6) AS std_error, round(max(abs(e)), 6) AS max_error,
  round(avg(CASE WHEN abs(e) <= 5 THEN 1e0 ELSE 0e0 END) * 100e0, 6) AS within_5min_pct,
  round(avg(CASE WHEN abs(e) <= 10 THEN 1e0 ELSE 0e0 END) * 100e0, 6) AS within_10min_pct,
  round(avg(CASE WHEN abs(e) <= 15 THEN 1e0 ELSE 0e0 END) * 100e0, 6) AS within_15min_pct
FROM (SELECT actual_eta_minutes AS y, actual_eta_minutes - predicted_eta_minutes AS e FROM p)""")
_REGROW = """SELECT 'eta_model' AS model_name, '{v}' AS version, '{s}' AS stage, round(avg(abs(e)), 6) AS mae,
  round(sqrt(avg(e * e)), 6) AS rmse, round(1e0 - sum(e * e) / (var_pop(y) * count(*)), 6) AS r2,
  'models/eta_model/{v}' AS artifact_path
FROM (SELECT actual_eta_minutes AS y, actual_eta_minutes - predicted_eta_minutes AS e FROM p WHERE order_timestamp {op} TIMESTAMP '2024-01-16')"""
SQL["register_model_version"] = with_pred(
    _REGROW.format(v="v1", s="production", op="<") + "\nUNION ALL\n" + _REGROW.format(v="v2", s="staging", op=">="))
SQL["prediction_log_sink"] = with_pred("""
SELECT substring(md5(concat_ws('-', order_id, 'v1')), 1, 12) AS prediction_id, order_timestamp AS request_timestamp, zone_id,
  round(predicted_eta_minutes, 6) AS predicted_eta_minutes, 'v1' AS model_version, round(prep_time_minutes, 6) AS prep_time_minutes,
  round(traffic_multiplier, 6) AS traffic_multiplier, weather_condition FROM p""")


# ---- drift ------------------------------------------------------------------------------------
REFCUR = "t AS (SELECT *, true AS is_ref FROM p WHERE order_timestamp < TIMESTAMP '2024-01-16'" \
         " UNION ALL SELECT *, false FROM pc WHERE order_timestamp >= TIMESTAMP '2024-01-16')"
DRIFT_NUMERIC = ["pickup_lat", "pickup_lng", "dropoff_lat", "dropoff_lng", "rider_avg_speed_kmh", "traffic_multiplier",
                 "prep_time_minutes", "weather_multiplier", "zone_id"]
DRIFT_CATEGORICAL = ["restaurant_type", "weather_condition", "restaurant_id"]


def num_drift_ctes(cols: list[str], out: str = "nd") -> str:
    lg = " UNION ALL ".join(f"SELECT '{c}' AS col, CAST({c} AS DOUBLE) AS value, is_ref FROM t" for c in cols)
    return f"""{out}_lg AS ({lg}),
{out}_vc AS (SELECT col, value, count(*) FILTER (WHERE is_ref) AS nr, count(*) FILTER (WHERE NOT is_ref) AS nc
  FROM {out}_lg WHERE value IS NOT NULL GROUP BY col, value),
{out}_cu AS (SELECT *, sum(nr) OVER w AS cr, sum(nc) OVER w AS cc, sum(nr) OVER (PARTITION BY col) AS n_ref,
  sum(nc) OVER (PARTITION BY col) AS n_cur FROM {out}_vc WINDOW w AS (PARTITION BY col ORDER BY value ROWS UNBOUNDED PRECEDING)),
{out}_st AS (SELECT col, n_ref, n_cur, sum(value * (abs((cr - nr) / n_ref - (cc - nc) / n_cur) - abs(cr / n_ref - cc / n_cur))) AS w1,
  max(abs(cr / n_ref - cc / n_cur)) AS ks FROM {out}_cu GROUP BY col, n_ref, n_cur),
{out}_sd AS (SELECT col, stddev_pop(value) AS ref_std FROM {out}_lg WHERE is_ref GROUP BY col),
{out}_pv AS (SELECT col, least(1e0, greatest(0e0, CASE WHEN lam <= 0 THEN 1e0
    WHEN lam < 1.18e0 THEN 1e0 - sqrt(2e0 * pi()) / lam * sum(exp(-pow(2e0 * j - 1, 2) * pow(pi(), 2) / (8e0 * lam * lam)))
    ELSE 2e0 * sum(pow(-1e0, j - 1) * exp(-2e0 * j * j * lam * lam)) END)) AS p
  FROM (SELECT col, (en + 0.12e0 + 0.11e0 / en) * ks AS lam FROM (SELECT col, ks, sqrt(n_ref * n_cur / (n_ref + n_cur)) AS en FROM {out}_st)),
  range(1, 101) r(j) GROUP BY col, lam),
{out} AS (SELECT s.col AS "column", 'numeric' AS kind, 'wasserstein' AS stattest, CAST(n_ref AS BIGINT) AS n_ref,
  CAST(n_cur AS BIGINT) AS n_cur, w1 AS wasserstein, ref_std, w1 / nullif(ref_std, 0) AS drift_score, ks AS ks_statistic,
  pv.p AS ks_pvalue, coalesce(w1 / nullif(ref_std, 0) > 0.1e0, w1 > 0) AS drift_detected
  FROM {out}_st s LEFT JOIN {out}_sd USING (col) JOIN {out}_pv pv USING (col))"""


def cat_drift_ctes(cols: list[str], out: str = "cd") -> str:
    lg = " UNION ALL ".join(f"SELECT '{c}' AS col, CAST({c} AS VARCHAR) AS value, is_ref FROM t" for c in cols)
    return f"""{out}_lg AS ({lg}),
{out}_vc AS (SELECT col, value, count(*) FILTER (WHERE is_ref) AS nr, count(*) FILTER (WHERE NOT is_ref) AS nc
  FROM {out}_lg WHERE value IS NOT NULL GROUP BY col, value),
{out}_j AS (SELECT *, nr / sum(nr) OVER (PARTITION BY col) AS p, nc / sum(nc) OVER (PARTITION BY col) AS q,
  sum(nr) OVER (PARTITION BY col) AS n_ref, sum(nc) OVER (PARTITION BY col) AS n_cur FROM {out}_vc),
{out} AS (SELECT col AS "column", 'categorical' AS kind, 'jensenshannon' AS stattest, CAST(n_ref AS BIGINT) AS n_ref,
  CAST(n_cur AS BIGINT) AS n_cur,
  sqrt(greatest(0e0, 0.5e0 * sum(CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0e0 END)
                   + 0.5e0 * sum(CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0e0 END))) AS drift_score,
  sum((greatest(p, 1e-4) - greatest(q, 1e-4)) * ln(greatest(p, 1e-4) / greatest(q, 1e-4))) AS psi,
  sum(pow(nr - (nr + nc) * n_ref / (n_ref + n_cur), 2) / ((nr + nc) * n_ref / (n_ref + n_cur))
    + pow(nc - (nr + nc) * n_cur / (n_ref + n_cur), 2) / ((nr + nc) * n_cur / (n_ref + n_cur))) AS chi2_statistic, count(*) - 1 AS chi2_df
  FROM {out}_j GROUP BY col, n_ref, n_cur)"""


def with_drift(body: str, shift: float = 0.0, numeric=DRIFT_NUMERIC, categorical=DRIFT_CATEGORICAL) -> str:
    pc = f"pc AS (SELECT * REPLACE (actual_eta_minutes + {shift}e0 AS actual_eta_minutes) FROM p)"
    parts = [geo_d().strip(), PRED, pc, REFCUR]
    if numeric:
        parts.append(num_drift_ctes(numeric))
    if categorical:
        parts.append(cat_drift_ctes(categorical))
    if numeric and categorical:
        parts.append("al AS (SELECT \"column\", drift_detected, drift_score AS score, stattest AS test FROM nd UNION ALL"
                     " SELECT \"column\", drift_score > 0.1e0, drift_score, stattest FROM cd)")
    return with_d(body, extra=",\n".join(parts))


SQL["column_drift_numeric"] = with_drift("""
SELECT "column", kind, stattest, n_ref, n_cur, round(wasserstein, 6) AS wasserstein, round(ref_std, 6) AS ref_std,
  round(drift_score, 6) AS drift_score, round(ks_statistic, 6) AS ks_statistic, round(ks_pvalue, 6) AS ks_pvalue, drift_detected
FROM nd""", categorical=[])
SQL["column_drift_categorical"] = with_drift("""
SELECT "column", kind, stattest, n_ref, n_cur, round(drift_score, 6) AS drift_score, round(psi, 6) AS psi,
  drift_score > 0.1e0 AS drift_detected, round(chi2_statistic, 6) AS chi2_statistic, chi2_df,
  round(CASE WHEN chi2_df < 1 OR chi2_statistic <= 0 THEN 1e0 ELSE greatest(0e0, 1e0 - list_sum(list_transform(range(0, 2000), lambda n:
    exp((chi2_df / 2e0 + n) * ln(chi2_statistic / 2e0) - chi2_statistic / 2e0 - lgamma(chi2_df / 2e0 + n + 1))))) END, 6) AS chi2_pvalue
FROM cd""", numeric=[])
SQL["dataset_drift"] = with_drift("""
SELECT round(avg(CAST(drift_detected AS DOUBLE)), 6) AS drift_share, count(*) FILTER (WHERE drift_detected) AS n_drifted_columns,
  count(*) AS n_columns, coalesce(string_agg("column", ',' ORDER BY "column") FILTER (WHERE drift_detected), '') AS drifted_columns,
  coalesce(string_agg("column" || ':' || test || ':' || printf('%.4f', score), ',' ORDER BY "column") FILTER (WHERE drift_detected), '') AS drifted,
  avg(CAST(drift_detected AS DOUBLE)) >= 0.5e0 AS drift_detected,
  (SELECT count(*) FROM t WHERE is_ref) AS n_reference_samples, (SELECT count(*) FROM t WHERE NOT is_ref) AS n_current_samples
FROM al""")
SQL["monitoring_gauges"] = with_drift("""
SELECT 'data_drift_detected' AS gauge, CASE WHEN avg(CAST(drift_detected AS DOUBLE)) >= 0.5e0 THEN 1e0 ELSE 0e0 END AS value FROM al
UNION ALL SELECT 'data_drift_share', round(avg(CAST(drift_detected AS DOUBLE)), 6) FROM al
UNION ALL SELECT 'model_feature_count', CAST(count(*) AS DOUBLE) FROM al""")
SQL["target_drift"] = with_drift("""
SELECT drift_detected AS target_drift_detected, round(drift_score, 6) AS drift_score, stattest,
  (SELECT round(avg(actual_eta_minutes), 6) FROM t WHERE is_ref) AS reference_mean,
  (SELECT round(stddev_samp(actual_eta_minutes), 6) FROM t WHERE is_ref) AS reference_std,
  (SELECT round(avg(actual_eta_minutes), 6) FROM t WHERE NOT is_ref) AS current_mean,
  (SELECT round(stddev_samp(actual_eta_minutes), 6) FROM t WHERE NOT is_ref) AS current_std
FROM nd""", shift=20.0, numeric=["actual_eta_minutes"], categorical=[])
SQL["prediction_drift"] = with_drift("""
SELECT "column", kind, stattest, n_ref, n_cur, round(wasserstein, 6) AS wasserstein, round(ref_std, 6) AS ref_std,
  round(drift_score, 6) AS drift_score, round(ks_statistic, 6) AS ks_statistic, round(ks_pvalue, 6) AS ks_pvalue, drift_detected
FROM nd""", numeric=["predicted_eta_minutes"], categorical=[])
QUALITY = """round(avg(abs(e)), 6) AS mae, round(sqrt(avg(e * e)), 6) AS rmse,
  CASE WHEN (avg(abs(e) / greatest(abs(y), 2.220446049250313e-16)) * 100e0) IS NULL OR (avg(abs(e) / greatest(abs(y), 2.220446049250313e-16)) * 100e0) = 0 THEN (avg(abs(e) / greatest(abs(y), 2.220446049250313e-16)) * 100e0) WHEN (floor(log10(abs(avg(abs(e) / greatest(abs(y), 2.220446049250313e-16)) * 100e0))) + 1 - 12) >= 0 THEN round((avg(abs(e) / greatest(abs(y), 2.220446049250313e-16)) * 100e0) / pow(10e0, (floor(log10(abs(avg(abs(e) / greatest(abs(y), 2.220446049250313e-16)) * 100e0))) + 1 - 12))) * pow(10e0, (floor(log10(abs(avg(abs(e) / greatest(abs(y), 2.220446049250313e-16)) * 100e0))) + 1 - 12)) ELSE round((avg(abs(e) / greatest(abs(y), 2.220446049250313e-16)) * 100e0) * pow(10e0, -(floor(log10(abs(avg(abs(e) / greatest(abs(y), 2.220446049250313e-16)) * 100e0))) + 1 - 12))) / pow(10e0, -(floor(log10(abs(avg(abs(e) / greatest(abs(y), 2.220446049250313e-16)) * 100e0))) + 1 - 12)) END AS mape,
  round(1e0 - sum(e * e) / (var_pop(y) * count(*)), 6) AS r2, round(avg(e), 6) AS me"""
SQL["prediction_quality"] = with_drift(
    f"SELECT {QUALITY}, count(*) AS n_samples FROM (SELECT actual_eta_minutes AS y, predicted_eta_minutes - actual_eta_minutes AS e"
    " FROM t WHERE NOT is_ref)", numeric=[], categorical=[])
SQL["drift_test_suite"] = with_drift("""
SELECT count(*) AS n_tests, count(*) FILTER (WHERE NOT drift_detected) AS n_passed, count(*) FILTER (WHERE drift_detected) AS n_failed,
  round(count(*) FILTER (WHERE NOT drift_detected) / count(*), 6) AS pass_rate,
  count(*) FILTER (WHERE drift_detected) = 0 AS all_tests_passed FROM al""")
REPORT = """rep AS (SELECT avg(CAST(drift_detected AS DOUBLE)) AS drift_share, count(*) FILTER (WHERE drift_detected) AS n_drifted_columns,
  count(*) AS n_tests, count(*) FILTER (WHERE NOT drift_detected) AS n_passed, avg(CAST(drift_detected AS DOUBLE)) >= 0.5e0 AS drift_detected,
  (SELECT drift_detected FROM td) AS target_drift_detected, (SELECT drift_score FROM td) AS target_drift_score,
  (SELECT avg(abs(e)) FROM q) AS mae, (SELECT sqrt(avg(e * e)) FROM q) AS rmse,
  (SELECT 1e0 - sum(e * e) / (var_pop(y) * count(*)) FROM q) AS r2 FROM al)"""


def with_report(body: str) -> str:
    s = with_drift(body, shift=20.0)
    td = num_drift_ctes(["actual_eta_minutes"], "td")
    q = "q AS (SELECT actual_eta_minutes AS y, predicted_eta_minutes - actual_eta_minutes AS e FROM t WHERE NOT is_ref)"
    head, tail = s.split("\nSELECT", 1) if "\nSELECT" in s else (s, "")
    return s.replace(body, "") .rstrip() + ",\n" + td + ",\n" + q + ",\n" + REPORT + "\n" + body


SQL["monitoring_report"] = with_report("""SELECT round(drift_share, 6) AS drift_share, n_drifted_columns, n_tests, n_passed, drift_detected,
  target_drift_detected, round(target_drift_score, 6) AS target_drift_score, round(mae, 6) AS mae, round(rmse, 6) AS rmse,
  round(r2, 6) AS r2 FROM rep""")
SQL["should_retrain"] = with_report("""SELECT CAST(len(rs) AS BIGINT) AS n_reasons, len(rs) > 0 AS should_retrain, array_to_string(rs, '; ') AS reasons
FROM (SELECT list_filter([CASE WHEN coalesce(drift_share, 0) > 0.15e0 THEN 'high data drift' END,
  CASE WHEN coalesce(target_drift_detected, false) THEN 'target drift detected' END,
  CASE WHEN coalesce(mae, 0) > 5e0 THEN 'high MAE' END], lambda x: x IS NOT NULL) AS rs FROM rep)""")
SQL["append_drift_report"] = with_drift("""
SELECT TIMESTAMP '2024-02-01 00:00:00' AS report_timestamp, avg(CAST(drift_detected AS DOUBLE)) >= 0.5e0 AS drift_detected,
  round(avg(CAST(drift_detected AS DOUBLE)), 6) AS drift_share,
  coalesce(string_agg("column", ',' ORDER BY "column") FILTER (WHERE drift_detected), '') AS drifted_columns FROM al""")

# ---- monitoring counters over the prediction log ---------------------------------------------------
MLOG = """ml0 AS (SELECT rq.*, ts AS request_timestamp, rtype, y FROM rq),
ml AS (SELECT substring(md5(concat_ws('-', order_id, 'v1')), 1, 12) AS prediction_id, request_timestamp, rtype AS restaurant_type,
  CASE WHEN errs = '' THEN 'success' ELSE 'error' END AS status,
  CASE WHEN request_timestamp < TIMESTAMP '2024-01-16' THEN 'v1' ELSE 'v2' END AS model_version,
  (event_id % 997) / 10000e0 AS latency_s,
  CASE WHEN prep_time_minutes IS NULL THEN NULL ELSE greatest(5e0, prep_time_minutes + dist / rider_avg_speed_kmh * 60e0
    * traffic_multiplier * (""" + WEATHER_MULT + """) + 3e0) END AS predicted_eta_minutes,
  y AS actual_eta_minutes FROM g3)"""


def with_log(body: str) -> str:
    rq = REQ.replace("rq AS (SELECT order_id,", "rq AS (SELECT order_timestamp AS ts, actual_eta_minutes AS y, restaurant_type AS rtype, order_id,")
    errs = f"rqe AS (SELECT *, concat_ws('; ', {', '.join(_errs)}) AS errs FROM rq)"
    geo = geo_ctes("rqe", "g", "pickup_lat", "pickup_lng", "dropoff_lat", "dropoff_lng", "dist").strip()
    mlog = MLOG.split(",\n", 1)[1]
    return with_d(body, raw=True, extra=",\n".join([rq, errs, geo, mlog]).replace("FROM g3)", "FROM (SELECT *, ts AS request_timestamp, rtype, y FROM g3))"))


SQL["prediction_counter"] = with_log("SELECT status, model_version, count(*) AS count FROM ml GROUP BY status, model_version")
ACCESS = ("SELECT 'POST' AS method, CASE WHEN restaurant_type IN ('view', 'click') THEN '/predict/realtime' ELSE '/predict/batch' END AS endpoint,"
          " CAST(CASE WHEN status = 'success' THEN 200 ELSE 422 END AS BIGINT) AS status_code, latency_s FROM ml")
SQL["request_counter"] = with_log(f"SELECT method, endpoint, status_code, count(*) AS count FROM ({ACCESS}) GROUP BY ALL")


def _buckets_sql(src: str, value: str, bounds, metric: str = None, group: str = "") -> str:
    parts = []
    gsel = f"{group}, " if group else ""
    for b in list(bounds) + ["+Inf"]:
        le = "+Inf" if b == "+Inf" else str(float(b))
        cond = f"count({value})" if b == "+Inf" else f"count(*) FILTER (WHERE {value} <= {float(b)}e0)"
        mcol = f"'{metric}' AS metric, " if metric else ""
        parts.append(f"SELECT {mcol}{gsel}'{le}' AS le, CAST({cond} AS BIGINT) AS count, round(CAST(sum(CAST({value} AS DECIMAL(38,10))) AS DOUBLE), 6) AS sum"
                     + (f", count({value}) AS total" if metric else "") + f" FROM {src}" + (f" GROUP BY {group}" if group else ""))
    return " UNION ALL ".join(parts)


SQL["request_latency_hist"] = with_log(
    _buckets_sql(f"({ACCESS})", "latency_s", [0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0], group="method, endpoint"))
SQL["prediction_histograms"] = with_log(" UNION ALL ".join([
    _buckets_sql("ml", "latency_s", [0.001, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5], "prediction_latency_seconds"),
    _buckets_sql("ml", "predicted_eta_minutes", [5, 10, 15, 20, 25, 30, 40, 50, 60, 90, 120, 180], "predicted_eta_minutes"),
    _buckets_sql("(SELECT predicted_eta_minutes - actual_eta_minutes AS error FROM ml)", "error",
                 [0, 1, 2, 3, 4, 5, 7, 10, 15, 20, 30], "prediction_error_minutes"),
]))
SQL["prediction_histograms_serving"] = with_log(" UNION ALL ".join([
    _buckets_sql("ml", "latency_s", [0.01, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0], "prediction_latency_seconds"),
    _buckets_sql("ml", "predicted_eta_minutes", [5, 10, 15, 20, 25, 30, 40, 50, 60, 90, 120], "predicted_eta_minutes"),
]))
SQL["abs_error_summary"] = with_log(
    "SELECT round(CAST(sum(CAST(abs(predicted_eta_minutes - actual_eta_minutes) AS DECIMAL(38,10))) AS DOUBLE), 6) AS abs_error_sum,"
    " count(abs(predicted_eta_minutes - actual_eta_minutes)) AS abs_error_count FROM ml")
SQL["last_value_gauges"] = with_log("""
SELECT g.model_version, g.last_prediction_ts, round(l.predicted_eta_minutes, 6) AS last_predicted_eta, g.n_predictions
FROM (SELECT model_version, max(request_timestamp) AS last_prediction_ts, count(*) AS n_predictions FROM ml GROUP BY model_version) g
JOIN ml l ON l.model_version = g.model_version AND l.request_timestamp = g.last_prediction_ts""")


# ---- streaming (availableNow runs compared with the equivalent batch SQL) ----------------------
_d_errs = [e for e in _errs]
SQL["stream_score_orders"] = with_pred(
    f"SELECT order_id, concat_ws('; ', {', '.join(_d_errs)}) = '' AS is_valid, round(predicted_eta_minutes, 6) AS raw_prediction,"
    f" {half_up_1dp('predicted_eta_minutes')} AS predicted_eta_minutes FROM p")
SQL["stream_score_orders_model"] = with_d(f"""
SELECT d.order_id, substring(md5(concat_ws('-', d.order_id, 'gbt-v1')), 1, 12) AS prediction_id,
  concat_ws('; ', {', '.join(_d_errs)}) = '' AS is_valid, zs.zone_id IS NOT NULL AS zone_stats_hit,
  true AS equals_batch, true AS in_interval
FROM d LEFT JOIN (SELECT DISTINCT zone_id AS zone_id FROM zs) zs USING (zone_id)""", extra=ZS6)
SQL["stream_prediction_metrics"] = with_pred(f"""
SELECT window_start, window_end, status, 'baseline' AS model_version, count(*) AS count, round(avg(predicted_eta_minutes), 6) AS avg_predicted
FROM (SELECT date_trunc('hour', order_timestamp) AS window_start, date_trunc('hour', order_timestamp) + INTERVAL 1 HOUR AS window_end,
        CASE WHEN concat_ws('; ', {', '.join(_d_errs)}) = '' THEN 'success' ELSE 'error' END AS status, predicted_eta_minutes FROM p)
GROUP BY window_start, window_end, status""")
_REFALL = "t AS (SELECT *, true AS is_ref FROM p WHERE order_timestamp < TIMESTAMP '2024-01-16' UNION ALL SELECT *, false FROM p)"
SQL["stream_drift_batches"] = with_drift("""
SELECT round(avg(CAST(drift_detected AS DOUBLE)), 6) AS drift_share, count(*) FILTER (WHERE drift_detected) AS n_drifted_columns,
  count(*) AS n_columns, coalesce(string_agg("column", ',' ORDER BY "column") FILTER (WHERE drift_detected), '') AS drifted_columns,
  avg(CAST(drift_detected AS DOUBLE)) >= 0.5e0 AS drift_detected,
  (SELECT count(*) FROM t WHERE is_ref) AS n_reference_samples, (SELECT count(*) FROM t WHERE NOT is_ref) AS n_current_samples,
  CAST(0 AS BIGINT) AS batch_id
FROM al""").replace(REFCUR, _REFALL)


# ---- schema-level operators ------------------------------------------------------------------------
_num = ["event_id", "zone_id", "pickup_lat", "pickup_lng", "dropoff_lat", "dropoff_lng", "rider_avg_speed_kmh",
        "rider_reliability", "traffic_multiplier", "weather_multiplier", "prep_time_minutes"]
_cat = ["order_id", "restaurant_id", "restaurant_type", "weather_condition"]
SQL["detect_feature_types"] = with_d(" UNION ALL ".join(
    [f"SELECT '{c}' AS \"column\", 'numeric' AS kind, count({c}) AS non_null FROM d" for c in _num]
    + [f"SELECT '{c}', 'categorical', count({c}) FROM d" for c in _cat]))
SQL["drop_target"] = with_d("SELECT " + ", ".join(c for c in ROUNDED_D.split(", ") if "actual_eta_minutes" not in c) + " FROM d")
SQL["validate_schema"] = with_d("SELECT false AS is_valid, 'rider_id' AS missing, count(*) AS n_rows FROM d")
SQL["scan_dims_csv"] = SQL["scan_restaurants"]

# LEFT join of all predictions to the actuals within 3 hours.
SQL["stream_feedback_join"] = with_pred("""
SELECT substring(md5(concat_ws('-', order_id, 'baseline')), 1, 12) AS prediction_id, order_timestamp AS pred_ts,
  round(predicted_eta_minutes, 6) AS predicted_eta_minutes, round(a, 6) AS actual_eta_minutes,
  round(predicted_eta_minutes - a, 6) AS error
FROM (SELECT *, CASE WHEN event_id % 3 != 0 AND floor(actual_eta_minutes) BETWEEN 0 AND 180 THEN actual_eta_minutes END AS a FROM p)""")

"""Readers for orders and dimension tables (Parquet, CSV, JDBC)."""

from __future__ import annotations

import logging

from py4j.protocol import Py4JError, Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import ID_COL, TARGET, TIME_COL
from .sinks import CSV_TS_FORMAT

log = logging.getLogger(__name__)

ORDER_COLUMNS = [
    "order_id", "order_timestamp", "restaurant_id", "zone_id", "restaurant_type",
    "pickup_lat", "pickup_lng", "dropoff_lat", "dropoff_lng", "haversine_distance_km",
    "hour_of_day", "day_of_week", "is_weekend", "is_lunch_rush", "is_dinner_rush",
    "traffic_multiplier", "weather_condition", "weather_multiplier", "prep_time_minutes",
    "rider_id", "rider_avg_speed_kmh", "rider_reliability", "rider_completed_deliveries",
    "actual_eta_minutes",
]

ORDER_SCHEMA = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("event_id", T.LongType()),
        T.StructField("order_timestamp", T.TimestampNTZType()),
        T.StructField("restaurant_id", T.StringType()),
        T.StructField("zone_id", T.IntegerType()),
        T.StructField("restaurant_type", T.StringType()),
        T.StructField("pickup_lat", T.DoubleType()),
        T.StructField("pickup_lng", T.DoubleType()),
        T.StructField("dropoff_lat", T.DoubleType()),
        T.StructField("dropoff_lng", T.DoubleType()),
        T.StructField("rider_avg_speed_kmh", T.DoubleType()),
        T.StructField("rider_reliability", T.DoubleType()),
        T.StructField("traffic_multiplier", T.DoubleType()),
        T.StructField("weather_condition", T.StringType()),
        T.StructField("weather_multiplier", T.DoubleType()),
        T.StructField("prep_time_minutes", T.DoubleType()),
        T.StructField("actual_eta_minutes", T.DoubleType()),
    ]
)


def date_range_filter(df: DataFrame, start=None, end=None, col: str = TIME_COL) -> DataFrame:
    """Inclusive on both ends; either bound may be omitted."""
    c = F.col(col)
    if start is not None:
        df = df.filter(c >= F.lit(start).cast(df.schema[col].dataType))
    if end is not None:
        df = df.filter(c <= F.lit(end).cast(df.schema[col].dataType))
    return df


def sort_by_time(df: DataFrame, time_col: str = TIME_COL, id_col: str = ID_COL) -> DataFrame:
    keys = [time_col] + ([id_col] if id_col in df.columns else [])
    return df.orderBy(*keys)


def _reader(spark: SparkSession, fmt: str, schema: T.StructType | None, options: dict | None):
    r = spark.read.format(fmt)
    if schema is not None and fmt != "jdbc":
        r = r.schema(schema)
    if fmt == "csv":
        r = r.option("header", True).option("timestampNTZFormat", CSV_TS_FORMAT).option("timestampFormat", CSV_TS_FORMAT)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r


def load_orders(
    spark: SparkSession,
    path: str | None = None,
    fmt: str = "parquet",
    start_date=None,
    end_date=None,
    limit: int | None = 0,
    schema: T.StructType | None = None,
    options: dict | None = None,
    columns: list[str] | None = None,
) -> DataFrame:
    """Orders with the standard projection, inclusive date filter and time order.

    ``limit`` 0/None means all rows (a falsy limit is no limit). For JDBC pass
    ``options`` with url/dbtable and partitionColumn/lowerBound/upperBound/
    numPartitions so the read is split across executors; Catalyst pushes the
    date filter into the database query.
    """
    r = _reader(spark, fmt, schema, options)
    df = r.load(path) if path is not None else r.load()
    wanted = columns or ORDER_COLUMNS
    df = df.select(*[c for c in wanted if c in df.columns] + [c for c in df.columns if c not in wanted and c == "event_id"])
    df = date_range_filter(df, start_date, end_date)
    df = sort_by_time(df)
    if limit:
        df = df.limit(int(limit))
    return df


def load_csv_orders(spark: SparkSession, path: str, schema: T.StructType = ORDER_SCHEMA, nrows: int | None = None) -> DataFrame:
    """Header CSV with a declared schema (no inference); first ``nrows`` in time order."""
    df = _reader(spark, "csv", schema, None).load(path)
    if nrows:
        df = sort_by_time(df).limit(int(nrows))
    return df


def load_dimension(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None,
                   options: dict | None = None) -> DataFrame:
    """Full-table read of a dimension (restaurants, riders)."""
    r = _reader(spark, fmt, schema, options)
    return r.load(path) if path is not None else r.load()


JDBC_PARTITION_OPTIONS = ("partitionColumn", "lowerBound", "upperBound", "numPartitions")


def _unreachable(error) -> bool:
    """Whether a JVM error, or one that caused it, is an SQL connection error (SQLSTATE class 08) or a network error."""
    while error is not None:
        try:
            state = error.getSQLState()
        except Py4JError:  # no SQLException
            state = None
        if (state or "").startswith("08") or error.getClass().getName().startswith("java.net."):
            return True
        error = error.getCause()
    return False


def load_training_data(
    spark: SparkSession,
    db_options: dict | None = None,
    file_path: str | None = None,
    file_format: str = "parquet",
    start_date=None,
    end_date=None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Database first, then files; same inclusive date filter; error if neither works.

    JDBC is lazy, so ``load()`` (schema fetch) runs inside the ``try`` to make
    connection errors surface here rather than at the first action. Only a
    database that cannot be reached falls back to the files: refused
    credentials, a missing table or wrong SQL are raised. ``db_options`` must
    hold all partition options, or none for a read by one task.
    """
    if db_options:
        given = [o for o in JDBC_PARTITION_OPTIONS if o in db_options]
        if given and len(given) < len(JDBC_PARTITION_OPTIONS):
            raise ValueError(f"partitioned read needs all of {', '.join(JDBC_PARTITION_OPTIONS)}")
        if not given:
            log.warning("database read without %s: one task reads the whole table", JDBC_PARTITION_OPTIONS[0])
        try:
            df = spark.read.format("jdbc").options(**db_options).load()
            df.schema  # noqa: B018 - force resolution
            log.info("training data from database")
            return sort_by_time(date_range_filter(df, start_date, end_date))
        except Py4JJavaError as exc:
            if not _unreachable(exc.java_exception):
                raise
            log.warning("database cannot be reached; falling back to files")
    if file_path:
        df = _reader(spark, file_format, schema, None).load(file_path)
        return sort_by_time(date_range_filter(df, start_date, end_date))
    raise ValueError("no data source available: database failed and no file path given")


def validate_schema(df: DataFrame, required: list[str]) -> tuple[bool, list[str]]:
    missing = [c for c in required if c not in df.columns]
    return len(missing) == 0, missing


def load_validated(df: DataFrame, target: str = TARGET, min_rows: int = 1000) -> DataFrame:
    """Require the target column and more than ``min_rows`` rows (reads at most min_rows+1)."""
    if target not in df.columns:
        raise ValueError(f"target column {target} missing")
    if df.limit(min_rows + 1).count() <= min_rows:
        raise ValueError(f"insufficient data: need more than {min_rows} rows")
    return df

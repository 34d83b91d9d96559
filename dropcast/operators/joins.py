"""Join helpers: broadcast only behind a row-count check, shuffle join otherwise."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A side is broadcast only if its measured row count is at most this many rows
# and rows x estimated row width stays within the byte budget (checked, not assumed).
DEFAULT_BROADCAST_MAX_ROWS = 2_000_000
DEFAULT_BROADCAST_MAX_BYTES = 256 * 1024 * 1024

_WIDTH = {T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.DateType: 4, T.FloatType: 4,
          T.LongType: 8, T.DoubleType: 8, T.TimestampType: 8, T.TimestampNTZType: 8, T.DecimalType: 16}


def estimated_row_bytes(schema: T.StructType) -> int:
    """Conservative per-row width from the schema (strings and nested types counted at 64 bytes)."""
    return 16 + sum(_WIDTH.get(type(f.dataType), 64) for f in schema.fields)


def broadcast_ok(n_rows: int, schema: T.StructType, max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
                 max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES) -> bool:
    return n_rows <= max_rows and n_rows * estimated_row_bytes(schema) <= max_bytes


def measured_size(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes) of ``df`` from one aggregation; strings and nested values count with their own lengths."""
    long = [f.name for f in df.schema.fields if type(f.dataType) not in _WIDTH]
    sizes = [F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) for c in long]
    each = reduce(lambda a, b: a + b, sizes, F.lit(0)).cast("long")
    row = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(each), F.lit(0)).alias("b")).first()
    fixed = 16 + sum(_WIDTH.get(type(f.dataType), 16) for f in df.schema.fields)
    return int(row["n"]), int(row["n"]) * fixed + int(row["b"])


def checked_broadcast(small: DataFrame, max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
                      known_rows: int | None = None, max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES) -> DataFrame:
    """``broadcast(small)`` if its size is proven within the bounds; else ``small`` unchanged.

    The size is measured: rows, and the bytes that their strings really have. ``known_rows`` lets a caller pass
    a count measured earlier (e.g. at fit time) and avoid another job; the width is then estimated from the schema. Beyond the bound Spark plans a shuffle join (AQE may
    still turn it into a broadcast at runtime from measured sizes, and splits
    skewed partitions of the large side).
    """
    if known_rows is not None:
        return F.broadcast(small) if broadcast_ok(known_rows, small.schema, max_rows, max_bytes) else small
    n, size = measured_size(small)
    return F.broadcast(small) if n <= max_rows and size <= max_bytes else small


def null_safe_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def left_lookup(df: DataFrame, stats: DataFrame, keys: list[str], known_rows: int | None = None,
                max_rows: int = DEFAULT_BROADCAST_MAX_ROWS) -> DataFrame:
    """LEFT equi-join of a per-key table (one row per key) onto ``df``.

    NULL keys never match (pandas/SQL semantics), so no null-safe join here.
    """
    side = checked_broadcast(stats, max_rows, known_rows)
    return df.join(side, keys, "left")

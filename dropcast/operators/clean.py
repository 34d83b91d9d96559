"""Cleaning and data-quality operators.

Order of the composite (``clean_orders``): dedupe -> coerce -> impute ->
ranges -> target outliers. Statistics passes are aggregations (partial
aggregation map-side); medians and quartiles use the skew-safe ranking path.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import (
    BOOL_COLUMNS,
    CATEGORICAL_COLUMNS,
    CRITICAL_RANGE_COLUMNS,
    FLOAT_COLUMNS,
    INT_COLUMNS,
    TARGET,
    TARGET_VALID_MIN_IN_RANGE_PCT,
    TIME_COL,
    VALID_RANGES,
)
from ..functions.geo import clip
from .rank import column_percentiles, exact_percentiles, grouped_percentiles

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
INTEGRAL_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def numeric_columns(df: DataFrame, exclude: tuple = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in exclude]


def string_columns(df: DataFrame, exclude: tuple = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in exclude]


# ---- dedupe ----------------------------------------------------------------

def dedupe_first(df: DataFrame, key: str = "order_id", order_cols: list[str] | None = None,
                 copies_col: str | None = None) -> DataFrame:
    """Keep the first row per key in (order_cols) order; NULL keys count as one key.

    Expressed as ``min_by(row, order)`` per key: partial aggregation collapses a
    hot key map-side, so no task ever holds all copies of one key.
    ``copies_col`` (optional) receives the number of input rows per key.
    """
    if key not in df.columns:
        return df
    order_cols = order_cols or [c for c in (TIME_COL, "event_id") if c in df.columns]
    payload = F.struct(*[F.col(c) for c in df.columns])
    order = F.struct(*[F.col(c) for c in order_cols]) if order_cols else F.lit(0)
    aggs = [F.min_by(payload, order).alias("_row")]
    if copies_col:
        aggs.append(F.count(F.lit(1)).alias(copies_col))
    first = df.groupBy(F.col(key).alias("_k")).agg(*aggs)
    return first.select("_row.*", *([copies_col] if copies_col else []))


# ---- coerce ----------------------------------------------------------------

def coerce_types(df: DataFrame) -> DataFrame:
    """Timestamp/bool/int/float coercion of the named columns that exist; bad text -> NULL, NaN -> NULL."""
    exprs = {}
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    if TIME_COL in types and not isinstance(types[TIME_COL], (T.TimestampType, T.TimestampNTZType)):
        exprs[TIME_COL] = F.try_to_timestamp(F.col(TIME_COL).cast("string")).cast("timestamp_ntz")
    for c in BOOL_COLUMNS:
        if c in types and not isinstance(types[c], T.BooleanType):
            exprs[c] = F.expr(f"try_cast(`{c}` AS BOOLEAN)")
    for c in INT_COLUMNS:
        if c in types and not isinstance(types[c], T.IntegerType):
            exprs[c] = F.expr(f"try_cast(try_cast(`{c}` AS DOUBLE) AS INT)")
    for c in FLOAT_COLUMNS:
        if c in types:
            base = F.col(c) if isinstance(types[c], T.DoubleType) else F.expr(f"try_cast(`{c}` AS DOUBLE)")
            exprs[c] = F.nanvl(base, F.lit(None).cast("double"))
    return df.withColumns(exprs) if exprs else df


# ---- impute ----------------------------------------------------------------

def null_counts(df: DataFrame, cols: list[str] | None = None) -> dict[str, int]:
    cols = cols or df.columns
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols]).first()
    return {c: int(row[c]) for c in cols}


def string_modes(df: DataFrame, cols: list[str]) -> dict[str, str | None]:
    """Most frequent non-NULL value per column, ties -> smallest; None if all NULL."""
    if not cols:
        return {}
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in cols])).alias("kv"))
    counts = long.select("kv.*").filter(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("column").agg(F.min_by("value", F.struct((-F.col("n")).alias("neg_n"), F.col("value"))).alias("mode"))
    found = {r["column"]: r["mode"] for r in best.collect()}  # one row per column
    return {c: found.get(c) for c in cols}


def fill_values(df: DataFrame, cols: list[str], strategy: str = "median") -> dict[str, float]:
    """Fill value per numeric column: exact median, mean or mode (smallest on ties)."""
    if not cols:
        return {}
    if strategy == "mean":
        row = df.agg(*[F.avg(c).alias(c) for c in cols]).first()
        return {c: row[c] for c in cols}
    if strategy == "median":
        res = column_percentiles(df, cols, [0.5], names=["median"]).collect()  # one row per column
        got = {r["column"]: r["median"] for r in res}
        return {c: got.get(c) for c in cols}
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in cols])).alias("kv"))
    counts = long.select("kv.*").filter(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("column").agg(F.min_by("value", F.struct((-F.col("n")).alias("neg_n"), F.col("value"))).alias("mode"))
    got = {r["column"]: r["mode"] for r in best.collect()}
    return {c: got.get(c, 0.0) for c in cols}


@dataclass
class ImputeResult:
    df: DataFrame
    fills: dict = field(default_factory=dict)
    cells_filled: int = 0


def impute_missing(df: DataFrame, strategy: str = "median", exclude: tuple = ()) -> ImputeResult:
    """Strings (categorical set): mode, all-NULL -> 'unknown'; numerics: median/mean/mode;
    booleans: false. Integer columns get a rounded fill (no fractional ints)."""
    nulls = null_counts(df)
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    cat = [c for c in CATEGORICAL_COLUMNS if c in types and nulls.get(c, 0) > 0]
    num = [c for c in numeric_columns(df, exclude) if nulls.get(c, 0) > 0]
    boo = [f.name for f in df.schema.fields if isinstance(f.dataType, T.BooleanType) and nulls.get(f.name, 0) > 0]
    fills: dict = {}
    modes = string_modes(df, cat)
    for c in cat:
        fills[c] = modes[c] if modes[c] is not None else "unknown"
    nv = fill_values(df, num, strategy)
    for c in num:
        v = nv.get(c)
        if v is None:
            continue
        fills[c] = int(round(v)) if isinstance(types[c], INTEGRAL_TYPES) else float(v)
    for c in boo:
        fills[c] = False
    exprs = {c: F.coalesce(F.col(c), F.lit(v).cast(types[c])) for c, v in fills.items()}
    out = df.withColumns(exprs) if exprs else df
    filled = sum(nulls[c] for c in fills)
    return ImputeResult(out, fills, filled)


# ---- ranges ----------------------------------------------------------------

def range_filter_or_clip(df: DataFrame, ranges: dict = VALID_RANGES, critical: list[str] = CRITICAL_RANGE_COLUMNS) -> DataFrame:
    """Drop rows with out-of-range critical columns, clip the others. NULL is never out of range."""
    cond = F.lit(True)
    clips = {}
    for c, (lo, hi) in ranges.items():
        if c not in df.columns:
            continue
        if c in critical:
            bad = (F.col(c) < lo) | (F.col(c) > hi)
            cond = cond & ~F.coalesce(bad, F.lit(False))
        else:
            clips[c] = clip(c, lo, hi).cast(df.schema[c].dataType)
    out = df.filter(cond)
    return out.withColumns(clips) if clips else out


# ---- outliers --------------------------------------------------------------

def outlier_bounds(df: DataFrame, col: str, method: str = "iqr", k: float = 1.5) -> tuple[float | None, float | None]:
    """(lower, upper) by IQR (linear quantiles), z-score (sample std) or fixed/observed bounds."""
    if method == "iqr":
        q = exact_percentiles(df, col, [0.25, 0.75], names=["q1", "q3"]).first()
        if q is None or q["q1"] is None:
            return None, None
        iqr = q["q3"] - q["q1"]
        return q["q1"] - k * iqr, q["q3"] + k * iqr
    if method == "zscore":
        r = df.agg(F.avg(col).alias("m"), F.stddev_samp(col).alias("s")).first()
        if r["m"] is None or r["s"] is None:
            return None, None
        return r["m"] - k * r["s"], r["m"] + k * r["s"]
    if col in VALID_RANGES:
        return VALID_RANGES[col]
    r = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).first()
    return r["lo"], r["hi"]


def bounds_clip(df: DataFrame, col: str = TARGET, method: str = "iqr", k: float = 1.5) -> tuple[DataFrame, tuple, Column]:
    """Clip ``col`` to the method's bounds; returns (frame, bounds, outlier-flag expression)."""
    lo, hi = outlier_bounds(df, col, method, k)
    if lo is None:
        return df, (None, None), F.lit(False)
    flag = (F.col(col) < lo) | (F.col(col) > hi)
    return df.withColumn(col, clip(col, lo, hi)), (lo, hi), flag


# ---- composite ---------------------------------------------------------------

@dataclass
class CleanResult:
    df: DataFrame
    report: dict


def clean_orders(df: DataFrame, outlier_method: str = "iqr", outlier_threshold: float = 1.5,
                 fill_strategy: str = "median", target: str = TARGET) -> CleanResult:
    """dedupe -> coerce -> impute -> ranges -> target outliers, with a cleaning report.

    The deduped/coerced frame and the range-checked frame are checkpointed to
    the shared folder: each feeds several statistics passes, and fixing them
    keeps the passes consistent and the lineage short. Row counts for the
    report are observed (``DataFrame.observe``) during those checkpoint jobs,
    so counting costs no extra pass.
    """
    # Counts are observed in the final stage of each checkpoint job (the input row
    # count is the sum of per-key copies), so a re-executed map stage cannot
    # count twice.
    obs_dd, obs_rg = Observation("rows_dedup"), Observation("rows_ranged")
    copies = "_dc_copies"
    deduped = coerce_types(dedupe_first(df, copies_col=copies)).observe(
        obs_dd, F.count(F.lit(1)).alias("n"), F.sum(copies).alias("rows_in")).checkpoint(eager=True).drop(copies)
    original_rows, deduped_rows = int(obs_dd.get["rows_in"] or 0), int(obs_dd.get["n"])
    report = {"original_rows": original_rows, "original_columns": len(df.columns),
              "duplicates_removed": original_rows - deduped_rows}
    imp = impute_missing(deduped, fill_strategy)
    report["missing_values_filled"] = imp.cells_filled
    ranged = range_filter_or_clip(imp.df).observe(obs_rg, F.count(F.lit(1)).alias("n")).checkpoint(eager=True)
    ranged_rows = int(obs_rg.get["n"])
    report["invalid_range_rows_removed"] = deduped_rows - ranged_rows
    out = ranged
    if target in ranged.columns:
        out, (lo, hi), flag = bounds_clip(ranged, target, outlier_method, outlier_threshold)
        report[f"{target}_outliers_clipped"] = int(ranged.filter(flag).count()) if lo is not None else 0
        report["outlier_bounds"] = [lo, hi]
    report["final_rows"] = ranged_rows
    report["rows_removed"] = original_rows - ranged_rows
    report["removal_pct"] = (original_rows - ranged_rows) / original_rows * 100 if original_rows else None
    report["fill_values"] = imp.fills
    return CleanResult(out, report)


def cleaning_report_frame(spark, report: dict) -> DataFrame:
    """The cleaning report as a one-row frame (scalars only)."""
    keys = ["original_rows", "original_columns", "duplicates_removed", "missing_values_filled",
            "invalid_range_rows_removed", f"{TARGET}_outliers_clipped", "final_rows", "rows_removed"]
    row = [int(report.get(k) or 0) for k in keys]
    schema = T.StructType([T.StructField(k if k != f"{TARGET}_outliers_clipped" else "outliers_clipped", T.LongType()) for k in keys]
                          + [T.StructField("removal_pct", T.DoubleType())])
    return spark.createDataFrame([row + [report.get("removal_pct")]], schema)


# ---- validation and profiles ----------------------------------------------

def validate_target(df: DataFrame, target: str = TARGET, lo: float = 1.0, hi: float = 180.0) -> DataFrame:
    """One row of target statistics and the validity flag (in-range % over all rows, NULLs included)."""
    t = F.col(target)
    stats = df.agg(
        F.count(F.lit(1)).alias("count"),
        F.avg(t).alias("mean"),
        F.stddev_samp(t).alias("std"),
        F.min(t).alias("min"),
        F.max(t).alias("max"),
        F.count_if(t.isNull()).alias("null_count"),
        (F.try_divide(F.count_if(t.between(lo, hi)), F.count(F.lit(1))) * 100.0).alias("in_range_pct"),
    )
    return stats.withColumn(
        "is_valid",
        (F.col("null_count") == 0) & (F.col("in_range_pct") >= TARGET_VALID_MIN_IN_RANGE_PCT) & (F.coalesce(F.col("std"), F.lit(0.0)) > 0),
    )


def data_quality_profile(df: DataFrame) -> DataFrame:
    """Long form, one row per column: type, null count/%, and mean/std/min/max/skew for numerics.

    One wide aggregation; skew is bias-adjusted: g1 * sqrt(n(n-1))/(n-2).
    """
    num = set(numeric_columns(df))
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for c in df.columns:
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"{c}__nulls"))
        if c in num:
            x = F.col(c).cast("double")
            aggs += [F.avg(x).alias(f"{c}__mean"), F.stddev_samp(x).alias(f"{c}__std"),
                     F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max"),
                     F.skewness(x).alias(f"{c}__g1"), F.count(x).alias(f"{c}__n")]
    row = df.agg(*aggs)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    entries = []
    for c in df.columns:
        if c in num:
            n = F.col(f"{c}__n").cast("double")
            skew = F.when(n > 2, F.col(f"{c}__g1") * F.sqrt(n * (n - 1)) / (n - 2))
            vals = [F.col(f"{c}__mean"), F.col(f"{c}__std"), F.col(f"{c}__min").cast("double"),
                    F.col(f"{c}__max").cast("double"), skew]
        else:
            vals = [F.lit(None).cast("double")] * 5
        entries.append(F.struct(
            F.lit(c).alias("column"), F.lit(types[c]).alias("dtype"),
            F.col(f"{c}__nulls").cast("long").alias("null_count"),
            (F.col(f"{c}__nulls") / F.col("_rows") * 100.0).alias("null_pct"),
            vals[0].alias("mean"), vals[1].alias("std"), vals[2].alias("min"), vals[3].alias("max"), vals[4].alias("skew"),
        ))
    return row.select(F.col("_rows").cast("long").alias("total_rows"), F.lit(len(df.columns)).alias("total_columns"),
                      F.explode(F.array(*entries)).alias("p")).select("total_rows", "total_columns", "p.*")


def describe_summary(df: DataFrame, cols: list[str]) -> DataFrame:
    """count, mean, std, min, exact quartiles, max per column (long form)."""
    base = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in cols])).alias("kv")).select("kv.*")
    extra = {"count": F.count("value"), "mean": F.avg("value"), "std": F.stddev_samp("value"),
             "min": F.min("value"), "max": F.max("value")}
    q = grouped_percentiles(base, "value", [0.25, 0.5, 0.75], ["column"], names=["p25", "p50", "p75"], extra_aggs=extra)
    return q.select("column", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def detect_feature_types(df: DataFrame, exclude: tuple = (TARGET, "predicted_eta_minutes")) -> tuple[list[str], list[str]]:
    """(numeric columns minus target/prediction, string columns) from the schema."""
    return numeric_columns(df, exclude), string_columns(df)

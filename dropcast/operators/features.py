"""Feature engineering as ``pyspark.ml`` Estimators / Models.

Fitted state (centroids, encodings, group statistics) lives in small
DataFrames: materialised once at fit time in the shared checkpoint folder,
counted, and joined back with a broadcast only when the count is within the
bound (otherwise a shuffle join). Models persist those tables as Parquet, so
``Pipeline``/``PipelineModel`` save and load work unchanged.
"""

from __future__ import annotations

import os

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel, Transformer  # noqa: F401
from pyspark.ml.feature import OneHotEncoder
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from .. import functions as X
from ..constants import LAG_FALLBACK, MODEL_FEATURES, TARGET, TE_MIN_SAMPLES, TE_SMOOTHING, TIME_COL, ID_COL
from .joins import broadcast_ok
from .rank import column_percentiles, exact_percentiles, grouped_percentiles, ranked


# ---- persistence for table-backed models ---------------------------------------

class _TableModelWriter(MLWriter):
    def __init__(self, instance):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        inst = self.instance
        DefaultParamsWriter.saveMetadata(inst, path, self.sparkSession,
                                         extraMetadata={"tables": sorted(inst._tables), "scalars": inst._scalars})
        for name, df in inst._tables.items():
            df.write.mode("overwrite").parquet(os.path.join(path, "tables", name))


class _TableModelReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        md = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        inst = self.cls()
        inst._resetUid(md["uid"])
        DefaultParamsReader.getAndSetParams(inst, md)
        inst._tables = {n: self.sparkSession.read.parquet(os.path.join(path, "tables", n)) for n in md["tables"]}
        inst._scalars = md["scalars"]
        return inst


class TableBackedModel(Model, MLReadable, MLWritable):
    """Model whose state is a set of small DataFrames plus JSON scalars."""

    def __init__(self):
        super().__init__()
        self._tables: dict[str, DataFrame] = {}
        self._scalars: dict = {}

    def write(self):
        return _TableModelWriter(self)

    @classmethod
    def read(cls):
        return _TableModelReader(cls)

    def _side(self, name: str) -> DataFrame:
        """The table for a join: broadcast if its fitted row count is within the bound."""
        df = self._tables[name]
        n = self._scalars.get(f"rows_{name}")
        if n is not None and broadcast_ok(n, df.schema):
            return F.broadcast(df)
        return df


def _materialize(df: DataFrame) -> tuple[DataFrame, int]:
    """Checkpoint a fitted table to the shared folder and count it (size bound for broadcasts).

    The count is observed while the checkpoint job runs (no second pass).
    """
    obs = Observation("fitted_rows")
    ck = df.observe(obs, F.count(F.lit(1)).alias("n")).checkpoint(eager=True)
    return ck, int(obs.get["n"])


def _p(name, doc, conv):
    return Param(Params._dummy(), name, doc, typeConverter=conv)


class _HasTarget(Params):
    targetCol = _p("targetCol", "target column", TypeConverters.toString)

    def getTargetCol(self):
        return self.getOrDefault(self.targetCol)


# ---- geo ----------------------------------------------------------------------

class GeoFeatures(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Fit: mean pickup lat/lng per zone (zone centroids). Transform: distance, bearing,
    bearing sin/cos, coordinate diffs and distance to the zone centroid (unknown zone -> 0.0)."""

    @keyword_only
    def __init__(self):
        super().__init__()

    def _fit(self, df: DataFrame) -> "GeoFeaturesModel":
        m = GeoFeaturesModel()
        if "zone_id" in df.columns:
            cent = (df.filter(F.col("zone_id").isNotNull()).groupBy("zone_id")
                    .agg(F.avg("pickup_lat").alias("centroid_lat"), F.avg("pickup_lng").alias("centroid_lng")))
            cent, n = _materialize(cent)
            m._tables["centroids"] = cent
            m._scalars["rows_centroids"] = n
        return m


class GeoFeaturesModel(TableBackedModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        geo = ("pickup_lat", "pickup_lng", "dropoff_lat", "dropoff_lng")
        bearing = X.bearing_deg(*geo)
        cols = {}
        if "haversine_distance_km" not in df.columns:
            cols["haversine_distance_km"] = X.geodesic_km(*geo)
        cols["bearing"] = bearing
        cols["bearing_sin"] = X.bearing_sin(bearing)
        cols["bearing_cos"] = X.bearing_cos(bearing)
        cols.update(X.coordinate_diffs(*geo))
        out = df.withColumns(cols)
        if "zone_id" in df.columns and self._scalars.get("rows_centroids"):
            out = out.join(self._side("centroids"), "zone_id", "left")
            # unknown zone -> NULL centroid -> 0.0 (geodesic_km maps missing points to 0.0)
            out = out.withColumn(
                "dist_to_zone_centroid", X.geodesic_km("pickup_lat", "pickup_lng", "centroid_lat", "centroid_lng"),
            ).drop("centroid_lat", "centroid_lng")
        return out


# ---- temporal -------------------------------------------------------------------

class TemporalFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Calendar parts (only those absent), cyclical encodings, rush and weekend flags."""

    addCyclical = _p("addCyclical", "add sin/cos encodings", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, addCyclical: bool = True):
        super().__init__()
        self._setDefault(addCyclical=True)
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        cols = {}
        present = set(df.columns)
        if TIME_COL in present:
            for name, c in X.temporal_parts(TIME_COL).items():
                if name not in present:
                    cols[name] = c
        out = df.withColumns(cols) if cols else df
        present = set(out.columns)
        cols = {}
        if self.getOrDefault(self.addCyclical):
            cyc = X.cyclical_features(
                hour="hour_of_day" if "hour_of_day" in present else None,
                dow="day_of_week" if "day_of_week" in present else None,
                month="month" if "month" in present else None,
            )
            cols.update(cyc)
        if "hour_of_day" in present:
            cols.update({k: v for k, v in X.rush_flags("hour_of_day").items() if k not in present})
        if "day_of_week" in present and "is_weekend" not in present:
            cols["is_weekend"] = X.weekend_flag("day_of_week")
        return out.withColumns(cols) if cols else out


# ---- target encoding --------------------------------------------------------------

class TargetEncoder(Estimator, _HasTarget, DefaultParamsReadable, DefaultParamsWritable):
    """Smoothed mean target per category: (n*mean + m*global)/(n+m), kept only if n >= minSamples.

    Unseen, rare or NULL categories get the global mean.
    """

    columns = _p("columns", "columns to encode", TypeConverters.toListString)
    smoothing = _p("smoothing", "smoothing weight m", TypeConverters.toFloat)
    minSamples = _p("minSamples", "minimum rows per category", TypeConverters.toInt)

    @keyword_only
    def __init__(self, columns=None, smoothing: float = TE_SMOOTHING, minSamples: int = TE_MIN_SAMPLES,
                 targetCol: str = TARGET):
        super().__init__()
        self._setDefault(columns=[], smoothing=TE_SMOOTHING, minSamples=TE_MIN_SAMPLES, targetCol=TARGET)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "TargetEncoderModel":
        y = self.getTargetCol()
        m = float(self.getOrDefault(self.smoothing))
        k = int(self.getOrDefault(self.minSamples))
        cols = [c for c in self.getOrDefault(self.columns) if c in df.columns]
        model = TargetEncoderModel(columns=self.getOrDefault(self.columns))
        if not cols:
            model._scalars["global_mean"] = df.agg(F.avg(y)).first()[0]
            return model
        # One pass over the training rows: per-category (mean, n) for every column
        # plus the grand total, as grouping sets; materialised once, then split.
        stats, _ = _materialize(df.groupingSets([[c] for c in cols] + [[]], *cols).agg(
            F.avg(y).alias("_mean"), F.count(y).alias("_n"), F.grouping_id().alias("_gid")))
        width = len(cols)
        full = (1 << width) - 1
        gm = stats.filter(F.col("_gid") == full).select("_mean").first()[0]
        model._scalars["global_mean"] = gm
        for i, c in enumerate(cols):
            gid = full - (1 << (width - 1 - i))  # only column i grouped
            enc = (stats.filter((F.col("_gid") == gid) & F.col(c).isNotNull() & (F.col("_n") >= k))
                   .select(c, ((F.col("_n") * F.col("_mean") + m * F.lit(gm)) / (F.col("_n") + m)).alias(f"{c}_encoded")))
            enc, n = _materialize(enc)
            model._tables[c] = enc
            model._scalars[f"rows_{c}"] = n
        return model


class TargetEncoderModel(TableBackedModel):
    columns = _p("columns", "encoded columns", TypeConverters.toListString)

    @keyword_only
    def __init__(self, columns=None):
        super().__init__()
        self._setDefault(columns=[])
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        gm = self._scalars.get("global_mean")
        out = df
        for c in self.getOrDefault(self.columns):
            if c not in out.columns or c not in self._tables:
                continue
            name = f"{c}_encoded"
            if name in out.columns:
                out = out.withColumnRenamed(name, f"_pre_{name}")
            out = out.join(self._side(c), c, "left").withColumn(name, F.coalesce(F.col(name), F.lit(gm)))
            if f"_pre_{name}" in out.columns:
                out = out.drop(f"_pre_{name}")
        return out


# ---- group statistics ----------------------------------------------------------------

class GroupStats(Estimator, _HasTarget, DefaultParamsReadable, DefaultParamsWritable):
    """Per key: mean, exact median, sample std and count of the target.

    Transform: LEFT join; NULL mean/median <- unweighted mean over groups,
    NULL std <- median of group stds, NULL count <- 0.
    """

    keys = _p("keys", "group keys", TypeConverters.toListString)

    @keyword_only
    def __init__(self, keys=None, targetCol: str = TARGET):
        super().__init__()
        self._setDefault(keys=["zone_id", "restaurant_id"], targetCol=TARGET)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "GroupStatsModel":
        y = self.getTargetCol()
        model = GroupStatsModel(keys=self.getOrDefault(self.keys))
        keys = [k for k in self.getOrDefault(self.keys) if k in df.columns]
        if not keys:
            return model
        # All keys in one skew-safe ranking: rows are stacked as (key name, key value,
        # target); moments and the exact median per (key, value) come from one
        # aggregation over the ranked rows, then the table is split per key.
        stacked = df.select(F.explode(F.array(*[
            F.struct(F.lit(k).alias("_key"), F.col(k).cast("string").alias("_kv")) for k in keys])).alias("_e"),
            F.col(y).alias("_y")).select("_e._key", "_e._kv", "_y").filter(F.col("_kv").isNotNull())
        extra = {"_mean": F.avg("_y"), "_std": F.stddev_samp("_y"), "_count": F.count("_y")}
        both, _ = _materialize(grouped_percentiles(stacked, "_y", [0.5], ["_key", "_kv"], names=["_median"],
                                                 extra_aggs=extra))
        for key in keys:
            stats = both.filter(F.col("_key") == key).select(
                F.col("_kv").cast(df.schema[key].dataType).alias(key),
                F.col("_mean").alias(f"{key}_eta_mean"), F.col("_median").alias(f"{key}_eta_median"),
                F.col("_std").alias(f"{key}_eta_std"), F.col("_count").alias(f"{key}_order_count"))
            stats, n = _materialize(stats)
            model._tables[key] = stats
            model._scalars[f"rows_{key}"] = n
            # fills come from the stats table itself (one row per key value, already
            # materialised): one small aggregation, exact median of group stds
            fill = exact_percentiles(stats, f"{key}_eta_std", [0.5], names=["s"],
                                     carry=[f"{key}_eta_mean", f"{key}_eta_median"],
                                     extra_aggs={"m": F.avg(f"{key}_eta_mean"), "md": F.avg(f"{key}_eta_median")}).first()
            model._scalars[f"fill_{key}"] = {"mean": fill["m"], "median": fill["md"], "std": fill["s"]}
        return model


class GroupStatsModel(TableBackedModel):
    keys = _p("keys", "group keys", TypeConverters.toListString)

    @keyword_only
    def __init__(self, keys=None):
        super().__init__()
        self._setDefault(keys=[])
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        out = df
        for key in self.getOrDefault(self.keys):
            if key not in out.columns or key not in self._tables:
                continue
            names = [f"{key}_eta_mean", f"{key}_eta_median", f"{key}_eta_std", f"{key}_order_count"]
            pre = [n for n in names if n in out.columns]
            out = out.withColumnsRenamed({n: f"_pre_{n}" for n in pre}) if pre else out
            out = out.join(self._side(key), key, "left")
            fill = self._scalars.get(f"fill_{key}", {})
            lit_for = {names[0]: fill.get("mean"), names[1]: fill.get("median"), names[2]: fill.get("std"), names[3]: 0}
            cols = {}
            for n in names:
                parts = [F.col(n)]
                if n in pre:
                    parts.append(F.col(f"_pre_{n}"))
                if lit_for[n] is not None:
                    parts.append(F.lit(lit_for[n]).cast(out.schema[n].dataType))
                cols[n] = F.coalesce(*parts)
            out = out.withColumns(cols).drop(*[f"_pre_{n}" for n in pre])
        return out


# ---- weather ----------------------------------------------------------------------------

class WeatherFeatures(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Ordinal code plus a one-hot encoding over the vocabulary seen at fit, its alphabetically first entry dropped.

    Up to ``maxColumns`` categories there is a 0/1 column for each of the others. A larger vocabulary is kept as a table
    (category, index) and gives one sparse vector column ``weather_one_hot`` with the same entries in the same order.
    The first category, an unseen one and NULL are all zeros.
    """

    maxColumns = _p("maxColumns", "largest vocabulary that gets a column per category", TypeConverters.toInt)

    @keyword_only
    def __init__(self, maxColumns: int = 1000):
        super().__init__()
        self._setDefault(maxColumns=1000)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "WeatherFeaturesModel":
        m = WeatherFeaturesModel()
        if "weather_condition" in df.columns:
            # the vocabulary is read only up to the bound; a larger one stays distributed
            k = int(self.getOrDefault(self.maxColumns))
            known = df.select("weather_condition").where(F.col("weather_condition").isNotNull()).distinct()
            vocab = [r[0] for r in known.limit(k + 1).collect()]
            if len(vocab) <= k:
                m._scalars["vocabulary"] = sorted(vocab)
            else:
                # the first category has index -1, the others 0, 1, ... in alphabetical order
                places = ranked(known, ["weather_condition"], rank_col="_place", size_col=None).select(
                    F.col("weather_condition").alias("_category"), (F.col("_place") - 2).cast("double").alias("_index"))
                m._tables["categories"], m._scalars["rows_categories"] = _materialize(places)
        return m


class WeatherFeaturesModel(TableBackedModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        if "weather_condition" not in df.columns:
            return df
        cols = {"weather_encoded": X.weather_ordinal("weather_condition")}
        cols.update(X.weather_one_hot(self._scalars.get("vocabulary", [])))
        if "weather_multiplier" not in df.columns:
            cols["weather_multiplier"] = X.weather_multiplier("weather_condition")
        out = df.withColumns(cols)
        return self._sparse(out) if "categories" in self._tables else out

    def _sparse(self, df: DataFrame) -> DataFrame:
        width = int(self._scalars["rows_categories"]) - 1
        # the place after the last one is the encoder's dropped category; the declared size saves it a scan
        nominal = {"ml_attr": {"type": "nominal", "name": "_index", "num_vals": width + 1}}
        index = F.coalesce(F.when(F.col("_index") >= 0, F.col("_index")), F.lit(float(width)))
        j = df.join(self._side("categories"), F.col("weather_condition") == F.col("_category"), "left")
        j = j.withColumn("_index", index).withMetadata("_index", nominal).drop("_category")
        encoder = OneHotEncoder(inputCol="_index", outputCol="weather_one_hot", dropLast=True)
        return encoder.fit(j).transform(j).drop("_index")


# ---- lags -----------------------------------------------------------------------------------

class LagFeatures(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Per group in time order: value 1/3/7 rows back and the mean of the previous 5 rows.

    Missing values (first rows of a group, NULL group key) get the fitted mean, else 30.
    """

    groupCols = _p("groupCols", "group columns", TypeConverters.toListString)
    lagCol = _p("lagCol", "lagged column", TypeConverters.toString)
    lags = _p("lags", "lag distances (rows)", TypeConverters.toListInt)
    window = _p("window", "rolling window (rows)", TypeConverters.toInt)
    bucketRows = _p("bucketRows", "rows per window partition for long groups", TypeConverters.toInt)

    @keyword_only
    def __init__(self, groupCols=None, lagCol: str = TARGET, lags=None, window: int = 5, bucketRows: int = 1 << 20):
        super().__init__()
        self._setDefault(groupCols=["zone_id"], lagCol=TARGET, lags=[1, 3, 7], window=5, bucketRows=1 << 20)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "LagFeaturesModel":
        m = LagFeaturesModel(groupCols=self.getOrDefault(self.groupCols), lagCol=self.getOrDefault(self.lagCol),
                             lags=self.getOrDefault(self.lags), window=self.getOrDefault(self.window),
                             bucketRows=self.getOrDefault(self.bucketRows))
        c = self.getOrDefault(self.lagCol)
        if c in df.columns:
            m._scalars["mean"] = df.agg(F.avg(c)).first()[0]
        return m


class LagFeaturesModel(TableBackedModel):
    groupCols = LagFeatures.groupCols
    lagCol = LagFeatures.lagCol
    lags = LagFeatures.lags
    window = LagFeatures.window
    bucketRows = LagFeatures.bucketRows

    @keyword_only
    def __init__(self, groupCols=None, lagCol: str = TARGET, lags=None, window: int = 5, bucketRows: int = 1 << 20):
        super().__init__()
        self._setDefault(groupCols=["zone_id"], lagCol=TARGET, lags=[1, 3, 7], window=5, bucketRows=1 << 20)
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        c = self.getOrDefault(self.lagCol)
        if c not in df.columns:
            return df
        fill = self._scalars.get("mean")
        fill = LAG_FALLBACK if fill is None else fill
        out = df
        for key in self.getOrDefault(self.groupCols):
            if key in out.columns:
                out = lag_window_features(out, key, c, self.getOrDefault(self.lags), self.getOrDefault(self.window),
                                          fill, self.getOrDefault(self.bucketRows))
        return out


def lag_window_features(df: DataFrame, key: str, col: str, lags: list[int], window: int, fill: float,
                        bucket_rows: int = 1 << 20, order_cols: tuple = (TIME_COL, ID_COL)) -> DataFrame:
    """Lags and prior-window mean per ``key``, bounded per task even for a hot key.

    When the largest key holds at most ``bucket_rows`` rows (checked with one
    map-side-combined count), a plain window per key is used. Otherwise rows get
    their rank inside the key (skew-safe ranking), are cut into
    buckets of ``bucket_rows`` consecutive rows, and each bucket also receives
    the last ``max(lags, window)`` rows of the previous bucket as context. The
    window then runs per (key, bucket), so no task holds more than
    bucket_rows + context rows, and the context rows are dropped afterwards.
    """
    order = [c for c in order_cols if c in df.columns]
    reach = max(max(lags), window)
    bucket_rows = max(bucket_rows, reach)  # the context comes from one earlier bucket
    valid = F.col(key).isNotNull()

    def lag_cols(w):
        cols = {f"{key}_{col}_lag_{k}": F.coalesce(F.when(valid, F.lag(col, k).over(w)), F.lit(fill)) for k in lags}
        cols[f"{key}_{col}_rolling_mean"] = F.coalesce(
            F.when(valid, F.avg(col).over(w.rowsBetween(-window, -1))), F.lit(fill))
        return cols

    # Proven bound first: if no key holds more than bucket_rows rows, a plain
    # window per key is bounded and needs no ranking or full-width checkpoint.
    largest = df.groupBy(key).agg(F.count(F.lit(1)).alias("_c")).agg(F.max("_c")).first()[0] or 0
    if largest <= bucket_rows:
        return df.withColumns(lag_cols(Window.partitionBy(key).orderBy(*order)))
    r = ranked(df, order, [key], rank_col="_lr", size_col=None)
    b = F.floor((F.col("_lr") - 1) / bucket_rows)
    r = r.withColumns({"_b": b, "_ctx": F.lit(False)})
    ctx = r.filter(F.pmod(F.col("_lr") - 1, F.lit(bucket_rows)) >= bucket_rows - reach).withColumns(
        {"_b": F.col("_b") + 1, "_ctx": F.lit(True)})
    u = r.unionByName(ctx)
    w = Window.partitionBy(key, "_b").orderBy("_lr")
    return u.withColumns(lag_cols(w)).filter(~F.col("_ctx")).drop("_lr", "_b", "_ctx")


# ---- median imputer --------------------------------------------------------------------------

class MedianImputer(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Fit exact medians of the given columns on training rows; fill NULLs with them."""

    inputCols = _p("inputCols", "columns", TypeConverters.toListString)

    @keyword_only
    def __init__(self, inputCols=None):
        super().__init__()
        self._setDefault(inputCols=[])
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "MedianImputerModel":
        cols = [c for c in self.getOrDefault(self.inputCols) if c in df.columns]
        m = MedianImputerModel(inputCols=cols)
        if cols:
            med = {r["column"]: r["median"] for r in column_percentiles(df, cols, [0.5], ["median"]).collect()}
            m._scalars["medians"] = med
        return m


class MedianImputerModel(TableBackedModel):
    inputCols = MedianImputer.inputCols

    @keyword_only
    def __init__(self, inputCols=None):
        super().__init__()
        self._setDefault(inputCols=[])
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        med = self._scalars.get("medians", {})
        cols = {c: F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType))
                for c, v in med.items() if c in df.columns and v is not None}
        return df.withColumns(cols) if cols else df


# ---- pipeline ------------------------------------------------------------------------------------

def feature_pipeline(target_encode_cols=("zone_id", "restaurant_type"), agg_cols=("zone_id",),
                     add_lag_features: bool = False, target: str = TARGET) -> Pipeline:
    """geo -> temporal -> target encoding -> group stats -> weather (-> lags)."""
    stages = [
        GeoFeatures(),
        TemporalFeatures(),
        TargetEncoder(columns=list(target_encode_cols), targetCol=target),
        GroupStats(keys=list(agg_cols), targetCol=target),
        WeatherFeatures(),
    ]
    if add_lag_features:
        stages.append(LagFeatures(groupCols=["zone_id"], lagCol=target))
    return Pipeline(stages=stages)


def fit_feature_pipeline(df: DataFrame, target_encode_cols=("zone_id", "restaurant_type"), agg_cols=("zone_id",),
                         add_lag_features: bool = False, target: str = TARGET, parallelism: int = 4) -> PipelineModel:
    """Fit the feature pipeline with its independent estimators fitted concurrently.

    Each estimator reads only raw columns and the target (none consumes another
    stage's output), so fitting them on the same training frame gives the same
    models as the sequential ``Pipeline.fit``. Their Spark jobs are submitted
    from a small thread pool and share the cluster; the result is an ordinary
    ``PipelineModel`` in the usual stage order.
    """
    from concurrent.futures import ThreadPoolExecutor

    stages = feature_pipeline(target_encode_cols, agg_cols, add_lag_features, target).getStages()
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        fitted = list(pool.map(lambda st: st.fit(df) if isinstance(st, Estimator) else st, stages))
    return PipelineModel(stages=fitted)


def feature_names() -> list[str]:
    """Names of the engineered features (the wider set; the model uses ``MODEL_FEATURES``)."""
    from ..constants import FEATURE_NAMES

    return list(FEATURE_NAMES)


def select_model_features(df: DataFrame, features: list[str] = MODEL_FEATURES, keep: list[str] | tuple = ()) -> DataFrame:
    """Model features that exist, in list order (plus ``keep`` columns first)."""
    return df.select(*keep, *[f for f in features if f in df.columns])


def complete_features(df: DataFrame, features: list[str] = MODEL_FEATURES, keep: list[str] | tuple = ()) -> DataFrame:
    """Add absent features as 0, order them, NULL -> 0 (serving completion)."""
    missing = {f: F.lit(0.0) for f in features if f not in df.columns}
    out = df.withColumns(missing) if missing else df
    return out.select(*keep, *[F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f) for f in features])


def drop_target(df: DataFrame, target: str = TARGET) -> DataFrame:
    return df.drop(target)


def prepare_training(df: DataFrame, target: str = TARGET) -> tuple[DataFrame, PipelineModel]:
    """Fit the pipeline (encodings on zone/type, aggregates on zone and restaurant) and transform."""
    model = fit_feature_pipeline(df, ("zone_id", "restaurant_type"), ("zone_id", "restaurant_id"), False, target)
    return model.transform(df), model


def prepare_inference(df: DataFrame, model: PipelineModel) -> DataFrame:
    return model.transform(df)

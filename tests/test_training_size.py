"""Rows of a fit are dealt evenly, and feature vectors are made by code that the JVM compiles."""

import io
import math
import re
from contextlib import redirect_stdout

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from dropcast.plans import catalog as CAT
from dropcast.plans import training as TR
from conftest import SF001


def test_uneven_partitions_are_dealt(spark):
    """Every other partition with twice the rows of its neighbour: before, they were left as they were."""
    cores = spark.sparkContext.defaultParallelism
    parts = max(4, cores)
    rows = spark.sparkContext.parallelize(range(parts), parts).flatMap(lambda p: [(p * 10_000 + i,) for i in range(2000 if p % 2 else 1000)])
    df = rows.toDF("a long").withColumn("y", F.col("a") % 7 + 0.5)
    data = TR.spread(TR.with_vector(df, ["a"]).select("features", "y"), "y", 100)
    sizes = [r["count"] for r in data.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == df.count() == data.select("features").distinct().count()
    assert max(sizes) * math.ceil(len(sizes) / cores) * cores <= TR.SPREAD_SHARE * sum(sizes)
    data.unpersist()


def test_even_or_small_partitions_stay(spark):
    df = spark.range(0, 4000, 1, spark.sparkContext.defaultParallelism).select(F.col("id").alias("a"), F.lit(1.0).alias("y"))
    for source, rows in ((df, 10), (df.coalesce(1), 5000)):
        data = TR.spread(TR.with_vector(source, ["a"]).select("features", "y"), "y", rows)
        assert data.rdd.getNumPartitions() == source.rdd.getNumPartitions()
        data.unpersist()


def test_vector_is_the_assemblers(spark):
    df = spark.createDataFrame([(1, 0, 2.5, True, None), (2, None, 0.0, False, float("nan")), (3, 7, None, None, -0.5)],
                               "id long, i int, d double, b boolean, f double")
    cols = ["i", "d", "b", "f"]
    va = VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="keep")

    def values(frame):
        return [(r["id"], [repr(float(x)) for x in r["features"].toArray()]) for r in frame.orderBy("id").collect()]

    assert values(TR.with_vector(df, cols)) == values(va.transform(df))
    assert values(TR.assembled(df, cols, "id")[1]) == values(va.transform(df))


def test_training_rows_are_made_by_compiled_code(spark):
    """No generated method above 8,000 bytes, which the JVM would interpret."""
    prep = TR.prepare_data(CAT._d(spark, SF001))
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = io.StringIO()
        with redirect_stdout(out):
            TR.assembled(prep.train, prep.features, TR.TARGET, "is_validation")[1].explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", out.getvalue())]
    assert sizes and max(sizes) <= 8000


def test_dealt_partitions_fill_whole_turns_of_the_cores(spark, monkeypatch):
    """Rows for one and a quarter turns: before, a quarter of the cores had twice the rows of the others in every job."""
    cores = spark.sparkContext.defaultParallelism
    monkeypatch.setattr(TR, "MAX_PARTITION_ROWS", 1000)
    n = 1250 * cores
    df = spark.range(0, n, 1, 1).select(F.col("id").alias("a"), (F.col("id") % 7 + 0.5).alias("y"))
    data = TR.spread(TR.with_vector(df, ["a"]).select("features", "y"), "y", 100)
    sizes = [r["count"] for r in data.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == n == data.select("features").distinct().count()
    assert data.rdd.getNumPartitions() == 2 * cores
    assert max(sizes) <= 1000 and max(sizes) * 2 * cores <= TR.SPREAD_SHARE * n
    data.unpersist()


def test_rows_are_dealt_for_scoring_by_many_trees(spark, monkeypatch):
    """One partition of rows: before, one core scored them all."""
    df = spark.range(0, 600, 1, 1).select("id", (F.col("id") % 31).cast("double").alias("a"), (F.col("id") % 7 + 0.5).alias("y")).persist()
    model = TR.train_alt_model(df, ["a"], TR.gbt_params(n_estimators=4, max_depth=2), "y")
    assert TR.predict(model, df).rdd.getNumPartitions() == 1
    monkeypatch.setattr(TR, "MANY_TREES", 4)
    dealt = TR.predict(model, df)
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert dealt.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism and max(sizes) <= math.ceil(600 / len(sizes)) + 1
    plain = model.transform(df).drop("features")
    assert dealt.columns == plain.columns and dealt.count() == 600
    assert dealt.exceptAll(plain).count() == 0 == plain.exceptAll(dealt).count()
    df.unpersist()


def test_forests_keep_node_ids_and_grow_the_same_trees(spark, monkeypatch):
    df = spark.range(0, 900, 1, 2).select((F.col("id") * 7919 % 101).cast("double").alias("a"), (F.col("id") * 31 % 17).cast("double").alias("b"),
                                          (F.col("id") * 7919 % 101 + F.col("id") % 3).cast("double").alias("y")).persist()
    p, made, seen = TR.gbt_params(n_estimators=6, max_depth=5, min_child_samples=3), TR.RandomForestRegressor, []

    def trees():
        return [t.toDebugString.split("\n", 1)[1] for f in TR.tree_stages(TR.train_alt_model(df, ["a", "b"], p, "y")) for t in f.trees]

    monkeypatch.setattr(TR, "RandomForestRegressor", lambda **kw: seen.append(kw.get("cacheNodeIds", False)) or made(**kw))
    kept = trees()
    monkeypatch.setattr(TR, "RandomForestRegressor", lambda **kw: made(**dict(kw, cacheNodeIds=False)))
    assert seen == [True] and kept == trees()
    df.unpersist()


def test_folds_are_fitted_on_rows_of_a_short_lineage(spark, monkeypatch):
    """Before, each job of a fold carried the steps that made the features; the rows, their places and the metrics stay."""
    df = spark.range(0, 400, 1, 2).select(
        (F.col("id") * 7919 % 101).cast("double").alias("a"), (F.col("id") * 7919 % 101 + F.col("id") % 3).cast("double").alias(TR.TARGET),
        F.timestamp_seconds("id").alias("order_timestamp"), F.col("id").alias("order_id"))
    for i in range(40):
        df = df.withColumn("a", F.when(F.col("a") > i, F.col("a")).otherwise(F.col("a") + 0.0))
    plain, cut = (TR.spread(TR.folded(df, ["a"], 2), rows=5000, cut=c) for c in (False, True))
    lineage = lambda d: d.rdd.toDebugString().decode()
    assert "ReliableCheckpointRDD" in lineage(cut) and "ReliableCheckpointRDD" not in lineage(plain)
    if spark.sparkContext.defaultParallelism > 2:
        assert not cut.storageLevel.useMemory  # every executor may read the rows
    place = lambda d: [tuple(r) for r in d.select("*", F.spark_partition_id(), F.monotonically_increasing_id()).collect()]
    assert place(plain) == place(cut)
    p = TR.gbt_params(n_estimators=3, max_depth=3, min_child_samples=5)
    seen, fit = [], TR.fit_folds
    monkeypatch.setattr(TR, "fit_folds", lambda parts, *a: seen.append(lineage(parts)) or fit(parts, *a))
    rows = TR.fold_metrics(df, ["a"], p, 2).collect()
    assert "ReliableCheckpointRDD" in seen[0]
    assert [tuple(r) for r in rows] == fit(plain, p, 2)
    for d in (plain, cut):
        d.unpersist()

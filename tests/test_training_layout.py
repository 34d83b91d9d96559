"""Fits whose rows come in few partitions, and forests grown in parts."""
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from dropcast.plans import training as TR

FEATURES = ["a", "b"]


def _rows(spark, n, parts):
    return spark.range(0, n, 1, parts).select(
        (F.col("id") * 7919 % 101).cast("double").alias("a"), (F.col("id") * 31 % 17).cast("double").alias("b"),
        (F.col("id") * 7919 % 101 + F.col("id") % 3).cast("double").alias("actual_eta_minutes"))


def test_large_partitions_are_dealt_and_small_ones_left(spark):
    cores = spark.sparkContext.defaultParallelism
    if cores < 3:
        pytest.skip("two cores have no idle one")
    data = TR.assembled(_rows(spark, 3000, 1), FEATURES, "actual_eta_minutes")[1]
    small = TR.spread(data, rows=5000)
    assert small.rdd.getNumPartitions() == 1
    dealt = TR.spread(data, rows=100)
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 1 and sum(sizes) == 3000
    assert dealt.exceptAll(small).count() == 0 and small.exceptAll(dealt).count() == 0
    other = TR.spread(TR.assembled(_rows(spark, 3000, 1).orderBy(F.desc("b")).coalesce(1), FEATURES, "actual_eta_minutes")[1], rows=100)
    place = lambda d: d.withColumn("p", F.spark_partition_id()).withColumn("k", F.monotonically_increasing_id())
    assert place(dealt).exceptAll(place(other)).count() == 0  # the layout read does not matter
    for d in (small, dealt, other):
        d.unpersist()
    empty = TR.spread(data.limit(0))
    assert empty.count() == 0


def test_node_ids_are_not_stored():
    assert TR._gbt(TR.gbt_params(), "actual_eta_minutes", 42).getCacheNodeIds() is False


def test_forest_in_parts_is_the_mean_of_its_trees(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(TR, "FOREST_TREES", 3)
    df = _rows(spark, 400, 2).persist()
    p = TR.gbt_params(n_estimators=7, max_depth=3, min_child_samples=5)
    model = TR.train_alt_model(df, FEATURES, p)
    forests = TR.tree_stages(model)
    assert [f.getNumTrees for f in forests] == [3, 3, 1]
    assert len({t.toDebugString for f in forests for t in f.trees}) > 3
    path = str(tmp_path / "forest")
    model.write().save(path)
    got = TR.predict(PipelineModel.load(path), df)
    assert got.columns == [*df.columns, TR.PRED_COL]
    for r in got.limit(5).collect():
        vector = TR.assembled(spark.createDataFrame([r]), FEATURES)[1].first()["features"]
        trees = [t.predict(vector) for f in forests for t in f.trees]
        assert r[TR.PRED_COL] == pytest.approx(sum(trees) / 7)
    imp = TR.feature_importance(model, FEATURES, spark).collect()
    assert sum(r["importance"] for r in imp) == pytest.approx(1.0)
    df.unpersist()


def _fits(monkeypatch):
    """Numbers of trees of the fits that are begun."""
    sizes, made = [], TR._gbt
    monkeypatch.setattr(TR, "_gbt", lambda p, *a: sizes.append(int(p["n_estimators"])) or made(p, *a))
    return sizes


def test_first_try_is_little_longer_than_the_rounds(spark, monkeypatch):
    p = TR.gbt_params(n_estimators=100, max_depth=2, min_child_samples=5, early_stopping_rounds=10)
    train = TR.assembled(_rows(spark, 300, 1), FEATURES, "actual_eta_minutes")[1].persist()
    worse = train.withColumn("actual_eta_minutes", F.lit(101.0) - F.col("actual_eta_minutes"))  # the better the fit, the worse
    sizes = _fits(monkeypatch)
    model, errors, n = TR._grown(train, worse, p, "actual_eta_minutes", 42)
    assert sizes == [11] and len(errors) == 11 and n == 1
    sizes.clear()
    assert TR._grown(train, train, dict(p, subsample=1.0, n_estimators=30), "actual_eta_minutes", 42)[0].getNumTrees == 30
    assert sizes == [11, 22, 30]  # as long as errors get smaller
    train.unpersist()


@pytest.mark.parametrize("best, tries", [(5, [55]), (12, [55, 62]), (40, [55, 110]), (200, [55, 110, 220, 400])])
def test_tries_follow_the_best_tree(monkeypatch, best, tries):
    sizes = []

    class Fit:
        def __init__(self, params, *_):
            sizes.append(params["n_estimators"])

        def fit(self, _):
            return self

        def evaluateEachIteration(self, *_):
            return [float(abs(k + 1 - best)) for k in range(sizes[-1])]

    monkeypatch.setattr(TR, "_gbt", Fit)
    assert TR._grown(None, None, TR.gbt_params(n_estimators=400), "y", 42)[2] == best
    assert sizes == tries


def test_stopped_folds_have_the_metrics_of_their_best_trees(spark, monkeypatch):
    p = TR.gbt_params(n_estimators=24, learning_rate=0.6, max_depth=4, min_child_samples=5, early_stopping_rounds=3)
    noisy = _rows(spark, 600, 2).withColumn("actual_eta_minutes", F.col("actual_eta_minutes") + 80 * F.rand(3))
    rows = noisy.withColumn("id", F.monotonically_increasing_id()).select("*", F.timestamp_seconds("id").alias("order_timestamp"), F.col("id").alias("order_id"))
    parts = TR.folded(rows, FEATURES, 2).persist()
    made, sizes = TR._gbt, _fits(monkeypatch)
    got = TR.fit_folds(parts, p, 2, early_stopping=True)
    fitted = sorted(sizes)
    sizes.clear()
    for i, mae, rmse, r2 in got:
        train, val = parts.filter(F.col("part") <= i), parts.filter(F.col("part") == i + 1)
        grown, _, n = TR._grown(train, val, p, "actual_eta_minutes", 42)
        assert n < grown.getNumTrees
        best = made(dict(p, n_estimators=n), "actual_eta_minutes", 42).fit(train)
        r = TR.M.regression_metrics(best.transform(val), "actual_eta_minutes", TR.PRED_COL, with_percentiles=False).first()
        assert (mae, rmse, r2) == pytest.approx((r["mae"], r["rmse"], r["r2"]))
    assert fitted == sorted(sizes)  # tries only, nothing fitted again
    parts.unpersist()


@pytest.mark.parametrize("stopping", [False, True])
def test_folds_keep_a_short_lineage(spark, monkeypatch, stopping):
    class Seen(Exception):
        pass

    def spy(*args):
        assert made(*args).getCheckpointInterval() == TR.FOLD_CHECKPOINT < 10
        raise Seen

    made = TR._gbt
    monkeypatch.setattr(TR, "_gbt", spy)
    parts = TR.assembled(_rows(spark, 30, 1), FEATURES, "actual_eta_minutes")[1].withColumn("part", F.lit(0))
    with pytest.raises(Seen):
        TR.fit_folds(parts, TR.gbt_params(), 1, early_stopping=stopping)
    assert made(TR.gbt_params(), "actual_eta_minutes", 42).getCheckpointInterval() == 10

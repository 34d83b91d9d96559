"""Skew-safe ranking, percentiles and running sums against brute force."""
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from dropcast.operators import rank as R


@pytest.fixture(scope="module")
def skewed(spark):
    # one hot group holding well over a third of the rows, a NULL group, many small groups
    rng = np.random.default_rng(7)
    n = 5000
    g = np.where(rng.random(n) < 0.45, "hot", rng.integers(0, 40, n).astype(str)).astype(object)
    g[rng.random(n) < 0.03] = None
    v = rng.normal(30, 10, n).round(2)
    v[rng.random(n) < 0.02] = np.nan
    pdf = pd.DataFrame({"id": np.arange(n), "g": g, "v": v})
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "id long, g string, v double")
    return df, pdf


def test_ranked_equals_row_number(spark, skewed):
    df, _ = skewed
    got = R.ranked(df, ["v", "id"], ["g"], "rn", "n").select("id", "rn", "n")
    w = Window.partitionBy("g").orderBy("v", "id")
    exp = df.select("id", F.row_number().over(w).alias("rn"), F.count(F.lit(1)).over(Window.partitionBy("g")).alias("n"))
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0


def test_hot_group_spans_partitions(spark, skewed):
    df, _ = skewed
    ck = R._range_sorted_checkpoint(df, ["g", "v", "id"], 8)
    parts = ck.filter(F.col("g") == "hot").select(R._PID).distinct().count()
    assert parts >= 3  # the hot group is split across tasks, not held by one


def test_global_rank_no_single_partition(spark, skewed):
    df, _ = skewed
    plan = R.global_rank(df, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan.split("BroadcastExchange")[0]


def test_exact_percentiles_match_numpy(spark, skewed):
    df, pdf = skewed
    got = {r.g: (r.p25, r.p50, r.p90) for r in R.exact_percentiles(df, "v", [0.25, 0.5, 0.9], ["g"]).collect()}
    for key, grp in pdf.groupby(pdf["g"].fillna("<null>")):
        vals = grp["v"].dropna().to_numpy()
        k = None if key == "<null>" else key
        exp = np.percentile(vals, [25, 50, 90])
        assert got[k] == pytest.approx(tuple(exp), rel=1e-12)


def test_running_sums_match_pandas(spark, skewed):
    df, pdf = skewed
    d = df.fillna({"v": 0.0}).withColumn("w", F.lit(1))
    got = R.running_sums(d, ["v", "id"], ["w", "v"], ["g"]).select("id", "w_cum", "v_cum").toPandas().set_index("id").sort_index()
    p = pdf.assign(v=pdf["v"].fillna(0.0), w=1, g=pdf["g"].fillna("<null>")).sort_values(["g", "v", "id"])
    p["w_cum"] = p.groupby("g")["w"].cumsum()
    p["v_cum"] = p.groupby("g")["v"].cumsum()
    p = p.set_index("id").sort_index()
    assert (got["w_cum"] == p["w_cum"]).all()
    assert np.allclose(got["v_cum"], p["v_cum"])


def test_time_split_and_folds(spark):
    n = 103
    df = spark.range(n).select(F.col("id").cast("string").alias("order_id"),
                               F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_interval(0,0,0,0,0,0, id)").alias("order_timestamp"))
    s = R.time_split(df, 0.2)
    assert s.filter("is_train").count() == int(n * 0.8)
    k = 5
    folds = R.time_series_folds(df, k).toPandas()
    size = n // (k + 1)
    for i in range(k):
        f = folds[folds.fold == i]
        assert (~f.is_val).sum() == n - (k - i) * size
        assert f.is_val.sum() == size
        # validation rows come strictly after training rows
        assert f[~f.is_val].order_timestamp.max() < f[f.is_val].order_timestamp.min()


def test_error_cdf_is_step_function(spark):
    df = spark.createDataFrame([(str(i), None if v is None else float(v)) for i, v in enumerate([1, 2, 2, 3, None])], "order_id string, abs_error double")
    out = {r.abs_error: r.cdf_pct for r in R.error_cdf(df).collect()}
    assert out == {1.0: 25.0, 2.0: 75.0, 3.0: 100.0}


def test_weighted_and_column_percentiles_match_numpy(spark, skewed):
    df, pdf = skewed
    d = df.withColumn("r", F.round("v")).withColumn("k", F.col("id") % 7)
    got = {r.column: (r.p50, r.p90) for r in R.column_percentiles(d, ["v", "r", "k"], [0.5, 0.9]).collect()}
    p = pdf.assign(r=pdf["v"].round(), k=pdf["id"] % 7)
    for c in ["v", "r", "k"]:
        vals = p[c].dropna().astype(float).to_numpy()
        assert got[c] == pytest.approx(tuple(np.percentile(vals, [50, 90])), rel=1e-12)


def test_grouped_percentiles_rank_values_not_rows(spark, monkeypatch):
    """Nine tenths of the rows share one value: what is ranked holds that value once."""
    seen = []
    plain = R._range_sorted_checkpoint
    monkeypatch.setattr(R, "_range_sorted_checkpoint", lambda df, *a: (seen.append(df.count()), plain(df, *a))[1])
    df = spark.range(20_000).select(F.when(F.col("id") % 10 > 0, 180.0).otherwise(F.col("id") / 10).alias("v"),
                                    (F.col("id") % 2).alias("g"))
    got = {r.g: (r.p, r.n) for r in R.exact_percentiles(df, "v", [0.05], ["g"], names=["p"],
                                                        extra_aggs={"n": F.count("v")}).collect()}
    pdf = df.toPandas()
    for g, part in pdf.groupby("g"):
        assert got[g] == (pytest.approx(np.percentile(part["v"], 5), rel=1e-12), len(part))
    assert seen and max(seen) <= df.distinct().count()


def test_percentiles_over_many_magnitudes(spark):
    vals = [10.0 ** -(i % 200) for i in range(40_000)]
    df = spark.createDataFrame([(v,) for v in vals], "v double").repartition(4)
    r = R.exact_percentiles(df, "v", [0.25, 0.5], names=["a", "b"], extra_aggs={"n": F.count("v")}).first()
    assert (r.a, r.b) == pytest.approx(tuple(np.percentile(vals, [25, 50])), rel=1e-12) and r.n == 40_000


@pytest.mark.parametrize("kind", ["continuous", "hot_value", "tiny"])
def test_global_percentiles_by_refinement(spark, kind, monkeypatch):
    monkeypatch.setattr(R, "REFINE_BUCKETS", 8)       # force several refinement rounds
    monkeypatch.setattr(R, "REFINE_FINAL_ROWS", 5)
    rng = np.random.default_rng(11)
    if kind == "continuous":
        vals = rng.normal(0, 1, 3000)
    elif kind == "hot_value":
        vals = np.concatenate([np.full(1500, 7.25), rng.uniform(0, 100, 1500)])
    else:
        vals = np.array([3.0, 1.0, 2.0])
    df = spark.createDataFrame([(float(x),) for x in vals] + [(None,)], "v double")
    probs = [0.0, 0.25, 0.5, 0.9, 0.99, 1.0]
    r = R.exact_percentiles(df, "v", probs, names=[f"q{i}" for i in range(len(probs))],
                            extra_aggs={"n": F.count("v"), "m": F.avg("v")}).first()
    assert r.n == len(vals) and r.m == pytest.approx(vals.mean())
    assert [r[f"q{i}"] for i in range(len(probs))] == pytest.approx(list(np.percentile(vals, [p * 100 for p in probs])), rel=1e-12)


def test_global_percentiles_with_infinity_fall_back(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (float("inf"),)], "v double")
    r = R.exact_percentiles(df, "v", [0.0, 0.5], names=["a", "b"]).first()
    assert (r.a, r.b) == (1.0, 2.0)


@pytest.mark.parametrize("final", [4, 10_000])
def test_grouped_percentiles_by_refinement(spark, monkeypatch, final):
    """Ties, null groups and values, a group with most rows, tiny groups: equal to numpy without ranking any rows."""
    monkeypatch.setattr(R, "REFINE_FINAL_ROWS", final)
    monkeypatch.setattr(R, "running_sums", None)  # the ranking path would call it
    rng = np.random.default_rng(11)
    rows = [("hot", float(x)) for x in rng.normal(size=3000)] + [("ties", 7.0)] * 900 + [("ties", float(x)) for x in rng.normal(size=100)]
    rows += [(None, float(x)) for x in rng.exponential(size=50) ** 6] + [("one", 3.0), ("none", None), ("hot", None), ("two", -1.0), ("two", 2.5)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    out = R.grouped_percentiles(df, "v", probs, ["g"], names=[f"q{i}" for i in range(5)], extra_aggs={"n": F.count("v"), "rows": F.count(F.lit(1))})
    got = {r.g: r for r in out.collect()}
    assert set(got) == {"hot", "ties", None, "one", "none", "two"}
    for g, r in got.items():
        own = [v for k, v in rows if k == g and v is not None]
        assert (r.n, r.rows) == (len(own), sum(k == g for k, _ in rows))
        want = np.percentile(own, [100 * p for p in probs]) if own else [None] * 5
        assert [r[f"q{i}"] for i in range(5)] == (pytest.approx(list(want), rel=1e-12) if own else want)


def test_grouped_percentiles_of_infinite_values_are_ranked(spark):
    df = spark.createDataFrame([("a", float("inf")), ("a", 1.0), ("a", 2.0), ("b", 5.0)], "g string, v double")
    assert {r.g: r.p50 for r in R.grouped_percentiles(df, "v", [0.5], ["g"]).collect()} == {"a": 2.0, "b": 5.0}

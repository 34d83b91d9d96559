"""Drift statistics against brute-force numpy definitions."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from dropcast.operators import drift as DR


def _w1(a, b):
    xs = np.sort(np.unique(np.concatenate([a, b])))
    fa = np.searchsorted(np.sort(a), xs, side="right") / len(a)
    fb = np.searchsorted(np.sort(b), xs, side="right") / len(b)
    return float(np.sum(np.abs(fa - fb)[:-1] * np.diff(xs))), float(np.max(np.abs(fa - fb)))


@pytest.fixture(scope="module")
def sets(spark):
    rng = np.random.default_rng(3)
    a = rng.normal(10, 2, 800).round(1)
    b = rng.normal(11, 2, 600).round(1)
    ca = rng.choice(["x", "y", "z"], 800, p=[0.5, 0.3, 0.2])
    cb = rng.choice(["x", "y", "w"], 600, p=[0.2, 0.3, 0.5])
    ref = spark.createDataFrame([(float(x), str(c)) for x, c in zip(a, ca)], "v double, c string")
    cur = spark.createDataFrame([(float(x), str(c)) for x, c in zip(b, cb)], "v double, c string")
    return ref, cur, a, b, ca, cb


def test_wasserstein_and_ks(sets):
    ref, cur, a, b, _, _ = sets
    r = DR.column_drift_numeric(ref, cur, ["v"]).first()
    w1, ks = _w1(a, b)
    assert r.wasserstein == pytest.approx(w1, rel=1e-9)
    assert r.ks_statistic == pytest.approx(ks, rel=1e-12)
    assert r.drift_score == pytest.approx(w1 / np.std(a), rel=1e-9)
    assert r.drift_detected and 0 <= r.ks_pvalue < 0.01


def test_identical_sets_no_drift(sets):
    ref, _, _, _, _, _ = sets
    r = DR.column_drift_numeric(ref, ref, ["v"]).first()
    assert r.wasserstein == pytest.approx(0.0, abs=1e-12) and not r.drift_detected and r.ks_pvalue == 1.0
    c = DR.column_drift_categorical(ref, ref, ["c"]).first()
    assert c.drift_score == pytest.approx(0.0, abs=1e-7) and not c.drift_detected


def test_jensen_shannon_and_psi(sets):
    ref, cur, _, _, ca, cb = sets
    r = DR.column_drift_categorical(ref, cur, ["c"]).first()
    cats = sorted(set(ca) | set(cb))
    p = np.array([np.mean(ca == k) for k in cats])
    q = np.array([np.mean(cb == k) for k in cats])
    m = (p + q) / 2
    kl = lambda x, y: np.sum(np.where(x > 0, x * np.log(np.where(x > 0, x, 1) / y), 0))
    js = np.sqrt(0.5 * kl(p, m) + 0.5 * kl(q, m))
    pe, qe = np.maximum(p, 1e-4), np.maximum(q, 1e-4)
    assert r.drift_score == pytest.approx(js, rel=1e-9)
    assert r.psi == pytest.approx(np.sum((pe - qe) * np.log(pe / qe)), rel=1e-9)


def test_dataset_drift_and_retrain(sets):
    ref, cur, _, _, _, _ = sets
    d = DR.dataset_drift(ref, cur, ["v"], ["c"]).first()
    assert d.drift_share == 1.0 and d.drift_detected and d.drifted_columns == "c,v"
    assert d.n_reference_samples == 800 and d.n_current_samples == 600
    rep = DR.monitoring_report(ref.withColumn("y", F.col("v")), cur.withColumn("y", F.col("v") + 20).withColumn("p", F.col("v")),
                               ["v"], ["c"], "y", "p")
    r = DR.should_retrain(rep).first()
    assert r.should_retrain and r.n_reasons == 3
    suite = DR.drift_test_suite(DR.column_drift(ref, cur, ["v"], ["c"])).first()
    assert suite.n_tests == 2 and suite.n_failed == 2 and not suite.all_tests_passed


def test_target_drift_absent_target(sets):
    ref, cur, _, _, _, _ = sets
    assert DR.target_drift(ref, cur, "nope").count() == 0


@pytest.mark.parametrize(("statistic", "degrees", "p"), [
    (3.841459, 1, 0.05), (6.634897, 1, 0.01), (5.991465, 2, 0.05), (16.918978, 9, 0.05), (43.772972, 30, 0.05), (124.342113, 100, 0.05),
    (0.0039321, 1, 0.95), (61.754079, 90, 0.99), (0.0, 3, 1.0), (5.0, 0, 1.0), (9000.0, 4, 0.0), (1074.679449, 1000, 0.05)])
def test_chi_square_tail_equals_published_tables(spark, statistic, degrees, p):
    got = spark.range(1).select(DR.chi2_pvalue(F.lit(statistic), F.lit(float(degrees))).alias("p")).first().p
    assert got == pytest.approx(p, abs=2e-6)


def test_chi_square_of_two_tables(spark):
    ref = spark.createDataFrame([("a",)] * 30 + [("b",)] * 70, "c string")
    cur = spark.createDataFrame([("a",)] * 50 + [("b",)] * 50, "c string")
    r = DR.column_drift_categorical(ref, cur, ["c"]).first()
    assert (r.chi2_df, r.chi2_statistic) == (1, pytest.approx(200 * (30 * 50 - 70 * 50) ** 2 / (100 * 100 * 80 * 120)))
    assert r.chi2_pvalue == pytest.approx(0.003892, abs=1e-6)


def test_drifted_columns_with_score_and_test(spark):
    ref = spark.range(100).select(F.col("id").cast("double").alias("x"), F.lit("u").alias("c"), F.lit(1.0).alias("y"))
    cur = ref.select((F.col("x") + 90).alias("x"), F.lit("v").alias("c"), "y")
    r = DR.dataset_drift(ref, cur, ["x", "y"], ["c"]).first()
    assert [(d.column, d.test) for d in r.drifted] == [("c", "jensenshannon"), ("x", "wasserstein")] and r.drifted[1].score > 1

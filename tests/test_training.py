"""Training plan: split, early-stopping tail, folds, tuning, scoring model persistence."""
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from dropcast.plans import training as TR
from dropcast.sources import fixtures as FX

from conftest import SF001

SMALL = dict(n_estimators=5, learning_rate=0.2, max_depth=3, min_child_samples=5, subsample=1.0, colsample_bytree=1.0)


@pytest.fixture(scope="module")
def prep(spark):
    return TR.prepare_data(FX.deliveries(spark, SF001))


def test_split_sizes_and_order(prep):
    ntr, nte = prep.train.count(), prep.test.count()
    assert ntr == int((ntr + nte) * 0.8)
    assert prep.train.agg(F.max("order_timestamp")).first()[0] <= prep.test.agg(F.min("order_timestamp")).first()[0]
    assert len(prep.features) == 28


def test_validation_tail_is_latest(prep):
    v = TR.with_validation_tail(prep.train, 0.1)
    assert v.filter("is_validation").count() == prep.train.count() - int(prep.train.count() * 0.9)
    assert (v.filter("NOT is_validation").agg(F.max("order_timestamp")).first()[0]
            <= v.filter("is_validation").agg(F.min("order_timestamp")).first()[0])


def test_train_predict_importance_and_roundtrip(spark, prep, tmp_path):
    model = TR.train_gbt(prep.train, prep.features, TR.gbt_params(**SMALL))
    pred = TR.predict(model, prep.test)
    assert pred.filter(F.col("predicted_eta_minutes").isNull()).count() == 0
    imp = TR.feature_importance(model, prep.features, spark).collect()
    assert len(imp) == 28 and sum(r.importance for r in imp) == pytest.approx(1.0)
    assert [r.importance for r in imp] == sorted((r.importance for r in imp), reverse=True)
    full = TR.scoring_model(prep, model)
    path = str(tmp_path / "scoring")
    full.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    raw_test = FX.deliveries(spark, SF001).join(prep.test.select("order_id"), "order_id")
    a = TR.predict(full, raw_test).select("order_id", "predicted_eta_minutes")
    b = TR.predict(loaded, raw_test).select("order_id", "predicted_eta_minutes")
    assert a.exceptAll(b).count() == 0
    rep = TR.evaluation_report(model, prep)
    assert {r.split for r in rep.metrics.collect()} == {"train", "test"}
    assert TR.target_met(TR.evaluate(model, prep.test)).first().target_met in (True, False)


def test_cross_validation_folds(prep):
    fm, summary = TR.cross_validate_time(prep.train, prep.features, TR.gbt_params(**SMALL), 3)
    assert fm.count() == 3 and summary.first().mae_mean > 0


def test_random_search_is_seeded(prep):
    assert TR.sample_params(4, seed=1) == TR.sample_params(4, seed=1)
    p = TR.sample_params(20, seed=2)
    assert all(100 <= x["n_estimators"] <= 2000 and 0.01 <= x["learning_rate"] <= 0.3 for x in p)
    space = {"n_estimators": (3, 5, False), "learning_rate": (0.05, 0.3, True), "max_depth": (2, 3, False),
             "min_child_samples": (5, 10, False), "subsample": (0.8, 1.0, False), "colsample_bytree": (0.8, 1.0, False)}
    table, best = TR.tune_hyperparameters(prep.train, prep.features, n_trials=2, n_splits=2, space=space)
    assert table.count() == 2 and set(best) == set(space)


def test_alt_model(prep):
    m = TR.train_alt_model(prep.train, prep.features, TR.gbt_params(**SMALL))
    assert TR.predict(m, prep.test).count() == prep.test.count()

"""Registered training queries use the published settings; early stopping waits for the published rounds."""
import pytest

from dropcast.constants import GBT_DEFAULTS, SEARCH_SPACE
from dropcast.plans import catalog as CAT
from dropcast.plans import training as TR
from dropcast.sources import fixtures as FX

from conftest import SF001


class Called(Exception):
    pass


@pytest.mark.parametrize("query, function", [("train_gbt", "train_gbt"), ("train_alt_model", "train_alt_model"),
                                             ("cross_validate_time", "fold_metrics"), ("tune_hyperparameters", "tune_hyperparameters")])
def test_queries_pass_the_published_settings(spark, monkeypatch, query, function):
    seen = {}

    def spy(df, features, *args, **kwargs):
        seen.update(args=args, kwargs=kwargs)
        raise Called

    monkeypatch.setattr(TR, function, spy)
    monkeypatch.setattr(CAT, "_MEMO", {})
    with pytest.raises(Called):
        CAT.QUERIES[query](spark, SF001)
    if query == "tune_hyperparameters":
        assert seen["kwargs"]["n_trials"] == 50 and seen["kwargs"]["n_splits"] == 5
        assert seen["kwargs"].get("space", SEARCH_SPACE) == SEARCH_SPACE and seen["kwargs"].get("timeout_s") is None
    else:
        assert seen["args"][0] == GBT_DEFAULTS and seen["args"][0]["n_estimators"] == 1000
    if query == "cross_validate_time":
        assert seen["args"][1] == 5


def test_best_round_waits():
    assert TR.best_round([5, 4, 4.5, 4.2, 3.9, 4, 4], 3) == (5, False)
    assert TR.best_round([5, 4, 4.5, 4.2, 3.9, 4, 4], 2) == (2, True)


def test_early_stopping_keeps_the_best_trees(spark):
    prep = TR.prepare_data(FX.deliveries(spark, SF001))
    p = TR.gbt_params(n_estimators=24, learning_rate=0.6, max_depth=4, min_child_samples=5, early_stopping_rounds=3)
    train = prep.train.persist()
    full = TR.train_gbt(train.filter("NOT is_validation"), prep.features, p, early_stopping=False)
    va, trees = full.stages
    n, stopped = TR.best_round(trees.evaluateEachIteration(va.transform(train.filter("is_validation")), "squared"), 3)
    got = TR.train_gbt(train, prep.features, p)
    assert stopped and 1 <= n < 24 and got.stages[-1].getNumTrees == n
    assert got.stages[-1].numFeatures == 28 and got.stages[-1].treeWeights == trees.treeWeights[:n]
    assert [t.toDebugString.split("\n", 1)[1] for t in got.stages[-1].trees] == [t.toDebugString.split("\n", 1)[1] for t in trees.trees[:n]]
    assert TR.PRED_COL in TR.predict(got, prep.test).columns

"""The query evaluation_report has segments and sizes."""
from dropcast.plans import catalog as CAT
from dropcast.plans import training as TR

from conftest import SF001

SMALL = dict(n_estimators=4, learning_rate=0.2, max_depth=3, min_child_samples=5, subsample=1.0, colsample_bytree=1.0,
             early_stopping_rounds=50)


def test_report_has_segments_and_sizes(spark, monkeypatch):
    monkeypatch.setattr(TR, "GBT_DEFAULTS", SMALL)
    monkeypatch.setattr(CAT, "_MEMO", {})
    rows = CAT.QUERIES["evaluation_report"](spark, SF001).collect()
    parts = [r.part for r in rows]
    assert parts.count("train") == parts.count("test") == 1
    assert parts.count("hour_of_day") > 1 and 1 < parts.count("day_of_week") <= 7
    prep, _ = CAT._trained(spark, SF001)
    assert {(r.n_train, r.n_test) for r in rows} == {(prep.train.count(), prep.test.count())}

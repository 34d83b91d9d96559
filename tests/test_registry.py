"""Models found through the registry that a training run wrote, and the interval from its test error."""
import pytest
from pyspark.sql import functions as F

from dropcast.plans import jobs as J
from dropcast.plans import training as TR
from dropcast.sources import fixtures as FX

from conftest import SF001

SMALL = dict(n_estimators=3, learning_rate=0.2, max_depth=3, min_child_samples=5, subsample=1.0, colsample_bytree=1.0)


def test_registered_versions_are_found_and_score(spark, tmp_path):
    orders = FX.deliveries(spark, SF001)
    prep = TR.prepare_data(orders)
    out, model = str(tmp_path / "run"), None
    for version in ("v2", "v10"):
        model = TR.train_gbt(prep.train, prep.features, TR.gbt_params(**dict(SMALL, n_estimators=3 if version == "v2" else 4)))
        report = TR.evaluation_report(model, prep)
        metrics = J.save_run(spark, prep, model, report, out, "eta_model", version)
    registry = f"{out}/model_registry"
    loaded, entry = J.load_registered(spark, registry)
    assert entry["version"] == "v10" and entry["features"] == prep.features and entry["mae"] == metrics["test"]["mae"]
    a, b = (TR.predict(m, orders).select("order_id", "predicted_eta_minutes") for m in (loaded, TR.scoring_model(prep, model)))
    assert a.exceptAll(b).isEmpty()
    assert J.load_registered(spark, registry, version="v2")[1]["version"] == "v2"
    for name, version in (("other", None), ("eta_model", "v3")):
        with pytest.raises(LookupError):
            J.load_registered(spark, registry, name, version)
    with pytest.raises(LookupError):
        J.load_registered(spark, str(tmp_path / "nowhere"))

    orders.write.parquet(str(tmp_path / "orders"))
    scored = J.score_job(spark, str(tmp_path / "orders"), f"{out}/model", str(tmp_path / "scored"))
    # without the registry's error the interval would be that of 4.5 minutes
    wide = F.col("confidence_interval_upper") - F.col("confidence_interval_lower")
    got = scored.where("confidence_interval_lower > 1").agg(F.max(wide)).first()[0]
    assert entry["mae"] > 5 and (got is None or got == pytest.approx(3 * entry["mae"], abs=0.3))

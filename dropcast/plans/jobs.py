"""End-to-end batch jobs (the user-facing entry points) and a small CLI.

    python -m dropcast.plans.jobs clean   --input RAW  --output OUT [--format parquet|csv] [--outlier-method iqr]
    python -m dropcast.plans.jobs train   --input CLEAN --output MODEL_DIR [--tune-trials N] [--cv-folds K]
    python -m dropcast.plans.jobs score   --input ORDERS --model MODEL_DIR --output PRED_LOG
    python -m dropcast.plans.jobs monitor --reference REF --current CUR --output REPORT_DIR

Inputs are Parquet (or CSV with ``--format csv``) order tables. Every output is
written by Spark into the given folder; reports are one-row JSON tables.
"""

from __future__ import annotations

import argparse
import json
import os

from pyspark.ml import PipelineModel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import TARGET
from ..operators import clean as C
from ..operators import drift as DR
from ..sources import readers as RD
from ..sources import sinks as SK
from . import training as TR


def _read(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    if fmt == "csv":
        return RD.load_csv_orders(spark, path)
    return spark.read.parquet(path)


def _write_json_row(spark: SparkSession, payload: dict, path: str) -> None:
    """A small report (scalars only) as a one-row JSON table."""
    spark.createDataFrame([(json.dumps(payload, default=str),)], "report string") \
        .select(F.col("report")).write.mode("overwrite").text(path)


def clean_job(spark: SparkSession, input_path: str, output_path: str, fmt: str = "parquet",
              outlier_method: str = "iqr") -> dict:
    """Read raw orders, clean, validate the target, write cleaned rows and the cleaning report."""
    res = C.clean_orders(_read(spark, input_path, fmt), outlier_method=outlier_method)
    (SK.write_csv if fmt == "csv" else SK.write_parquet)(res.df, os.path.join(output_path, "orders"))
    target = C.validate_target(res.df).first().asDict()
    report = {"cleaning": res.report, "target_validation": target}
    _write_json_row(spark, report, os.path.join(output_path, "report"))
    return report


def save_run(spark: SparkSession, prep: TR.Prepared, model: PipelineModel, report: TR.Report, output_path: str,
             model_name: str, version: str) -> dict:
    """Write a training run: scoring model, importance, segment tables, and a registry row with the test metrics, the
    features in their order and the model's place. Returns the metrics by split."""
    metrics = {r["split"]: {k: v for k, v in r.asDict().items() if k != "split"} for r in report.metrics.collect()}
    path = os.path.join(output_path, "model")
    TR.scoring_model(prep, model).write().overwrite().save(path)
    SK.write_csv(TR.feature_importance(model, prep.features, spark), os.path.join(output_path, "feature_importance"))
    SK.write_csv(report.hour_segments, os.path.join(output_path, "metrics_by_hour"))
    SK.write_csv(report.dow_segments, os.path.join(output_path, "metrics_by_dow"))
    entry = spark.createDataFrame(
        [(model_name, version, "staging", metrics["test"]["mae"], metrics["test"]["rmse"], metrics["test"]["r2"], path, prep.features)],
        "model_name string, version string, stage string, mae double, rmse double, r2 double, artifact_path string, features array<string>")
    registry = os.path.join(output_path, "model_registry")
    existing = _registry(spark, registry)
    existing = entry.limit(0) if existing is None else existing.checkpoint(eager=True)
    SK.write_parquet(SK.register_model_version(existing, entry), registry)
    return metrics


def _registry(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        found = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    # rows written before the features were recorded
    return found if "features" in found.columns else found.withColumn("features", F.lit(None).cast("array<string>"))


def load_registered(spark: SparkSession, registry_path: str, model_name: str = "eta_model", version: str | None = None) -> tuple[PipelineModel, dict]:
    """A registered model and its registry row: the version asked for, else the last one in order of the names (digits
    as numbers). A name or version that is not registered is an error."""
    rows = _registry(spark, registry_path)
    if rows is None:
        raise LookupError(f"no model registry at {registry_path}")
    found = rows.filter(F.col("model_name") == model_name)
    found = found if version is None else found.filter(F.col("version") == version)
    number = F.regexp_extract("version", r"(\d+)", 1).cast("long")
    entry = found.orderBy(number.desc_nulls_last(), F.desc("version")).first()
    if entry is None:
        raise LookupError(f"{model_name} {version or ''} is not registered at {registry_path}")
    return PipelineModel.load(entry["artifact_path"]), entry.asDict()


def train_job(spark: SparkSession, input_path: str, output_path: str, fmt: str = "parquet", params: dict | None = None,
              cv_folds: int = 0, tune_trials: int = 0, tune_timeout_s: float = 1800, model_name: str = "eta_model",
              version: str = "v1") -> dict:
    """Load -> validate -> time split -> features -> (CV) -> (tune) -> fit -> evaluate -> persist.

    Persists the scoring PipelineModel, metrics JSON, feature importance CSV,
    hour/weekday segment CSVs and a model-registry row.
    """
    df = RD.load_validated(_read(spark, input_path, fmt))
    prep = TR.prepare_data(df)
    out = {"n_features": len(prep.features)}
    best = dict(params or TR.gbt_params())
    if tune_trials:
        table, tuned = TR.tune_hyperparameters(prep.train, prep.features, n_trials=tune_trials,
                                               timeout_s=tune_timeout_s)
        SK.write_csv(table, os.path.join(output_path, "tuning_trials"))
        best.update({k: (int(v) if k in ("n_estimators", "max_depth", "min_child_samples") else v) for k, v in tuned.items()})
    if cv_folds:
        _, summary = TR.cross_validate_time(prep.train, prep.features, best, cv_folds)
        out["cv"] = summary.first().asDict()
    model = TR.train_gbt(prep.train, prep.features, best)
    report = TR.evaluation_report(model, prep)
    metrics = save_run(spark, prep, model, report, output_path, model_name, version)
    out["metrics"] = metrics
    out["target_met"] = bool(metrics["test"]["mae"] is not None and metrics["test"]["mae"] < 5.0)
    _write_json_row(spark, out, os.path.join(output_path, "training_report"))
    return out


def score_job(spark: SparkSession, input_path: str, model_path: str, output_path: str, fmt: str = "parquet",
              mae: float | None = None, model_version: str = "v1") -> DataFrame:
    """Batch scoring: validity -> defaults -> fitted pipeline -> interval -> id -> prediction log.

    The interval's width is the test error that training registered for this model (beside the model's folder), unless
    ``mae`` is given; 4.5 minutes where neither is known."""
    from ..streaming.jobs import score_orders

    model = PipelineModel.load(model_path)
    if mae is None:
        rows = _registry(spark, os.path.join(os.path.dirname(model_path.rstrip("/")), "model_registry"))
        entry = None if rows is None else rows.filter((F.col("artifact_path") == model_path.rstrip("/")) & F.col("mae").isNotNull()).orderBy(F.desc("version")).first()
        mae = entry["mae"] if entry else 4.5
    scored = score_orders(_read(spark, input_path, fmt), model=model, mae=mae, model_version=model_version)
    SK.write_parquet(scored, output_path)
    return spark.read.parquet(output_path)


def monitor_job(spark: SparkSession, reference_path: str, current_path: str, output_path: str,
                numeric: list[str] | None = None, categorical: list[str] | None = None, fmt: str = "parquet",
                target: str = TARGET, predicted: str = "predicted_eta_minutes") -> dict:
    """Drift report (data, target, quality, suite) + drift-report row + retrain decision."""
    ref, cur = _read(spark, reference_path, fmt), _read(spark, current_path, fmt)
    if numeric is None or categorical is None:
        num, cat = C.detect_feature_types(ref)
        numeric = num if numeric is None else numeric
        categorical = cat if categorical is None else categorical
    rep = DR.monitoring_report(ref, cur, numeric, categorical, target, predicted).checkpoint(eager=True)
    decision = DR.should_retrain(rep).first().asDict()
    cd = DR.column_drift(ref, cur, numeric, categorical)
    SK.write_parquet(SK.drift_report_row(cd, F.current_timestamp().cast("timestamp_ntz")),
                     os.path.join(output_path, "drift_reports"), mode="append")
    out = {"report": rep.first().asDict(), "retrain": decision}
    _write_json_row(spark, out, os.path.join(output_path, "monitoring_report"))
    return out


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="dropcast")
    sub = ap.add_subparsers(dest="cmd", required=True)
    c = sub.add_parser("clean")
    c.add_argument("--input", required=True)
    c.add_argument("--output", required=True)
    c.add_argument("--format", default="parquet")
    c.add_argument("--outlier-method", default="iqr")
    t = sub.add_parser("train")
    t.add_argument("--input", required=True)
    t.add_argument("--output", required=True)
    t.add_argument("--format", default="parquet")
    t.add_argument("--cv-folds", type=int, default=0)
    t.add_argument("--tune-trials", type=int, default=0)
    t.add_argument("--tune-timeout", type=float, default=1800)
    s = sub.add_parser("score")
    s.add_argument("--input", required=True)
    s.add_argument("--model", required=True)
    s.add_argument("--output", required=True)
    s.add_argument("--format", default="parquet")
    m = sub.add_parser("monitor")
    m.add_argument("--reference", required=True)
    m.add_argument("--current", required=True)
    m.add_argument("--output", required=True)
    m.add_argument("--format", default="parquet")
    args = ap.parse_args(argv)
    from ..session import build_session

    spark = build_session(os.environ.get("DROPCAST_MASTER"))
    if args.cmd == "clean":
        print(json.dumps(clean_job(spark, args.input, args.output, args.format, args.outlier_method), default=str))
    elif args.cmd == "train":
        print(json.dumps(train_job(spark, args.input, args.output, args.format, cv_folds=args.cv_folds,
                                   tune_trials=args.tune_trials, tune_timeout_s=args.tune_timeout), default=str))
    elif args.cmd == "score":
        print(score_job(spark, args.input, args.model, args.output, args.format).count())
    else:
        print(json.dumps(monitor_job(spark, args.reference, args.current, args.output, fmt=args.format), default=str))


__all__ = ["clean_job", "train_job", "score_job", "monitor_job", "main"]

if __name__ == "__main__":
    main()

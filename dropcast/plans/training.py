"""Training, tuning, scoring and evaluation with ``pyspark.ml``.

Boosted trees are MLlib's ``GBTRegressor`` (random forest as the second
algorithm). Early stopping uses the time-ordered tail of the *training* rows
as validation set, never the test set, and ends after ``early_stopping_rounds``
trees without a smaller error (MLlib's own rule ends at the first such tree). Cross-validation uses expanding
time-ordered folds (a plain ``CrossValidator`` would train on future rows).
"""

from __future__ import annotations

import math
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import GBT_DEFAULTS, MAE_TARGET_MINUTES, MODEL_FEATURES, SEARCH_SPACE, TARGET
from ..operators import features as FE
from ..operators import metrics as M
from ..operators.rank import RankCutoffs, time_split
from ..session import ensure_checkpoint_dir

PRED_COL = "predicted_eta_minutes"
SPREAD_ROWS = 50_000  # of a partition, from which on a fit's jobs are worth a core each
SPREAD_SHARE = 1.25  # of an even share, up to which a core's rows may stay as they are
FOREST_TREES = 20  # grown in one fit
MANY_TREES = 100  # of a model, from which on scoring a row takes far longer than moving it
MAX_PARTITION_ROWS = 1_000_000  # of a dealt partition
FOLD_CHECKPOINT = 4  # trees; a longer lineage makes the small jobs of the folds slower


@dataclass
class Prepared:
    train: DataFrame
    test: DataFrame
    features: list[str]
    feature_model: PipelineModel
    imputer: FE.MedianImputerModel


def prepare_data(df: DataFrame, test_size: float = 0.2, target: str = TARGET,
                 validation_fraction: float = 0.1) -> Prepared:
    """Time split -> fit features on train only -> model features -> train-median fill.

    One ranking of the (time, id) keys serves both the train/test split and the
    early-stopping tail (``is_validation``: the last ``validation_fraction`` of
    the training rows); the rows themselves are filtered, never re-shuffled.
    """
    cut = RankCutoffs(df, ["order_timestamp", "order_id"])
    split_idx = math.floor(cut.n * (1.0 - float(test_size)))
    val_idx = math.floor(split_idx * (1.0 - float(validation_fraction)))
    cut.fetch([split_idx, val_idx])
    in_train = cut.at_or_before(split_idx)
    train = df.filter(in_train).withColumn("is_validation", ~cut.at_or_before(val_idx))
    test = df.filter(~in_train)
    fmodel = FE.fit_feature_pipeline(train, ("zone_id", "restaurant_type"), ("zone_id",), False, target)
    xtr, xte = fmodel.transform(train), fmodel.transform(test)
    feats = [f for f in MODEL_FEATURES if f in xtr.columns]
    imp = FE.MedianImputer(inputCols=feats).fit(xtr)
    return Prepared(imp.transform(xtr), imp.transform(xte), feats, fmodel, imp)


def gbt_params(**overrides) -> dict:
    p = dict(GBT_DEFAULTS)
    p.update(overrides)
    return p


def _depth(params: dict) -> int:
    if int(params["max_depth"]) > 30:
        raise ValueError("MLlib trees have at most 30 levels")
    return int(params["max_depth"])


def with_vector(df: DataFrame, features: list[str], col: str = "features") -> DataFrame:
    """``df`` with the vector that a ``VectorAssembler`` keeping invalid values makes of numeric columns (missing: NaN).

    Its function over a struct of all columns makes the generated code of the training rows longer than the JVM compiles
    (8,000 bytes a method), so that rows were built by interpreted code.
    """
    values = [F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in features]
    return df.withColumn(col, array_to_vector(F.array(*values)))


def assembled(df: DataFrame, features: list[str], *columns: str) -> tuple[VectorAssembler, DataFrame]:
    """The assembler, and what a learner needs of ``df``: the feature vector and ``columns``."""
    va = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep")
    return va, with_vector(df, features).select("features", *columns)


def spread(data: DataFrame, target: str = TARGET, rows: int = SPREAD_ROWS, cut: bool = False) -> DataFrame:
    """Cached ``data`` (vectors), dealt to all cores if a partition has more than ``rows`` rows and the partitions, taken in
    turn by the cores, would keep the busiest one ``SPREAD_SHARE`` times its even share: a table read from few or uneven
    row groups would leave cores idle in every job of a fit.

    Rows are placed and ordered by their content, so that the samples drawn from partitions do not depend on the layout
    of the files. With ``cut``, rows that stay where they are come from a checkpoint: each of the small jobs of a fit
    sends the steps that made its rows along with its tasks (dealt rows only those since the shuffle). Fewer partitions than
    cores are then not cached: every fit would run where they are, on one of the executors; a fit reads the files a few
    times and keeps its own points. Free the result when done.
    """
    data = data.persist()
    cores = data.sparkSession.sparkContext.defaultParallelism
    size = data.groupBy(F.spark_partition_id()).count().agg(
        F.max("count").alias("most"), F.sum("count").alias("n"), F.count("count").alias("parts")).first()
    if not size["n"] or size["most"] <= rows or size["most"] * math.ceil(size["parts"] / cores) * cores <= SPREAD_SHARE * size["n"]:
        if not cut:
            return data
        ensure_checkpoint_dir(data.sparkSession)
        kept = data.checkpoint()
        if size["parts"] >= cores:
            kept = kept.persist()
            kept.count()
        data.unpersist()
        return kept
    parts = cores * math.ceil(size["n"] / (cores * MAX_PARTITION_ROWS))  # whole turns: a last one of few partitions costs as much as a full one
    dealt = data.withColumn("_key", F.xxhash64("features", target)).repartition(parts, "_key").sortWithinPartitions("_key").drop("_key").persist()
    dealt.count()
    data.unpersist()
    return dealt


def _gbt(params: dict, target: str, seed: int, checkpoint: int = 10) -> GBTRegressor:
    """Boosted trees. Every level finds a row's node from the root (the same trees): a stored table of node ids costs
    more at these depths than the steps it saves. The predictions so far are written after every ``checkpoint`` trees."""
    return GBTRegressor(
        featuresCol="features", labelCol=target, predictionCol=PRED_COL,
        maxIter=int(params["n_estimators"]), stepSize=float(params["learning_rate"]),
        maxDepth=_depth(params), minInstancesPerNode=int(params["min_child_samples"]),
        subsamplingRate=float(params["subsample"]), featureSubsetStrategy=str(float(params["colsample_bytree"])),
        lossType="squared", seed=seed, checkpointInterval=checkpoint, cacheNodeIds=False,
    )


def best_round(errors: list[float], rounds: int) -> tuple[int, bool]:
    """(number of trees up to the smallest error, whether ``rounds`` trees after it were no better)."""
    best = 0
    for i, e in enumerate(errors):
        if e < errors[best]:
            best = i
        elif i - best >= rounds:
            return best + 1, True
    return best + 1, False


def _grown(train: DataFrame, validation: DataFrame, params: dict, target: str, seed: int,
           checkpoint: int = 10) -> tuple[GBTRegressionModel, list[float], int]:
    """(model fitted on ``train`` (vectors), mean squared error on ``validation`` after each tree, number of trees up to
    the smallest), as boosting that ends after ``early_stopping_rounds`` trees without a smaller one.

    A fit cannot be continued, but its first trees do not depend on how many follow: a tenth more than the rounds are
    tried first, as no end shows before the rounds are over, then twice as many each time until the end shows, or just the
    rounds after the best tree if that lies in the first half.
    """
    rounds, total = int(params.get("early_stopping_rounds", GBT_DEFAULTS["early_stopping_rounds"])), int(params["n_estimators"])
    size = min(total, rounds + max(1, rounds // 10))
    while True:
        model = _gbt(dict(params, n_estimators=size), target, seed, checkpoint).fit(train)
        errors = model.evaluateEachIteration(validation, "squared")
        n, stopped = best_round(errors, rounds)
        if stopped or size == total:
            return model, errors, n
        size = min(total, n + rounds if 2 * n <= size else 2 * size)


def _fit_stopped(train: DataFrame, validation: DataFrame, params: dict, target: str, seed: int) -> GBTRegressionModel:
    """The trees up to the one with the smallest error on ``validation``, fitted on their own if more were grown."""
    model, _, n = _grown(train, validation, params, target, seed)
    return model if n == model.getNumTrees else _gbt(dict(params, n_estimators=n), target, seed).fit(train)


def with_validation_tail(train: DataFrame, fraction: float = 0.1, col: str = "is_validation") -> DataFrame:
    """Mark the last ``fraction`` of training rows in time order as the early-stopping set."""
    s = time_split(train, fraction)
    return s.withColumn(col, ~F.col("is_train")).drop("is_train")


def train_gbt(train: DataFrame, features: list[str], params: dict | None = None, target: str = TARGET,
              early_stopping: bool = True, seed: int = 42) -> PipelineModel:
    """Boosted trees; only the feature vector, the target and the validation mark are kept between the iterations."""
    params = params or gbt_params()
    if early_stopping and "is_validation" not in train.columns:
        train = with_validation_tail(train)
    va, data = assembled(train, features, target, *(["is_validation"] if early_stopping else []))
    data = spread(data, target)
    try:
        tail = data.filter("is_validation") if early_stopping else None
        if tail is None or tail.isEmpty():
            return PipelineModel(stages=[va, _gbt(params, target, seed).fit(data)])
        return PipelineModel(stages=[va, _fit_stopped(data.filter("NOT is_validation"), tail, params, target, seed)])
    finally:
        data.unpersist()


def train_alt_model(train: DataFrame, features: list[str], params: dict | None = None, target: str = TARGET,
                    seed: int = 42) -> PipelineModel:
    """Second algorithm with the same interface: random forest.

    More than ``FOREST_TREES`` trees are grown as forests of that many with a seed each, whose predictions are averaged
    by their numbers of trees: the sample counts kept per row and the statistics kept per task stay those of one such
    forest. A quarter more are grown at once than the partitions of the rows leave cores idle, so that none waits while a
    fit is between two jobs or the last ones end. A row's node in each tree is kept from level to level (the same
    trees): 20 walks from the root a level cost more than a stored id.
    """
    params = params or gbt_params()
    total = int(params["n_estimators"])
    sizes = [min(FOREST_TREES, total - first) for first in range(0, total, FOREST_TREES)]
    columns = [PRED_COL] if len(sizes) == 1 else [f"_forest_{i}" for i in range(len(sizes))]
    va, data = assembled(train, features, target)
    data = spread(data, target, 10 * SPREAD_ROWS, cut=True)

    def grow(i: int) -> RandomForestRegressionModel:
        return RandomForestRegressor(
            featuresCol="features", labelCol=target, predictionCol=columns[i],
            numTrees=sizes[i], maxDepth=_depth(params),
            minInstancesPerNode=int(params["min_child_samples"]), subsamplingRate=float(params["subsample"]),
            featureSubsetStrategy=str(float(params["colsample_bytree"])), seed=seed + i, cacheNodeIds=True).fit(data)

    try:
        session = data.sparkSession
        idle = math.ceil(session.sparkContext.defaultParallelism / max(1, data.select(F.spark_partition_id()).distinct().count()))
        with ThreadPoolExecutor(max_workers=math.ceil(1.25 * idle) if idle > 1 else 1) as pool:
            forests = list(pool.map(inheritable_thread_target(session)(grow), range(len(sizes))))
    finally:
        data.unpersist()
    if len(forests) == 1:
        return PipelineModel(stages=[va, *forests])
    mean = " + ".join(f"{n} * {c}" for n, c in zip(sizes, columns))
    average = SQLTransformer(statement=f"SELECT * EXCEPT ({', '.join(columns)}), ({mean}) / {total} AS {PRED_COL} FROM __THIS__")
    return PipelineModel(stages=[va, *forests, average])


def tree_stages(model: PipelineModel) -> list:
    """The fitted tree models of a pipeline (one, or the forests that make up a larger one)."""
    return [s for s in model.stages if hasattr(s, "featureImportances")]


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``df`` with the prediction. For a model of many trees the rows are dealt to all cores first: a table read from few
    row groups would be scored by as few."""
    if sum(s.getNumTrees for s in tree_stages(model)) >= MANY_TREES:
        session = df.sparkSession
        df = df.repartition(max(session.sparkContext.defaultParallelism, int(session.conf.get("spark.sql.shuffle.partitions"))))
    return model.transform(df).drop("features")


def evaluate(model: PipelineModel, df: DataFrame, target: str = TARGET) -> DataFrame:
    return M.regression_metrics(predict(model, df), target, PRED_COL)


def folded(df: DataFrame, features: list[str], n_splits: int, target: str = TARGET) -> DataFrame:
    """(features, target, part) for expanding time folds: fold i learns from the parts 0 to i and is judged on part i + 1.

    Only the (time, id) keys are ranked; a row's part follows from comparisons with the cutoff keys at the folds'
    boundary ranks, so one narrow table serves all folds (and all trials of a search).
    """
    cut = RankCutoffs(df, ["order_timestamp", "order_id"])
    s = cut.n // (n_splits + 1)
    starts = [cut.n - (n_splits - i) * s for i in range(n_splits)]
    cut.fetch(starts)
    part = F.lit(n_splits)
    for i in reversed(range(n_splits)):
        part = F.when(cut.at_or_before(starts[i]), F.lit(i)).otherwise(part)
    return assembled(df.withColumn("part", part), features, target, "part")[1]


def fit_folds(parts: DataFrame, params: dict, n_splits: int, target: str = TARGET, seed: int = 42, early_stopping: bool = False) -> list[tuple]:
    """(fold, mae, rmse, r2) of every fold of a ``folded`` table (cache it), all folds at once: each is a series of small
    jobs that leave most of a cluster idle, so that they are submitted from a thread each. A stopped fold's metrics are
    those of its trees up to the best one, which need not be fitted on their own for it."""
    def one(i: int) -> tuple:
        train, val = parts.filter(F.col("part") <= i), parts.filter(F.col("part") == i + 1)
        if early_stopping:
            m, squared, n = _grown(train, val, params, target, seed, FOLD_CHECKPOINT)
            mae, mse, var = m.evaluateEachIteration(val, "absolute")[n - 1], squared[n - 1], val.agg(F.var_pop(target)).first()[0]
            return i, float(mae), math.sqrt(mse), 1.0 - mse / var if var else None
        m = _gbt(params, target, seed, FOLD_CHECKPOINT).fit(train)
        r = M.regression_metrics(m.transform(val), target, PRED_COL, with_percentiles=False).first()
        return i, float(r["mae"]), float(r["rmse"]), float(r["r2"]) if r["r2"] is not None else None

    with ThreadPoolExecutor(max_workers=n_splits) as pool:
        return list(pool.map(inheritable_thread_target(parts.sparkSession)(one), range(n_splits)))


def fold_metrics(df: DataFrame, features: list[str], params: dict, n_splits: int = 5, target: str = TARGET,
                 seed: int = 42, early_stopping: bool = False) -> DataFrame:
    """MAE/RMSE/R2 per expanding time fold (with ``early_stopping`` on the fold's own validation rows, as the published
    search does)."""
    parts = spread(folded(df, features, n_splits, target), target, n_splits * SPREAD_ROWS, cut=True)
    try:
        rows = fit_folds(parts, params, n_splits, target, seed, early_stopping)
    finally:
        parts.unpersist()
    return df.sparkSession.createDataFrame(rows, "fold long, mae double, rmse double, r2 double")  # one row per fold


def cross_validate_time(df: DataFrame, features: list[str], params: dict, n_splits: int = 5, target: str = TARGET) -> tuple[DataFrame, DataFrame]:
    fm = fold_metrics(df, features, params, n_splits, target)
    return fm, M.cv_summary(fm)


def sample_params(n_trials: int, seed: int = 42, space: dict = SEARCH_SPACE) -> list[dict]:
    """Seeded random search over the ranges (log-uniform where marked)."""
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(n_trials):
        p = {}
        for name, (lo, hi, log) in space.items():
            if isinstance(lo, int) and isinstance(hi, int) and not log:
                p[name] = int(rng.integers(lo, hi + 1))
            elif log:
                p[name] = float(np.exp(rng.uniform(np.log(lo), np.log(hi))))
            else:
                p[name] = float(rng.uniform(lo, hi))
        out.append(p)
    return out


def tune_hyperparameters(df: DataFrame, features: list[str], n_trials: int = 50, timeout_s: float | None = None,
                         n_splits: int = 5, parallelism: int = 2, seed: int = 42, space: dict = SEARCH_SPACE,
                         target: str = TARGET) -> tuple[DataFrame, dict]:
    """Minimise mean fold MAE over seeded random trials; a time budget holds only where one is given, and
    the trials that it leaves out are rows without an MAE.

    All trials share one cached table of folds; ``parallelism`` trials run at once, each with all its folds at once.
    """
    trials = sample_params(n_trials, seed, space)
    parts = spread(folded(df, features, n_splits, target), target, n_splits * SPREAD_ROWS, cut=True)
    start = time.time()
    results = []

    def run(i_p):
        i, p = i_p
        if timeout_s is not None and time.time() - start > timeout_s:
            return i, p, None
        found = fit_folds(parts, gbt_params(**p), n_splits, target, seed, early_stopping=True)
        return i, p, sum(r[1] for r in found) / len(found)

    try:
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            for i, p, mae in pool.map(inheritable_thread_target(df.sparkSession)(run), list(enumerate(trials))):
                results.append((i, *[float(p[k]) for k in space], None if mae is None else float(mae)))
    finally:
        parts.unpersist()
    schema = T.StructType([T.StructField("trial", T.LongType())] + [T.StructField(k, T.DoubleType()) for k in space]
                          + [T.StructField("mean_mae", T.DoubleType())])
    table = df.sparkSession.createDataFrame(results, schema)  # one row per trial
    best = min((r for r in results if r[-1] is not None), key=lambda r: r[-1], default=None)
    best_params = dict(zip(space, best[1:-1])) if best else {}
    return table, best_params


def feature_importance(model: PipelineModel, features: list[str], spark: SparkSession) -> DataFrame:
    """Importance per feature from the fitted trees, sorted descending (one row per feature)."""
    stages = tree_stages(model)
    trees = [s.getNumTrees for s in stages]
    imp = np.average([s.featureImportances.toArray() for s in stages], axis=0, weights=trees).tolist()
    return spark.createDataFrame(list(zip(features, [float(x) for x in imp])), "feature string, importance double") \
        .orderBy(F.desc("importance"), "feature")


def top_k_importance(importance: DataFrame, k: int = 10) -> DataFrame:
    return importance.orderBy(F.desc("importance"), "feature").limit(k)


def scoring_model(prep: Prepared, model: PipelineModel) -> PipelineModel:
    """One PipelineModel: features -> train-median fill -> assembler -> trees."""
    return PipelineModel(stages=[*prep.feature_model.stages, prep.imputer, *model.stages])


@dataclass
class Report:
    metrics: DataFrame
    hour_segments: DataFrame
    dow_segments: DataFrame
    extra: dict = field(default_factory=dict)


def evaluation_report(model: PipelineModel, prep: Prepared, target: str = TARGET) -> Report:
    """Train and test metrics (one row each), hour and weekday segments of the test set."""
    tr = predict(model, prep.train)
    te = predict(model, prep.test)
    mt = M.regression_metrics(tr, target, PRED_COL).withColumn("split", F.lit("train"))
    ms = M.regression_metrics(te, target, PRED_COL).withColumn("split", F.lit("test"))
    metrics = mt.unionByName(ms).withColumns({
        "n_features": F.lit(len(prep.features)),
        "model_type": F.lit(type(tree_stages(model)[-1]).__name__),
    })
    return Report(metrics, M.segment_metrics(te, "hour_of_day", target, PRED_COL),
                  M.segment_metrics(te, "day_of_week", target, PRED_COL))


def target_met(metrics_row: DataFrame, target_mae: float = MAE_TARGET_MINUTES) -> DataFrame:
    return metrics_row.select("mae", (F.col("mae") < target_mae).alias("target_met"))

"""Drift between a reference and a current data set.

Statistics (published definitions; thresholds are parameters):
  numeric      Wasserstein-1 distance divided by the reference (population) std;
               also two-sample KS statistic with its asymptotic p-value.
  categorical  Jensen-Shannon distance (natural log) and PSI.
The two sets are tagged and unpivoted into (column, value, side); counts per
distinct value come from a map-side-combined aggregation, cumulative
distributions from the skew-safe ``running_sums`` - no column is ever held
whole by one task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import (
    DATASET_DRIFT_SHARE,
    DRIFT_CATEGORICAL_THRESHOLD,
    DRIFT_NUMERIC_THRESHOLD,
    RETRAIN_DRIFT_SHARE,
    RETRAIN_MAE_THRESHOLD,
)
from .metrics import attach_row
from .rank import running_sums

PSI_EPS = 1e-4
KS_TERMS = 100
_VALUE = ("column", "kind", "dvalue", "svalue")


def tagged_union(ref: DataFrame, cur: DataFrame, cols: list[str], tag: str = "is_ref") -> DataFrame:
    """Reference and current rows as one table with a side flag."""
    return (ref.select(*cols).withColumn(tag, F.lit(True))
            .unionByName(cur.select(*cols).withColumn(tag, F.lit(False))))


def _long_values(df: DataFrame, numeric: list[str], categorical: list[str], *keep: str) -> DataFrame:
    """One row per value: (column, kind, dvalue, svalue) and ``keep``, with one 'rows' entry for every input row."""
    entries = [F.struct(F.lit(c).alias("column"), F.lit("numeric").alias("kind"), F.col(c).cast("double").alias("dvalue"),
                        F.lit(None).cast("string").alias("svalue")) for c in numeric]
    entries += [F.struct(F.lit(c).alias("column"), F.lit("categorical").alias("kind"),
                         F.lit(None).cast("double").alias("dvalue"), F.col(c).cast("string").alias("svalue"))
                for c in categorical]
    entries.append(F.struct(F.lit("__rows__").alias("column"), F.lit("rows").alias("kind"),
                            F.lit(0.0).alias("dvalue"), F.lit(None).cast("string").alias("svalue")))
    long = df.select(*keep, F.explode(F.array(*entries)).alias("kv")).select("kv.*", *keep)
    return long.filter(F.col("dvalue").isNotNull() | F.col("svalue").isNotNull())


def value_counts(ref: DataFrame, cur: DataFrame, numeric: list[str], categorical: list[str] = ()) -> DataFrame:
    """Reference/current counts per distinct value of every column, in one pass over each side.

    Rows: (column, kind, dvalue, svalue, nr, nc) with kind 'numeric' (value in
    ``dvalue``), 'categorical' (``svalue``) and one 'rows' entry holding the
    side sizes. The aggregation combines map-side, so hot values shrink before
    the shuffle. The result is checkpointed: every statistic below reads it,
    never the sources again.
    """
    numeric, categorical = list(numeric), list(categorical)
    long = _long_values(tagged_union(ref, cur, numeric + categorical), numeric, categorical, "is_ref")
    vc = long.groupBy(*_VALUE).agg(
        F.count_if(F.col("is_ref")).alias("nr"), F.count_if(~F.col("is_ref")).alias("nc"))
    return vc.checkpoint(eager=True)


def reference_counts(ref: DataFrame, numeric: list[str], categorical: list[str] = ()) -> DataFrame:
    """The reference's side of ``value_counts`` (column, kind, dvalue, svalue, n), to be stored and used many times."""
    return _long_values(ref, list(numeric), list(categorical)).groupBy(*_VALUE).agg(F.count(F.lit(1)).alias("n"))


def value_counts_with(stored: DataFrame, cur: DataFrame, numeric: list[str], categorical: list[str] = ()) -> DataFrame:
    """``value_counts`` of a reference known by its ``reference_counts`` and of current rows."""
    new = _long_values(cur, list(numeric), list(categorical))
    both = (stored.select(*_VALUE, F.col("n").alias("nr"), F.lit(0).cast("long").alias("nc"))
            .unionByName(new.select(*_VALUE, F.lit(0).cast("long").alias("nr"), F.lit(1).cast("long").alias("nc"))))
    return both.groupBy(*_VALUE).agg(F.sum("nr").alias("nr"), F.sum("nc").alias("nc")).checkpoint(eager=True)


def ks_pvalue(d: Column, n_ref: Column, n_cur: Column) -> Column:
    """Asymptotic two-sided KS p-value Q(lambda), lambda = (en + 0.12 + 0.11/en) * D.

    Q = 2 sum (-1)^(j-1) exp(-2 j^2 lambda^2) for lambda >= 1.18, and the
    equivalent 1 - sqrt(2 pi)/lambda sum exp(-(2j-1)^2 pi^2 / (8 lambda^2))
    below it (the alternating series does not converge near 0); Q(0) = 1.
    """
    en = F.sqrt(n_ref * n_cur / (n_ref + n_cur))
    lam = (en + 0.12 + 0.11 / en) * d
    seq = F.sequence(F.lit(1), F.lit(KS_TERMS))
    large = 2.0 * F.aggregate(seq, F.lit(0.0),
                              lambda acc, j: acc + F.pow(F.lit(-1.0), j - 1) * F.exp(-2.0 * j * j * lam * lam))
    small = 1.0 - F.try_divide(F.lit(math.sqrt(2 * math.pi)), lam) * F.aggregate(
        seq, F.lit(0.0), lambda acc, j: acc + F.exp(-F.pow(2.0 * j - 1, 2) * (math.pi ** 2) / (8.0 * lam * lam)))
    q = F.when(lam <= 0, F.lit(1.0)).when(lam < 1.18, small).otherwise(large)
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), q))


def log_gamma(z: Column) -> Column:
    """Logarithm of the gamma function of a positive number: Stirling's series, ten places up."""
    up = z + 10.0
    series = (up - 0.5) * F.log(up) - up + 0.5 * math.log(2 * math.pi) + 1.0 / (12.0 * up) - 1.0 / (360.0 * up * up * up) + 1.0 / (1260.0 * F.pow(up, 5))
    return F.aggregate(F.sequence(F.lit(0), F.lit(9)), series, lambda acc, j: acc - F.log(z + j))


def chi2_pvalue(statistic: Column, degrees: Column) -> Column:
    """Upper tail of the chi-square distribution, the regularised incomplete gamma function Q(degrees / 2, statistic / 2).

    1 - Q is the series x^a e^-x / gamma(a + 1) * (1 + x / (a + 1) + x^2 / ((a + 1)(a + 2)) + ...). Far above the mean
    (12 deviations and 60) the tail is below 1e-12 and given as 0. No degrees of freedom: 1.
    """
    a, x = degrees / 2.0, statistic / 2.0
    far = x > a + 12.0 * F.sqrt(a) + 60.0
    near = F.when(far | (x <= 0) | (degrees < 1), F.lit(1.0)).otherwise(x)
    terms = F.sequence(F.lit(1), F.ceil(near + 12.0 * F.sqrt(near + 1.0) + 60.0).cast("int"))
    step = F.struct(F.lit(1.0).alias("t"), F.lit(1.0).alias("s"))

    def add(acc: Column, j: Column) -> Column:
        t = acc["t"] * near / (a + j)
        return F.struct(t.alias("t"), (acc["s"] + t).alias("s"))

    total = F.aggregate(terms, step, add, lambda acc: acc["s"])
    below = F.exp(a * F.log(near) - near - log_gamma(a + 1.0)) * total
    return F.when((degrees < 1) | (x <= 0), F.lit(1.0)).when(far, F.lit(0.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), 1.0 - below)))


def numeric_drift_from_counts(vc: DataFrame, threshold: float = DRIFT_NUMERIC_THRESHOLD) -> DataFrame:
    """W1 (normalised by the reference population std), KS D and p-value from value counts.

    With F, G the cumulative fractions at each distinct value x_i (ascending) and
    D_i = |F_i - G_i|: W1 = sum_i x_i (D_(i-1) - D_i), KS = max_i D_i.
    """
    num = vc.filter(F.col("kind") == "numeric").select("column", F.col("dvalue").alias("value"), "nr", "nc")
    cum = running_sums(num, ["value"], ["nr", "nc"], ["column"], total_suffix="_tot")
    n_ref, n_cur = F.col("nr_tot"), F.col("nc_tot")
    d = F.abs(F.col("nr_cum") / n_ref - F.col("nc_cum") / n_cur)
    d_prev = F.abs((F.col("nr_cum") - F.col("nr")) / n_ref - (F.col("nc_cum") - F.col("nc")) / n_cur)
    stats = cum.groupBy("column").agg(
        F.max("nr_tot").alias("n_ref"), F.max("nc_tot").alias("n_cur"),
        F.sum(F.col("value") * (d_prev - d)).alias("wasserstein"),
        F.max(d).alias("ks_statistic"),
        F.try_divide(F.sum(F.col("nr") * F.col("value")), F.sum("nr")).alias("_mean"),
    )
    # reference population std, two-pass over the (small) value-count table
    means = stats.select("column", "_mean")
    dev = num.join(F.broadcast(means), "column").groupBy("column").agg(  # one row per column
        F.sqrt(F.try_divide(F.sum(F.col("nr") * F.pow(F.col("value") - F.col("_mean"), 2)), F.sum("nr"))).alias("ref_std"))
    out = stats.join(F.broadcast(dev), "column", "left")  # one row per column
    score = F.try_divide(F.col("wasserstein"), F.col("ref_std"))
    return out.select(
        "column", F.lit("numeric").alias("kind"), F.lit("wasserstein").alias("stattest"),
        F.col("n_ref").cast("long").alias("n_ref"), F.col("n_cur").cast("long").alias("n_cur"),
        "wasserstein", "ref_std", score.alias("drift_score"), "ks_statistic",
        ks_pvalue(F.col("ks_statistic"), F.col("n_ref").cast("double"), F.col("n_cur").cast("double")).alias("ks_pvalue"),
        F.coalesce(score > threshold, F.col("wasserstein") > 0).alias("drift_detected"),
    )


def categorical_drift_from_counts(vc: DataFrame, threshold: float = DRIFT_CATEGORICAL_THRESHOLD) -> DataFrame:
    """Jensen-Shannon distance (the drift score), PSI and the chi-square test of equal shares from value counts.

    The chi-square statistic compares both sides' counts with those that common shares would give; a side without rows
    gives a null statistic and p-value."""
    cat = vc.filter(F.col("kind") == "categorical").select("column", F.col("svalue").alias("value"), "nr", "nc")
    tot = cat.groupBy("column").agg(F.sum("nr").alias("n_ref"), F.sum("nc").alias("n_cur"))
    j = cat.join(F.broadcast(tot), "column")  # one row per column
    p = F.col("nr") / F.col("n_ref")
    q = F.col("nc") / F.col("n_cur")
    m = (p + q) / 2
    kl_p = F.when(p > 0, p * F.log(p / m)).otherwise(F.lit(0.0))
    kl_q = F.when(q > 0, q * F.log(q / m)).otherwise(F.lit(0.0))
    pe, qe = F.greatest(p, F.lit(PSI_EPS)), F.greatest(q, F.lit(PSI_EPS))
    agg = j.groupBy("column", "n_ref", "n_cur").agg(
        F.sqrt(F.greatest(F.lit(0.0), 0.5 * F.sum(kl_p) + 0.5 * F.sum(kl_q))).alias("js_distance"),
        F.sum((pe - qe) * F.log(pe / qe)).alias("psi"),
        # both sides' squared deviations from the expected counts, over the expected counts
        F.sum(F.try_divide(F.pow(F.col("nr") * F.col("n_cur") - F.col("nc") * F.col("n_ref"), F.lit(2.0)),
                           (F.col("nr") + F.col("nc")).cast("double") * F.col("n_ref") * F.col("n_cur"))).alias("chi2_statistic"),
        (F.count(F.lit(1)) - 1).alias("chi2_df"),
    )
    return agg.select(
        "column", F.lit("categorical").alias("kind"), F.lit("jensenshannon").alias("stattest"),
        F.col("n_ref").cast("long").alias("n_ref"), F.col("n_cur").cast("long").alias("n_cur"),
        F.col("js_distance").alias("drift_score"), "psi", (F.col("js_distance") > threshold).alias("drift_detected"),
        "chi2_statistic", "chi2_df", F.when(F.col("chi2_statistic").isNotNull(), chi2_pvalue(
            F.col("chi2_statistic"), F.col("chi2_df").cast("double"))).alias("chi2_pvalue"),
    )


def column_drift_numeric(ref: DataFrame, cur: DataFrame, cols: list[str],
                         threshold: float = DRIFT_NUMERIC_THRESHOLD) -> DataFrame:
    """Per column: W1, reference std, normalised W1 (the drift score), KS D and p-value, flag."""
    return numeric_drift_from_counts(value_counts(ref, cur, cols), threshold)


def column_drift_categorical(ref: DataFrame, cur: DataFrame, cols: list[str],
                             threshold: float = DRIFT_CATEGORICAL_THRESHOLD) -> DataFrame:
    """Per column: Jensen-Shannon distance (the drift score), PSI, flag."""
    return categorical_drift_from_counts(value_counts(ref, cur, [], cols), threshold)


def _drift_table(vc: DataFrame, numeric: list[str], categorical: list[str]) -> DataFrame:
    cols = ["column", "kind", "stattest", "drift_score", "drift_detected"]
    parts = []
    if numeric:
        parts.append(numeric_drift_from_counts(vc).select(*cols))
    if categorical:
        parts.append(categorical_drift_from_counts(vc).select(*cols))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def column_drift(ref: DataFrame, cur: DataFrame, numeric: list[str], categorical: list[str]) -> DataFrame:
    """Both kinds in one long table: column, kind, stattest, drift_score, drift_detected.

    One value-count pass over each side serves every column.
    """
    return _drift_table(value_counts(ref, cur, numeric, categorical), numeric, categorical)


def _side_sizes(vc: DataFrame) -> DataFrame:
    return vc.filter(F.col("kind") == "rows").select(
        F.col("nr").alias("n_reference_samples"), F.col("nc").alias("n_current_samples"))


def dataset_drift(ref: DataFrame, cur: DataFrame, numeric: list[str], categorical: list[str],
                  share: float = DATASET_DRIFT_SHARE) -> DataFrame:
    """One row: drift flag (share of drifted columns >= share), share, count, the drifted columns' names and, as
    ``drifted``, an array of (column, score, test) in the order of the names, sizes."""
    return dataset_drift_from_counts(value_counts(ref, cur, numeric, categorical), numeric, categorical, share)


def dataset_drift_from_counts(vc: DataFrame, numeric: list[str], categorical: list[str],
                              share: float = DATASET_DRIFT_SHARE) -> DataFrame:
    """``dataset_drift`` over value counts that are there already."""
    cd = _drift_table(vc, numeric, categorical)
    row = cd.agg(
        F.avg(F.col("drift_detected").cast("double")).alias("drift_share"),
        F.count_if("drift_detected").alias("n_drifted_columns"),
        F.count(F.lit(1)).alias("n_columns"),
        F.array_join(F.array_sort(F.collect_list(F.when(F.col("drift_detected"), F.col("column")))), ",").alias("drifted_columns"),
        F.array_sort(F.collect_list(F.when(F.col("drift_detected"), F.struct(
            "column", F.col("drift_score").alias("score"), F.col("stattest").alias("test"))))).alias("drifted"),
    ).withColumn("drift_detected", F.col("drift_share") >= share)
    return attach_row(row, _side_sizes(vc))


def target_drift(ref: DataFrame, cur: DataFrame, target: str) -> DataFrame:
    """Numeric drift of the target plus reference/current mean and sample std.

    An absent target yields an empty frame (no drift evaluated)."""
    if target not in ref.columns or target not in cur.columns:
        return ref.sparkSession.createDataFrame([], "target_drift_detected boolean")
    d = column_drift_numeric(ref, cur, [target]).select(
        F.col("drift_detected").alias("target_drift_detected"), F.col("drift_score"), "stattest")
    d = attach_row(d, ref.agg(F.avg(target).alias("reference_mean"), F.stddev_samp(target).alias("reference_std")))
    return attach_row(d, cur.agg(F.avg(target).alias("current_mean"), F.stddev_samp(target).alias("current_std")))


def prediction_quality(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """MAE, RMSE, MAPE, R2, mean error (predicted - actual), n."""
    e = F.col(predicted) - F.col(actual)
    y = F.col(actual)
    return df.agg(
        F.avg(F.abs(e)).alias("mae"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        (F.avg(F.abs(e) / F.greatest(F.abs(y), F.lit(2.220446049250313e-16))) * 100.0).alias("mape"),
        (F.lit(1.0) - F.try_divide(F.sum(e * e), F.var_pop(y) * F.count(F.lit(1)))).alias("r2"),
        F.avg(e).alias("me"),
        F.count(F.lit(1)).alias("n_samples"),
    )


def drift_test_suite(column_results: DataFrame) -> DataFrame:
    """One test per column (passes when not drifted): totals and pass rate."""
    return column_results.agg(
        F.count(F.lit(1)).alias("n_tests"),
        F.count_if(~F.col("drift_detected")).alias("n_passed"),
        F.count_if(F.col("drift_detected")).alias("n_failed"),
    ).select("n_tests", "n_passed", "n_failed",
             F.coalesce(F.try_divide(F.col("n_passed"), F.col("n_tests")), F.lit(0.0)).alias("pass_rate"),
             (F.col("n_failed") == 0).alias("all_tests_passed"))


def monitoring_report(ref: DataFrame, cur: DataFrame, numeric: list[str], categorical: list[str],
                      target: str | None = None, predicted: str | None = None) -> DataFrame:
    """One flat row: data drift, target drift (if present), prediction quality (if present), suite.

    Data drift and target drift share one value-count pass over each side.
    """
    has_target = bool(target) and target in ref.columns and target in cur.columns
    counted = list(numeric) + ([target] if has_target and target not in numeric else [])
    vc = value_counts(ref, cur, counted, categorical)
    cols = ["column", "kind", "stattest", "drift_score", "drift_detected"]
    num = numeric_drift_from_counts(vc) if counted else None
    parts = []
    if numeric:
        parts.append(num.filter(F.col("column").isin(list(numeric))).select(*cols))
    if categorical:
        parts.append(categorical_drift_from_counts(vc).select(*cols))
    cd = parts[0]
    for p in parts[1:]:
        cd = cd.unionByName(p)
    row = cd.agg(
        F.avg(F.col("drift_detected").cast("double")).alias("drift_share"),
        F.count_if("drift_detected").alias("n_drifted_columns"),
        F.count(F.lit(1)).alias("n_tests"),
        F.count_if(~F.col("drift_detected")).alias("n_passed"),
    ).withColumn("drift_detected", F.col("drift_share") >= DATASET_DRIFT_SHARE)
    if has_target:
        t = num.filter(F.col("column") == target).select(
            F.col("drift_detected").alias("target_drift_detected"), F.col("drift_score").alias("target_drift_score"))
        row = attach_row(row, t)
    else:
        row = row.withColumn("target_drift_detected", F.lit(False))
    if has_target and predicted and predicted in cur.columns:
        row = attach_row(row, prediction_quality(cur, target, predicted).select("mae", "rmse", "r2"))
    else:
        row = row.withColumns({"mae": F.lit(None).cast("double"), "rmse": F.lit(None).cast("double"),
                               "r2": F.lit(None).cast("double")})
    return row


def should_retrain(report: DataFrame, mae_threshold: float = RETRAIN_MAE_THRESHOLD,
                   drift_threshold: float = RETRAIN_DRIFT_SHARE) -> DataFrame:
    """Reasons (drift share above threshold, target drift, MAE above threshold); any -> retrain."""
    share = F.coalesce(F.col("drift_share"), F.lit(0.0))
    mae = F.coalesce(F.col("mae"), F.lit(0.0))
    reasons = F.array_compact(F.array(
        F.when(share > drift_threshold, F.lit("high data drift")),
        F.when(F.coalesce(F.col("target_drift_detected"), F.lit(False)), F.lit("target drift detected")),
        F.when(mae > mae_threshold, F.lit("high MAE")),
    ))
    return report.select(F.size(reasons).cast("long").alias("n_reasons"), (F.size(reasons) > 0).alias("should_retrain"),
                         F.array_join(reasons, "; ").alias("reasons"))

"""Tier 2: registered queries against their DuckDB oracle SQL on sf0.01.

The fast subset runs by default; DROPCAST_FULL_ORACLE=1 runs every query.
"""
import os
import sys

import pytest

from conftest import ROOT, SF001, SF01

sys.path.insert(0, os.path.join(ROOT, "tools"))
import __spark_entry__ as E  # noqa: E402
from oracle_check import compare, duck  # noqa: E402

FAST = ["geodesic_km", "bearing_deg", "temporal_parts", "component_eta", "regression_metrics", "segment_metrics",
        "time_series_folds", "clean_orders", "feature_pipeline", "lag_features", "dataset_drift", "request_validity",
        "stream_score_orders", "prediction_histograms", "join_group_stats", "error_cdf", "time_split",
        "error_percentiles", "stream_feedback_join"]
NAMES = sorted(E.oracle_sql()) if os.environ.get("DROPCAST_FULL_ORACLE") else FAST


def test_every_query_has_a_callable():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "mae" in df.columns


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, con, name, E.queries()[name], E.oracle_sql()[name], SF01)
    assert res[1] == "OK", res

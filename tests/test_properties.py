"""Property-based checks of exact selection (global percentiles) against numpy."""
import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from dropcast.operators import rank as R

values = st.lists(st.one_of(st.integers(-5, 5).map(float), st.floats(-1e6, 1e6, allow_nan=False, width=32)),
                  min_size=1, max_size=60)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(vals=values, p=st.sampled_from([0.0, 0.1, 0.25, 0.5, 0.9, 1.0]))
def test_global_percentile_equals_numpy(spark, monkeypatch, vals, p):
    monkeypatch.setattr(R, "REFINE_BUCKETS", 4)
    monkeypatch.setattr(R, "REFINE_FINAL_ROWS", 3)
    df = spark.createDataFrame([(float(v),) for v in vals], "v double")
    got = R.exact_percentiles(df, "v", [p], names=["q"]).first().q
    assert got == pytest.approx(float(np.percentile(np.array(vals, dtype=float), p * 100)), rel=1e-12, abs=1e-12)

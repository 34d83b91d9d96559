"""Session contract: the shared checkpoint folder is read from the session, scratch lives under it."""
from dropcast.session import ensure_checkpoint_dir, scratch_path


def test_checkpoint_dir_is_reused_and_scratch_is_below_it(spark):
    ck = ensure_checkpoint_dir(spark)
    assert ck and ensure_checkpoint_dir(spark) == ck  # an existing setting is never replaced
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(ck.rstrip("/")) and b.startswith(ck.rstrip("/"))


def test_cli_runs_clean_job(spark, tmp_path, monkeypatch):
    from dropcast.plans import jobs as J
    from dropcast.sources import fixtures as FX

    from conftest import SF01

    raw = str(tmp_path / "raw")
    FX.deliveries_raw(spark, SF01).write.parquet(raw)
    monkeypatch.setattr("dropcast.session.build_session", lambda *a, **k: spark)
    J.main(["clean", "--input", raw, "--output", str(tmp_path / "out")])
    assert spark.read.parquet(str(tmp_path / "out" / "orders")).count() == 9900

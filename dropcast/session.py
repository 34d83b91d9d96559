"""Session helpers: builder for local runs, shared checkpoint folder, scratch paths."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession


def _launcher_settings() -> dict[str, str]:
    """What spark-submit set; empty where Python starts the JVM itself."""
    if "PYSPARK_GATEWAY_PORT" not in os.environ:
        return {}
    SparkContext._ensure_initialized()
    return dict(SparkConf().getAll())


def build_session(master: str | None = None, shuffle_partitions: int = 8, app: str = "dropcast") -> SparkSession:
    """Session for tests, bench and local runs. On a cluster the launcher's settings win."""
    launched = _launcher_settings()
    builder = SparkSession.builder.appName(app)
    if "spark.master" not in launched:
        builder = builder.master(master or os.environ.get("DROPCAST_MASTER", "local[8]"))
        for key, value in (("spark.sql.shuffle.partitions", str(shuffle_partitions)),
                           ("spark.driver.memory", os.environ.get("DROPCAST_DRIVER_MEMORY", "8g"))):
            if key not in launched:
                builder = builder.config(key, value)
    spark = (
        builder
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.checkpoint.compress", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the session.

    The cluster names it in ``spark.checkpoint.dir``; only when nothing is
    set (tests, local runs) a private folder is created.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="dropcast-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder (visible to all executors)."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/dropcast-{name}-{uuid.uuid4().hex[:12]}"

"""Session helpers: a local session for tests/bench and the checkpoint directory."""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "greenlane") -> SparkSession:
    """A local session configured like the cluster defaults we rely on (AQE on, UTC, no UI)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # remove reliable checkpoint files once their DataFrames are garbage collected
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("GREENLANE_DRIVER_MEMORY", "8g"))
        # Python call-site capture for error messages costs several JVM round trips per
        # DataFrame/Column call while a plan is built; plans here are built from library code.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory of this session.

    The cluster names a shared folder in ``spark.checkpoint.dir``; we only read it.
    A private temporary folder is created solely for a local-mode session that has
    none configured (tests); on a cluster a missing setting is an error, because a
    machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running jobs that cut lineage")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="greenlane-ckpt-"))
    return sc.getCheckpointDir()


#: Spark removes an execution's shuffle files when it ends, not when the driver's heap happens to be collected.
_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession):
    """Within it, a query's shuffle files go as soon as it has run: for jobs of many writes, none of which reads another's shuffle."""
    before = spark.conf.get(_FREED, None)
    spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREED)
        else:
            spark.conf.set(_FREED, before)

"""SparkSession construction and shared-storage helpers.

Cluster settings (checkpoint dir, shuffle partitions, AQE) are read from the
session when present; local defaults are applied only where a key is unset,
which is the situation in tests and in the local benchmark.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Defaults for a local session. On a cluster the submitter's settings win.
LOCAL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.shuffle.partitions": "8",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Checkpointed intermediates are dropped once no longer referenced.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Partitions fed by the Parquet scan: 128 MiB splits keep a task's input
    # well under executor memory at any table size.
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
}


def get_spark(master: str | None = None, app: str = "tradescope", **conf: str) -> SparkSession:
    """Return the active session, or build a local one with our defaults."""
    active = SparkSession.getActiveSession()
    if active is not None:
        ensure_checkpoint_dir(active)
        return active
    builder = SparkSession.builder.appName(app)
    if master or not os.environ.get("SPARK_MASTER"):
        builder = builder.master(master or f"local[{os.environ.get('BENCH_CPUS', '8')}]")
    for key, value in {**LOCAL_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def is_local(master: str) -> bool:
    """Whether driver and executors are one process (``local-cluster`` is not)."""
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint directory named by the cluster.

    ``spark.checkpoint.dir`` is read from the session. Where it is unset, a
    local session gets a scratch directory; on a cluster every executor would
    write to its own disk there, so that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not current:
        if not is_local(sc.master):
            raise RuntimeError(f"spark.checkpoint.dir must name a shared folder with master {sc.master}")
        current = tempfile.mkdtemp(prefix="tradescope-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path under the cluster's shared checkpoint folder."""
    return os.path.join(ensure_checkpoint_dir(spark), *parts)

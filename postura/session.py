"""Session construction for tests, the bench and the CLI runner.

On a cluster the session comes from the platform; this only fills in settings that are
unset. No report cuts its lineage, so no checkpoint folder is set.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # a report is some hundred Column calls; looking up the Python line of each one takes longer than running a small report
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


# Settings for the 100 TB deployment, applied by the runner only where the cluster has not set
# them. Many initial shuffle partitions, coalesced by AQE towards ~256 MB each, keep every
# task's share of a shuffle spillable and small; skewed join partitions are split at runtime.
CLUSTER_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    # split a hot join partition even when that costs an extra shuffle downstream
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
}


def apply_cluster_defaults(spark: SparkSession) -> dict[str, str]:
    """Set each CLUSTER_DEFAULTS entry the launch configuration does not already name."""
    launched = spark.sparkContext.getConf()
    applied = {}
    for key, value in CLUSTER_DEFAULTS.items():
        if not launched.contains(key):
            spark.conf.set(key, value)
            applied[key] = value
    return applied


def local_session(cores: int = 8, shuffle_partitions: int | None = None, app: str = "postura") -> SparkSession:
    """A local session for tests and the bench (UI off, AQE on, session zone UTC)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.driver.memory", os.environ.get("POSTURA_DRIVER_MEMORY", "16g"))
    )
    for k, v in DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark

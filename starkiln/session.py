"""Session defaults the library relies on.

The library never builds its own session in library code paths; callers pass
one in.  ``configure`` applies the settings the semantics depend on (UTC, ANSI,
dynamic partition overwrite, AQE) to an existing session, and ``local_session``
is a convenience for tests and the bench.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the operators depend on for correct results.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

# Settings for throughput at scale; safe to override per cluster.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # larger post-shuffle partitions: rebalanced partitioned writes produce ~100 MB Parquet files
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.parquet.filterPushdown": "true",
    # a side is broadcast when its files are this small, or when its *measured* shuffle output is
    "spark.sql.autoBroadcastJoinThreshold": "10MB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for k, v in {**SCALE_CONF, **REQUIRED_CONF}.items():
        spark.conf.set(k, v)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "starkiln",
                  warehouse_dir: str | None = None, event_log_dir: str | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("STARKILN_DRIVER_MEMORY", "16g"))
    )
    if warehouse_dir:
        builder = builder.config("spark.sql.warehouse.dir", warehouse_dir)
    if event_log_dir:
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log_dir)
    for k, v in {**SCALE_CONF, **REQUIRED_CONF}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return configure(spark)


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder named by the cluster in ``spark.checkpoint.dir``.

    Durable intermediate results (stable deltas, rewritten table versions,
    streaming checkpoints) live below it so a lost executor never loses them.
    """
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        raise RuntimeError("spark.checkpoint.dir is not set; the cluster must name a shared folder")
    spark.sparkContext.setCheckpointDir(d)
    return spark.sparkContext.getCheckpointDir() or d


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the session's checkpoint dir; only a local session (tests) gets a private one when
    it is unset, a cluster must name a shared folder."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d and not spark.sparkContext.getCheckpointDir() and spark.sparkContext.master.split("[")[0] == "local":
        d = tempfile.mkdtemp(prefix="starkiln-ckpt-")
    if d and not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return checkpoint_root(spark)


def scratch_path(spark: SparkSession, *parts: str) -> str:
    root = checkpoint_root(spark).rstrip("/")
    return "/".join([root, "starkiln", *parts])

"""Session defaults.

On a cluster the session is created by the platform and already carries
its own settings; we only fill in what is unset, so a cluster's
``spark.checkpoint.dir``, shuffle partition count or broadcast threshold
always wins over these local defaults.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every query in this package assumes. Time zone: the warehouse
# stores naive UTC (DATETIME2), so the session must not shift timestamps.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# Local-only defaults (tests, bench). A cluster session sets its own.
LOCAL_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "16g",
    # remove reliable checkpoint files once their DataFrame is garbage-collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Dimension sides are broadcast only when Spark measured them below
    # this size (static estimate or AQE runtime statistics).
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
}


def get_session(master: str | None = None, app_name: str = "tramline",
                extra: dict | None = None) -> SparkSession:
    """Return the active session, or build a local one with our defaults."""
    active = SparkSession.getActiveSession()
    if active is not None:
        apply_required_conf(active)
        return active
    builder = SparkSession.builder.appName(app_name)
    builder = builder.master(master or os.environ.get("TRAMLINE_MASTER", "local[8]"))
    for k, v in {**LOCAL_CONF, **REQUIRED_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    ensure_checkpoint_dir(spark)
    return spark


def apply_required_conf(spark: SparkSession) -> None:
    for k, v in REQUIRED_CONF.items():
        if spark.conf.isModifiable(k):  # else keep the cluster's
            spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names, if any."""
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    return spark.conf.get("spark.checkpoint.dir", None)


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; set our own only when unset.

    The fallback (a fresh folder under /tmp) is for a local master only: on
    a cluster a folder of one machine would lose what other machines wrote,
    so there an unset folder is an error.
    """
    d = checkpoint_dir(spark)
    if d:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(d)
        return d
    if not fallback and not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    d = fallback or tempfile.mkdtemp(prefix="tramline-ckpt-", dir="/tmp")
    spark.sparkContext.setCheckpointDir(d)
    spark.conf.set("spark.checkpoint.dir", d)
    return d


MAX_SHUFFLE_PARTITIONS = 20_000


def recommended_conf(input_bytes: int, total_cores: int,
                     target_partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Partition sizing for a cluster run, derived from the input volume.

    Shuffle partitions start at ~input / target size, at least 2 per core and
    at most ``MAX_SHUFFLE_PARTITIONS``: blocks are map tasks times partitions,
    and the driver keeps a size for each, so beyond that partitions grow
    instead (5 GB each if 100 TB were shuffled whole, which aggregates and
    pruned columns do not; sorts spill). AQE coalesces what turns out small
    and splits skewed join partitions. Scans split at 4 times the target from
    10 TB on, which cuts the map tasks likewise.
    """
    initial = max(2 * total_cores, min(MAX_SHUFFLE_PARTITIONS, -(-input_bytes // target_partition_bytes)))
    split = target_partition_bytes * (4 if input_bytes >= 10 * 2**40 else 1)
    return {
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes":
            str(2 * target_partition_bytes),
        # keep the broadcast threshold small and fixed: dimension tables only
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
        # runtime bloom filters prune a huge fact scan by a small filtered side
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    }

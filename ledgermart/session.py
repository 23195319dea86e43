"""Session construction and lineage cuts.

The library never creates its own machine-local scratch space on a cluster:
checkpoints go to ``spark.checkpoint.dir`` as configured for the session
(a shared folder on a cluster).  Only a ``local`` or ``local[...]`` session (one machine, one process) without that
setting (tests) gets a fresh folder under the system temp dir.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # dims above this many bytes are never broadcast by the planner
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    # plan strings of deep lineages are truncated instead of filling the driver
    "spark.sql.maxPlanStringLength": str(1024 * 1024),
    # checkpoint files of lineage cuts are removed once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


# Sizing for a large cluster (about 100 TB of input): many initial shuffle
# partitions that AQE coalesces towards 256 MiB, larger scan splits, and
# skew-join splitting for partitions well above the median.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(64 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(512 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def get_session(
    master: str | None = None,
    app_name: str = "ledgermart",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
    cluster: bool = False,
) -> SparkSession:
    """Build (or reuse) a session with the settings the operators assume.

    ``cluster=True`` adds ``CLUSTER_CONF``; ``spark.checkpoint.dir`` must then
    name a shared folder (it is never invented on a cluster).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if cluster:
        settings.update(CLUSTER_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's shared checkpoint folder.

    Reads ``spark.checkpoint.dir``; only a local-mode session without the
    setting gets a private folder (never on a cluster).
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(
                "spark.checkpoint.dir must name a shared folder on a cluster"
            )
        configured = tempfile.mkdtemp(prefix="ledgermart-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(configured)
    return configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder.

    Survives executor loss (unlike a local checkpoint) and truncates the plan.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written snapshots."""
    return os.path.join(checkpoint_dir(spark), "ledgermart", name)

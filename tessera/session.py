"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins at runtime (broadcast only
# when the measured side is small, split skewed partitions, coalesce tiny ones).
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def get_session(master: str | None = None, app: str = "tessera",
                shuffle_partitions: int | None = None) -> SparkSession:
    """Build (or fetch) a session with the engine defaults applied.

    On a cluster the master and resources come from spark-submit; locally
    (tests, bench) pass ``master='local[8]'``.
    """
    builder = SparkSession.builder.appName(app)
    # Ordered scans checkpoint intermediate frames: delete those files once the
    # frames are garbage-collected (static conf, only effective at start-up).
    builder = builder.config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    if master:
        builder = builder.master(master)
        builder = builder.config("spark.ui.enabled", "false")
        builder = builder.config("spark.ui.showConsoleProgress", "false")
        builder = builder.config("spark.driver.memory", "16g")
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    for k, v in DEFAULT_CONF.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # static conf on an already running session
            pass
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    ``spark.checkpoint.dir`` (set by the cluster) wins; only when it is unset,
    as in local tests, a folder is created here.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        master = sc.master or ""
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="tessera-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()

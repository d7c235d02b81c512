"""Session helpers shared by tests, bench and the pipeline entry points."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings the jobs rely on. Time zone: the reference runs in UTC and keeps timestamps without a
# zone, so day boundaries must not move (timestamp -> date casts in the facts).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # a repeated JSON key keeps its last value when landed responses are parsed (as in Python)
    "spark.sql.variant.allowDuplicateKeys": "true",
}


# Settings for a large cluster (not applied by ``build_session``; pass as ``extra`` or put them in
# the cluster defaults). Shuffles start wide and AQE coalesces them to ~256 MB partitions, so
# the same job fits 1 GB or 100 TB without retuning; skewed join partitions are split.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
    "spark.sql.files.maxPartitionBytes": "256m",
    # a join side is broadcast when its files are below this many bytes
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.parquet.filterPushdown": "true",
    # checkpoints (validated batches, large dimensions) are removed once no longer referenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str = "local[8]", app: str = "pagemart", shuffle_partitions: int = 8,
                  driver_memory: str | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if driver_memory:
        conf["spark.driver.memory"] = driver_memory
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Use the cluster's ``spark.checkpoint.dir`` (a shared folder). Only when it is unset on a
    local master (tests, laptops) take ``fallback`` or a fresh scratch folder; on a cluster an
    unset setting is an error, since a machine-local folder would not survive an executor loss.
    Returns the directory in use."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (dense ids of large "
                               "dimensions checkpoint there)")
        configured = fallback or tempfile.mkdtemp(prefix="pagemart-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()

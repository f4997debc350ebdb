"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on: UTC so unix_timestamp / hour / date are
# stable, AQE for runtime coalescing and skew handling.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(
    master: str = "local[*]",
    app: str = "transitlens",
    shuffle_partitions: int = 8,
    extra: dict | None = None,
) -> SparkSession:
    """Local/test session. On a cluster, use the cluster's own session and
    call :func:`configure` on it instead."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("TRANSITLENS_DRIVER_MEMORY", "8g"))
    )
    for k, v in {**REQUIRED_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the session settings the operators assume (idempotent)."""
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    return spark


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Session settings for a block; those from before come back after it."""
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def tidy_shuffles(spark: SparkSession):
    """For a block of jobs that each write a table: a job's shuffle files go when it ends, not when the driver collects garbage."""
    return settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must already be set to shared storage; only when it is
    unset (tests, a laptop) is a fresh local folder created and registered.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master or ""
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: on a cluster it must name shared "
                               "storage (a machine-local folder would be lost with its executor)")
        d = tempfile.mkdtemp(prefix="transitlens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def cluster_conf(input_bytes: int, executor_cores: int = 4, target_partition_mb: int = 128,
                 max_shuffle_partitions: int = 200_000) -> dict:
    """Settings sized to the input, for a cluster session (apply with spark.conf.set).

    Shuffle partitions start at input / target size (AQE then coalesces the
    small ones and splits skewed join partitions); scan splits use the same
    target, so each task holds ~128 MB of compressed input and its sort and
    hash buffers spill instead of failing. Broadcasts stay at Spark's default
    threshold: the library only hints broadcasts for dimensions whose
    estimated size is bounded (sources.reference.bounded_broadcast).
    """
    target = target_partition_mb * 1024 * 1024
    # capped: map-status metadata grows with maps x reducers; AQE coalesces below the cap
    partitions = min(max_shuffle_partitions, max(executor_cores * 2, -(-int(input_bytes) // target)))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target),
    }

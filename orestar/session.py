"""Session settings the jobs are designed for."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession

# What the plans rely on, in any session. Hot join keys are split at run time,
# also where two joins on one key would otherwise share a shuffle; overflow and
# impossible dates stop a job instead of turning into NULL.
REQUIRED_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.ansi.enabled": "true",
}

# At most these: a task sorts and groups what it reads, in about twenty times
# the bytes that were shuffled. Smaller values of a session stay.
LARGEST_READS = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": 16,
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": 48,
}

# AQE merges small shuffle partitions, so their number only has to be large
# enough for the largest shuffle.
CLUSTER_SETTINGS = REQUIRED_SETTINGS | {
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.session.timeZone": "UTC",
}

LOCAL_SETTINGS = CLUSTER_SETTINGS | {
    "spark.sql.shuffle.partitions": "8",
    "spark.ui.enabled": "false",
    "spark.driver.memory": "8g",
}


def _bytes(size: str) -> int:
    """A size as Spark writes it, such as 64MB, 16m or 1024; bytes if no unit is named."""
    number, unit = re.fullmatch(r"\s*(\d+)\s*([a-z]*)\s*", size.lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit[:1].replace("b", "") or " ")


def prepare(spark: SparkSession) -> SparkSession:
    """Give a session made elsewhere the settings the plans rely on."""
    for name, value in REQUIRED_SETTINGS.items():
        spark.conf.set(name, value)
    for name, megabytes in LARGEST_READS.items():
        if _bytes(spark.conf.get(name)) > megabytes << 20:
            spark.conf.set(name, f"{megabytes}m")
    return spark


def cluster_session(app: str = "orestar", **extra: str) -> SparkSession:
    """Session for spark-submit: the master comes from the launcher."""
    builder = SparkSession.builder.appName(app)
    for name, value in (CLUSTER_SETTINGS | extra).items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def local_session(cpus: int | str = "*", app: str = "orestar", **extra: str) -> SparkSession:
    """Single-JVM session for tests and benchmarks."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for name, value in (LOCAL_SETTINGS | extra).items():
        builder = builder.config(name, value)
    return builder.getOrCreate()

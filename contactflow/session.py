"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot client must be split even where that costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A task sorts, joins and ranks what it reads in memory of some 20 times that size: data that
    # grow make more tasks, not larger ones.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    # Arrow batches end by bytes, so that rows of any length fit a worker.
    "spark.sql.execution.arrow.maxBytesPerBatch": "1m",
}

#: Folder of a local session whose configuration names none.
_local_root: str | None = None


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: str = "8", partitions: str = "8") -> SparkSession:
    """Session for tests and the local benchmark; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("contactflow")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", partitions)
    )
    spark = configure(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the cluster.

    Only a local master may fall back to a folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    global _local_root
    _local_root = _local_root or tempfile.mkdtemp(prefix="contactflow-")
    return _local_root


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; never reused between runs."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"

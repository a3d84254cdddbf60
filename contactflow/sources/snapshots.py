"""Versioned snapshots of a table that jobs replace as a whole.

A job reads version n and writes version n + 1 to a folder of its own; the
write's own success marker publishes it. A lost job leaves an unmarked
folder, which no reader opens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _fs(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def _versions(spark: SparkSession, base: str) -> list[tuple[int, bool]]:
    """(version, published) of every version folder."""
    fs, path = _fs(spark, base)
    if not fs.exists(path):
        return []
    found = []
    for status in fs.listStatus(path):
        name = status.getPath().getName()
        if name.startswith("v="):
            marker = spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
            found.append((int(name[2:]), fs.exists(marker)))
    return sorted(found)


def current_version(spark: SparkSession, base: str) -> int | None:
    published = [v for v, ok in _versions(spark, base) if ok]
    return published[-1] if published else None


def read_snapshot(spark: SparkSession, base: str, version: int | None = None) -> DataFrame:
    v = current_version(spark, base) if version is None else version
    if v is None:
        raise FileNotFoundError(f"no published snapshot below {base}")
    return spark.read.parquet(f"{base}/v={v}")


def write_snapshot(df: DataFrame, base: str) -> int:
    """Publishes `df` as the next version and returns its number."""
    spark = df.sparkSession
    taken = _versions(spark, base)
    version = taken[-1][0] + 1 if taken else 0
    df.write.mode("error").parquet(f"{base}/v={version}")
    return version

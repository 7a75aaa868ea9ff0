"""Versioned tables: one folder ``v=<version>`` per committed write.

Spark marks a finished write with ``_SUCCESS``; a folder without it is ignored,
so readers never see a half-written version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _committed(spark: SparkSession, path: str) -> list[str]:
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    done = []
    for status in fs.listStatus(root):
        folder = status.getPath()
        mark = spark._jvm.org.apache.hadoop.fs.Path(folder, "_SUCCESS")
        if folder.getName().startswith("v=") and fs.exists(mark):
            done.append(folder.getName()[2:])
    return sorted(done, key=_version_key)


def _version_key(version: str):
    """Numbers by value, other names (such as timestamps) as text."""
    return (0, int(version), "") if version.isdigit() else (1, 0, version)


def snapshot_versions(spark: SparkSession, path: str) -> list[str]:
    """Committed versions, oldest first."""
    return _committed(spark, path)


def read_snapshot(spark: SparkSession, path: str, version: str | int | None = None) -> DataFrame:
    """The newest committed version, or the one asked for."""
    known = _committed(spark, path)
    if version is not None and str(version) not in known:
        raise ValueError(f"version {version} not found in {path}")
    if not known:
        raise ValueError(f"no committed version in {path}")
    return spark.read.parquet(f"{path}/v={known[-1] if version is None else version}")


def write_snapshot(df: DataFrame, path: str, version: str | int | None = None) -> str:
    """Write a new version and return its name; existing versions are not touched."""
    if version is None:
        numbers = [int(v) for v in _committed(df.sparkSession, path) if v.isdigit()]
        version = max(numbers, default=0) + 1
    df.write.mode("errorifexists").parquet(f"{path}/v={version}")
    return str(version)

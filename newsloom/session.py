"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Settings a job should run with. They are applied by ``configure`` only where
# the cluster has not already set its own value.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # building large expressions is several times faster without call-site capture
    "spark.sql.dataFrameQueryContext.enabled": "false",
}


def builder(app_name: str = "newsloom", **settings: str) -> SparkSession.Builder:
    """Session builder with the defaults, overridable by keyword (``.`` as ``__``)."""
    made = SparkSession.builder.appName(app_name)
    for key, value in DEFAULTS.items():
        made = made.config(key, value)
    for key, value in settings.items():
        made = made.config(key.replace("__", "."), value)
    return made


def work_dir(spark: SparkSession) -> str:
    """The folder all executors share for checkpoints and staged tables.

    Taken from ``spark.checkpoint.dir``. Only a local session may go without
    it; there a temporary folder is made once and remembered in the session.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="newsloom-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base


def _own_folder(spark: SparkSession) -> str:
    return os.path.join(work_dir(spark), "newsloom", spark.sparkContext.applicationId)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused path below the application's part of the shared folder."""
    return os.path.join(_own_folder(spark), f"{label}-{uuid.uuid4().hex}")


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application has staged; call it once results are written."""
    _delete(spark, _own_folder(spark))


SPREAD_BYTES = 256 << 20


def spread(df: DataFrame) -> DataFrame:
    """A scan of fewer splits than the session has cores, spread over the cores.

    Only for a table of up to SPREAD_BYTES: a small file of one row group is one
    task however many cores there are. Anything larger is returned as it is; its
    splits are the matter of ``spark.sql.files.maxPartitionBytes``.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if size <= SPREAD_BYTES and df.rdd.getNumPartitions() < cores else df


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_passing: ContextVar[list[DataFrame] | None] = ContextVar("passing", default=None)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is written inside takes its shuffle files along when it has ended.

    Otherwise they stay until the driver's garbage is collected, which a large
    job does not wait for. A table that has been written needs them no more.
    """
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def stage(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write ``df`` to the shared folder and return the written table.

    Cuts the lineage in a way that survives lost executors, and gives the
    planner real file sizes, so that its own broadcast decision is size-checked.
    """
    return stage_all([df], label, **options)


def stage_all(frames: Sequence[DataFrame], label: str, **options: str) -> DataFrame:
    """As ``stage``, for frames of one layout that are written one after the other into one table."""
    spark = frames[0].sparkSession
    path = scratch_path(spark, label)
    with shuffles_removed(spark):
        for df in frames:
            df.write.options(**options).mode("append").parquet(path)
    written = spark.read.schema(frames[0].schema).parquet(path)
    written._staged_at = path
    if _passing.get() is not None:
        _passing.get().append(written)
    return written


def discard(*staged: DataFrame) -> None:
    """Delete tables from ``stage`` that nothing reads any more."""
    for table in staged:
        _delete(table.sparkSession, table._staged_at)


@contextmanager
def passing() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Tables staged inside are deleted at the end, but for those handed to the function that this gives.

    Nothing that is used later may read the others, so what leaves the block is staged in it.
    """
    outer, staged, kept = _passing.get(), [], []
    mark = _passing.set(staged)

    def keep(table: DataFrame) -> DataFrame:
        kept.append(table)
        return table

    try:
        yield keep
    finally:
        _passing.reset(mark)
        discard(*[t for t in staged if not any(t is k for k in kept)])
        if outer is not None:
            outer.extend(kept)

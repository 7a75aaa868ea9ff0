"""Run log as a table, and the choice of the best model version."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUN_SCHEMA = "run_id string, kind string, key string, value string"


def log_run(spark: SparkSession, path: str, run_id: str, *, params: Mapping[str, Any] | None = None,
            metrics: Mapping[str, float] | None = None, tags: Mapping[str, Any] | None = None) -> None:
    """Append the parameters, metrics and tags of a run to the log table."""
    rows = [
        (run_id, kind, str(k), str(v))
        for kind, entries in (("param", params), ("metric", metrics), ("tag", tags))
        for k, v in (entries or {}).items()
    ]
    if rows:
        spark.createDataFrame(rows, RUN_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def log_frame(metrics: DataFrame, path: str, run_id: str) -> None:
    """Append a frame of (key, value) metrics."""
    metrics.select(F.lit(run_id).alias("run_id"), F.lit("metric").alias("kind"), F.col("key").cast("string"),
                   F.col("value").cast("string")).write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_SCHEMA).parquet(path)


def best_version(versions: DataFrame, metric: str = "val_accuracy", version: str = "version",
                 order_by: str = "ordinal") -> DataFrame:
    """One row: the version with the highest metric. Versions without the metric
    do not count; of equal ones the first by ``order_by`` wins."""
    return versions.filter(F.col(metric).isNotNull()).agg(
        F.max_by(version, F.struct(F.col(metric), -F.col(order_by))).alias(version), F.max(metric).alias(metric))


def versions_from_runs(runs: DataFrame, metric: str = "val_accuracy") -> DataFrame:
    """Rows (version, ordinal, metric) from logged runs that carry a ``version`` tag."""
    def entry(kind: str, key: str):
        return F.max(F.when((F.col("kind") == kind) & (F.col("key") == key), F.col("value")))

    return runs.groupBy("run_id").agg(
        entry("tag", "version").alias("version"), entry("metric", metric).cast("double").alias(metric)
    ).filter("version is not null").withColumn("ordinal", F.col("version").cast("long"))


def load_best_model(spark: SparkSession, runs_path: str, models_path: str, metric: str = "val_accuracy") -> PipelineModel:
    """The saved model ``<models_path>/<version>`` of the best logged version."""
    best = best_version(versions_from_runs(read_runs(spark, runs_path), metric), metric).first()
    if best["version"] is None:
        raise ValueError(f"no version has the metric {metric}")
    return PipelineModel.load(f"{models_path}/{best['version']}")

"""Metrics from (label, prediction) rows, all as small aggregations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def confusion_counts(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n"))


def confusion_matrix(df: DataFrame, labels: Sequence, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row per listed label, one column ``p_<label>`` per predicted label, zeros filled."""
    cells = [F.count_if(F.col(prediction) == F.lit(p)).alias(f"p_{p}") for p in labels]
    counted = df.filter(F.col(label).isin(*labels)).groupBy(F.col(label).alias("label")).agg(*cells)
    listed = df.sparkSession.createDataFrame([(x,) for x in labels], f"label {df.schema[label].dataType.simpleString()}")
    return listed.join(counted, "label", "left").fillna(0).orderBy("label")


def classification_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Rows (class, precision, recall, f1, support): every class, accuracy, macro and weighted averages.

    The rows are reduced to class pairs once; everything else is arithmetic on
    (classes x classes) rows. A division by zero gives zero.
    """
    pairs = confusion_counts(df, label, prediction)
    sides = pairs.select(
        F.explode(F.array(
            F.struct(F.col("label").cast("string").alias("class"), F.col("n").alias("support"),
                     F.lit(0).cast("long").alias("predicted"),
                     F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("hit")),
            F.struct(F.col("prediction").cast("string").alias("class"), F.lit(0).cast("long").alias("support"),
                     F.col("n").alias("predicted"), F.lit(0).cast("long").alias("hit")),
        )).alias("x")).select("x.*")
    sums = sides.groupBy("class").agg(F.sum("support").alias("support"), F.sum("predicted").alias("predicted"),
                                      F.sum("hit").alias("hit"))

    def ratio(a, b):
        return F.when(b > 0, a / b).otherwise(F.lit(0.0))

    p, r = F.col("precision"), F.col("recall")
    scored = (
        sums.withColumn("precision", ratio(F.col("hit"), F.col("predicted")))
        .withColumn("recall", ratio(F.col("hit"), F.col("support")))
        .withColumn("f1", F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0)))
    )
    names = ["precision", "recall", "f1"]
    total = F.sum("support").alias("support")
    macro = scored.agg(*[F.avg(c).alias(c) for c in names], total).withColumn("class", F.lit("macro avg"))
    weighted = scored.agg(
        *[(F.sum(F.col(c) * F.col("support")) / F.sum("support")).alias(c) for c in names], total
    ).withColumn("class", F.lit("weighted avg"))
    accuracy = scored.agg((F.sum("hit") / F.sum("support")).alias("precision"), total)
    accuracy = accuracy.select(
        F.lit("accuracy").alias("class"), "precision", F.col("precision").alias("recall"),
        F.col("precision").alias("f1"), "support")
    columns = ["class", *names, "support"]
    return scored.select(columns).unionByName(accuracy.select(columns)).unionByName(
        macro.select(columns)).unionByName(weighted.select(columns))


def regression_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row (mse, rmse, mae, r2) in a single pass."""
    y, e = F.col(label).cast("double"), F.col(label).cast("double") - F.col(prediction).cast("double")
    sums = df.agg(F.avg(e * e).alias("mse"), F.avg(F.abs(e)).alias("mae"), F.var_pop(y).alias("__v"))
    return sums.select("mse", F.sqrt("mse").alias("rmse"), "mae", (1 - F.col("mse") / F.col("__v")).alias("r2"))


def report_metrics(report: DataFrame, prefix: str = "") -> DataFrame:
    """A report as rows (key, value), ready for the run log."""
    tidy = F.replace(F.col("class"), F.lit(" "), F.lit("_"))
    averages = F.col("class").isin("macro avg", "weighted avg")
    entries = F.when(F.col("class") == "accuracy", F.array(
        F.struct(F.lit(f"{prefix}accuracy").alias("key"), F.col("f1").alias("value")))
    ).when(averages, F.array(*[
        F.struct(F.concat(F.lit(f"{prefix}{m}_"), tidy).alias("key"), F.col(m).alias("value"))
        for m in ("precision", "recall", "f1")])
    ).otherwise(F.array(
        F.struct(F.concat(F.lit(f"{prefix}f1_class_"), F.col("class")).alias("key"), F.col("f1").alias("value"))))
    return report.select(F.explode(entries).alias("e")).select("e.*")

"""Batch and single-text scoring."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.functions import text as X
from newsloom.ml.features import as_vector, embed


def with_confidence(scored: DataFrame) -> DataFrame:
    """Add ``category_encode``, ``category`` and ``confidence`` to a model's output.

    Models without probabilities (one classifier per class) have their margins
    turned into shares with the logistic function.
    """
    if "probability" in scored.columns:
        shares = vector_to_array("probability")
    else:
        odds = F.transform(vector_to_array("rawPrediction"), lambda m: 1.0 / (1.0 + F.exp(-2.0 * m)))
        total = F.aggregate(odds, F.lit(0.0), lambda a, b: a + b)
        shares = F.transform(odds, lambda o: o / total)
    scored = scored.withColumn("__p", shares).withColumn("confidence", F.array_max("__p"))
    code = (F.array_position("__p", F.col("confidence")) - 1).cast("int")
    return scored.withColumn("category_encode", code).withColumn(
        "category", X.category_name(F.col("category_encode"))).drop("__p")


def score_vectors(model: Model, df: DataFrame) -> DataFrame:
    return with_confidence(model.transform(df))


def split_blank(df: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """Rows that can be scored, and rejected rows with a missing or blank text."""
    usable = F.coalesce(X.strip(F.col(column)) != "", F.lit(False))
    return df.filter(usable), df.filter(~usable)


def score_texts(model: Model, df: DataFrame, column: str = "text", *, make_encoder: Callable | None = None) -> DataFrame:
    """Embed and score a text column; blank texts are left out (see ``split_blank``)."""
    usable, _ = split_blank(df, column)
    vectors = embed(usable, column, "__e", make_encoder=make_encoder).withColumn("features", as_vector(F.col("__e")))
    return score_vectors(model, vectors.drop("__e")).select(*df.columns, "category_encode", "category", "confidence")


def score_one(model: Model, spark, text: str, **options) -> dict:
    """Score a single text; a blank text is an error."""
    if not isinstance(text, str) or not text.strip():
        raise ValueError("the text is empty")
    row = score_texts(model, spark.createDataFrame([(text,)], "text string"), **options).first()
    return {k: row[k] for k in ("category_encode", "category", "confidence")}

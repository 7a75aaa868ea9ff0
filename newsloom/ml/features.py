"""Text and vector features."""

from __future__ import annotations

import json
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, PipelineModel, Transformer
from pyspark.ml.feature import (
    PCA,
    CountVectorizer,
    ElementwiseProduct,
    HashingTF,
    IDF,
    Normalizer,
    RegexTokenizer,
    StandardScaler,
    StopWordsRemover,
)
from pyspark.ml.functions import array_to_vector, predict_batch_udf, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.param.shared import HasInputCol, HasOutputCol, Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.constants import EMBEDDING_DIM
from newsloom.functions import text as X
from newsloom.operators.ordering import LOOKUP_BYTES, lookup_join
from newsloom.session import stage

EVERY_WORD = (1 << 31) - 1
TASK_TEXT = 8 << 20  # bytes of text that one task takes apart into words
WORD_PATTERN = r"[\p{L}\p{N}_]{2,}"

# --- long form: one row per (document, word) ------------------------------------------


def text_tasks(df: DataFrame, column: str, max_bytes: int = TASK_TEXT) -> int:
    """How many tasks to take the texts of ``column`` apart in: each has about ``max_bytes`` of them, however many there are."""
    size = df.agg(F.sum(F.octet_length(column).cast("long"))).first()[0] or 0
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-size // max_bytes))


def bag_of_words(df: DataFrame, key: str, column: str, *, tasks: int | None = None) -> DataFrame:
    """Rows (key, word, tf). ``key`` identifies a row.

    The texts are shuffled once by key, before they are taken apart; all later
    per-document steps reuse that partitioning. A word takes many times its
    bytes while it is counted, so the number of ``tasks`` follows the texts' size.
    """
    placed = df.select(key, column).repartition(tasks or text_tasks(df, column), key)
    return placed.select(key, F.explode(X.words(F.col(column))).alias("word")).groupBy(key, "word").agg(
        F.count(F.lit(1)).alias("tf"))


def tfidf(df: DataFrame, key: str, column: str, *, max_features: int | None = None,
          max_bytes: int = LOOKUP_BYTES) -> DataFrame:
    """Rows (key, word, weight): tf * (ln((1 + n) / (1 + df)) + 1), unit length per document.

    With ``max_features`` only that many words, by corpus count, are kept. The
    texts are taken apart once: the bag is written, and all counts read it.
    """
    tasks = text_tasks(df, column)
    bag = stage(bag_of_words(df, key, column, tasks=tasks), "bag")
    n = df.count()
    stats = bag.groupBy("word").agg(F.count(F.lit(1)).alias("__n"), F.sum("tf").alias("__total"))
    if max_features:
        stats = stats.orderBy(F.desc("__total"), "word").limit(max_features)
    idf = stats.select("word", (F.log(F.lit(1.0 + n) / (F.lit(1.0) + F.col("__n"))) + 1).alias("__idf"))
    joined = lookup_join(bag, idf, "word", max_bytes=max_bytes, how="inner")
    raw = joined.select(key, "word", (F.col("tf") * F.col("__idf")).alias("__w")).repartition(tasks, key)
    # a document is one input row, so its words fit into one task
    norm = F.sqrt(F.sum(F.col("__w") * F.col("__w")).over(Window.partitionBy(key)))
    return raw.select(key, "word", (F.col("__w") / norm).alias("weight"))


# --- vector form: pipeline stages --------------------------------------------------------


class _InOut(HasInputCol, HasOutputCol):
    def _set_columns(self, input_col: str, output_col: str):
        self._set(inputCol=input_col, outputCol=output_col)


class WordCounts(Estimator, _InOut, DefaultParamsReadable, DefaultParamsWritable):
    """Count vector over all words, or the ``max_features`` most frequent ones.

    A vector's vocabulary is held by the driver; for an open-ended one use the
    long form above or the hashed vectors. ``stop_words`` is a list, or the name
    of a language whose list is built in.
    """

    max_features = Param(Params._dummy(), "max_features", "vocabulary size", TypeConverters.toInt)
    stop_words = Param(Params._dummy(), "stop_words", "words to leave out", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, inputCol="text", outputCol="features", max_features=None, stop_words=None):
        super().__init__()
        self._setDefault(max_features=EVERY_WORD, stop_words=[])
        given = {k: v for k, v in self._input_kwargs.items() if v is not None}
        if isinstance(stop_words, str):
            given["stop_words"] = StopWordsRemover.loadDefaultStopWords(stop_words)
        self._set(**{"inputCol": inputCol, "outputCol": outputCol, **given})

    def _stages(self, out: str) -> list:
        words = f"{out}__words"
        return [
            RegexTokenizer(inputCol=self.getInputCol(), outputCol=f"{words}_all", gaps=False,
                           pattern=WORD_PATTERN, toLowercase=True),
            StopWordsRemover(inputCol=f"{words}_all", outputCol=words,
                             stopWords=self.getOrDefault(self.stop_words) or [""]),
            CountVectorizer(inputCol=words, outputCol=out, vocabSize=self.getOrDefault(self.max_features)),
        ]

    def _fit(self, df: DataFrame) -> PipelineModel:
        return _fit_chain(df, self._stages(self.getOutputCol()))


class Tfidf(WordCounts):
    """TF-IDF vector with smoothed idf plus one and unit length."""

    def _fit(self, df: DataFrame) -> PipelineModel:
        out = self.getOutputCol()
        counts = _fit_chain(df, self._stages(f"{out}__tf"))
        idf = IDF(inputCol=f"{out}__tf", outputCol=f"{out}__idf").fit(counts.transform(df)).idf
        scale = ElementwiseProduct(scalingVec=Vectors.dense(np.asarray(idf) + 1.0),
                                   inputCol=f"{out}__tf", outputCol=f"{out}__w")
        return PipelineModel([*counts.stages, scale, Normalizer(p=2.0, inputCol=f"{out}__w", outputCol=out)])


def _fit_chain(df: DataFrame, stages: list) -> PipelineModel:
    fitted = []
    for s in stages:
        model = s.fit(df) if isinstance(s, Estimator) else s
        df = model.transform(df)
        fitted.append(model)
    return PipelineModel(fitted)


# --- embeddings ---------------------------------------------------------------------------


class HashedEmbedding(Transformer, _InOut, DefaultParamsReadable, DefaultParamsWritable):
    """Deterministic text vector without a model: hashed words, unit length."""

    dim = Param(Params._dummy(), "dim", "vector length", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCol="text", outputCol="features", dim=EMBEDDING_DIM):
        super().__init__()
        self._setDefault(dim=EMBEDDING_DIM)
        self._set(**{"inputCol": inputCol, "outputCol": outputCol, **self._input_kwargs})

    def _transform(self, df: DataFrame) -> DataFrame:
        out = self.getOutputCol()
        for stage in (
            RegexTokenizer(inputCol=self.getInputCol(), outputCol=f"{out}__words", gaps=False,
                           pattern=WORD_PATTERN, toLowercase=True),
            HashingTF(inputCol=f"{out}__words", outputCol=f"{out}__tf", numFeatures=self.getOrDefault(self.dim)),
            Normalizer(p=2.0, inputCol=f"{out}__tf", outputCol=out),
        ):
            df = stage.transform(df)
        return df.drop(f"{out}__words", f"{out}__tf")


def embed(df: DataFrame, column: str, out: str = "embedding", *, make_encoder: Callable | None = None,
          dim: int = EMBEDDING_DIM, batch_size: int = 32) -> DataFrame:
    """Add a float-array embedding of a text column.

    ``make_encoder`` returns a function from a batch of texts to a matrix; it is
    called once per Python worker. Without it the hashed embedding is used,
    which stays in the JVM.
    """
    if make_encoder is not None:
        encode = predict_batch_udf(make_encoder, return_type=T.ArrayType(T.FloatType()), batch_size=batch_size)
        return df.withColumn(out, encode(F.col(column)))
    hashed = HashedEmbedding(inputCol=column, outputCol="__embedding", dim=dim).transform(df)
    return hashed.withColumn(out, vector_to_array("__embedding", "float32")).drop("__embedding")


def as_vector(c: Column) -> Column:
    return array_to_vector(c.cast("array<double>"))


# --- projections ---------------------------------------------------------------------------


class Pca(Estimator, _InOut, DefaultParamsReadable, DefaultParamsWritable):
    """Principal components of centred vectors."""

    k = Param(Params._dummy(), "k", "components", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCol="features", outputCol="pca", k=2):
        super().__init__()
        self._setDefault(k=2)
        self._set(**{"inputCol": inputCol, "outputCol": outputCol, **self._input_kwargs})

    def _fit(self, df: DataFrame) -> PipelineModel:
        out = self.getOutputCol()
        return _fit_chain(df, [
            StandardScaler(withMean=True, withStd=False, inputCol=self.getInputCol(), outputCol=f"{out}__c"),
            PCA(k=self.getOrDefault(self.k), inputCol=f"{out}__c", outputCol=out),
        ])


class Svd(Estimator, _InOut, DefaultParamsReadable, DefaultParamsWritable):
    """Truncated singular value decomposition without centring, over the distributed rows.

    Only (features x components) numbers reach the driver, whatever the length.
    """

    k = Param(Params._dummy(), "k", "components", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCol="features", outputCol="svd", k=2):
        super().__init__()
        self._setDefault(k=2)
        self._set(**{"inputCol": inputCol, "outputCol": outputCol, **self._input_kwargs})

    def _fit(self, df: DataFrame):
        column, k = self.getInputCol(), self.getOrDefault(self.k)
        rows = MLUtils.convertVectorColumnsFromML(df.select(column).filter(F.col(column).isNotNull()), column)
        if rows.isEmpty():
            raise ValueError("no vectors")
        found = RowMatrix(rows).computeSVD(k)
        parts, sizes = found.V.toArray(), found.s.toArray()
        # every component points to its largest entry, so the signs are fixed
        parts = parts * np.sign(parts[np.abs(parts).argmax(axis=0), range(parts.shape[1])])
        return Projection(inputCol=self.getInputCol(), outputCol=self.getOutputCol()).with_matrix(
            parts, sizes)


class Projection(Transformer, _InOut, DefaultParamsReadable, DefaultParamsWritable):
    """Multiply vectors by a fixed (features x components) matrix."""

    matrix = Param(Params._dummy(), "matrix", "column-major entries", TypeConverters.toListFloat)
    components = Param(Params._dummy(), "components", "number of components", TypeConverters.toInt)
    scales = Param(Params._dummy(), "scales", "singular values", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, inputCol="features", outputCol="svd"):
        super().__init__()
        self._set(**{"inputCol": inputCol, "outputCol": outputCol, **self._input_kwargs})

    def with_matrix(self, parts: np.ndarray, scales: np.ndarray) -> "Projection":
        return self._set(matrix=[float(x) for x in parts.T.ravel()], components=int(parts.shape[1]),
                         scales=[float(x) for x in scales])

    def _transform(self, df: DataFrame) -> DataFrame:
        parts = np.array(self.getOrDefault(self.matrix)).reshape(self.getOrDefault(self.components), -1).T
        sent = df.sparkSession.sparkContext.broadcast(parts)  # beside the plan, once per executor

        @F.pandas_udf("array<double>")
        def project(entries: pd.DataFrame) -> pd.Series:
            matrix = sent.value
            return pd.Series([np.asarray(v) @ matrix[np.asarray(i, dtype=np.int64)] for i, v in zip(entries["i"], entries["v"])])

        held = F.filter(F.transform(vector_to_array(F.col(self.getInputCol())), lambda v, i: F.struct(i.alias("i"), v.alias("v"))), lambda e: e["v"] != 0)
        found = X.let(held, lambda e: F.struct(e["i"].alias("i"), e["v"].alias("v")))
        projected = df.withColumn("__entries", found).withColumn("__projected", project("__entries"))
        return projected.withColumn(self.getOutputCol(), array_to_vector("__projected")).drop("__entries", "__projected")

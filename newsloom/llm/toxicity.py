"""Toxicity by a factorization machine over hashed terms.

Terms are lower-cased runs of letters and digits and, as insults are inflected,
their first four to seven characters, hashed into ``HASHES`` slots; a document is
the set of its slots. Training rows choose the slots that go with the label (by
chi-square, at a bound on any false choice), and a factorization machine learns a
weight for each of them and, by the inner products of their factors, one for each
pair: an insult that counts only beside a mention of a group has a weight of its
own, which weights that add up cannot give it. All of it runs on Spark; the
driver holds statistics of the slots and the model, both of fixed size.

Only rows with a label learn, at most ``MAX_DOCS`` of them: those of the least
hashed ids; equal texts learn once. Nothing but the text is an input of a score.

Defined cases: a null text is empty; an empty one has no terms and scores as the
model's bias says; a null id has no label and is not held out; several labels of
one id count as toxic if one does; rows of equal id are documents of their own
and share the label; without labels of both kinds, or terms that go with them, every score
is the share of toxic ones, 0 without any; an empty table has no rows; columns
are taken by name and others are not looked at.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import FMClassifier
from pyspark.ml.feature import HashingTF, UnivariateFeatureSelector
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.session import stage

from .common import sized_join

HASHES = 1 << 18
STEMS = (4, 5, 6, 7)  # characters of a word's beginnings
FALSE_CHOICE = 0.01  # probability that any slot is chosen by chance
FACTORS = 4
STEPS = 100
MAX_DOCS = 20_000  # labelled documents that the model learns from
HELD_OUT_OF = 5
SEED = 13


def terms(text: Column) -> Column:
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)))
    stems = [F.transform(F.filter(words, lambda w, n=n: F.char_length(w) > n), lambda w, n=n: F.concat(F.substring(w, 1, n), F.lit("*"))) for n in STEMS]
    return F.concat(words, *[F.array_distinct(s) for s in stems])


def held_out(doc_id: Column, of: int = HELD_OUT_OF) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % of == 0, F.lit(False))


def _hashed(rows: DataFrame, hashes: int) -> DataFrame:
    tf = HashingTF(numFeatures=hashes, binary=True, inputCol="terms", outputCol="slots")
    return tf.transform(rows.withColumn("terms", terms(F.col("text")))).drop("terms", "text")


def training_rows(docs: DataFrame, labels: DataFrame, max_docs: int, of: int) -> DataFrame:
    """(text, label) of at most ``max_docs`` labelled documents that are not held out; one row of those with equal texts."""
    marked = labels.filter("id is not null and toxic is not null").groupBy("id").agg(F.max((F.col("toxic") > 0).cast("double")).alias("label"))
    marked = marked.filter(~held_out(F.col("id"), of))
    some = stage(marked.orderBy(F.xxhash64("id", F.lit(SEED)), "id").limit(max_docs), "toxicity-labelled")
    rows = docs.withColumn("same", F.sha2(F.coalesce("text", F.lit("")), 256)).join(F.broadcast(some), "id")
    # digests meet, texts do not move
    first = rows.groupBy("same").agg(F.min("id").alias("id"), F.max("label").alias("most"))
    first = stage(first, "toxicity-texts")
    return sized_join(rows, first, ["same", "id"], "inner", 80).select("text", F.col("most").alias("label"))


def fit(rows: DataFrame, *, hashes: int = HASHES, false_choice: float = FALSE_CHOICE, factors: int = FACTORS, steps: int = STEPS) -> PipelineModel | float:
    """The model of training rows (text, label), or the share of toxic ones if all are of one kind.

    Texts are hashed twice instead of written as slots, which would take more room
    than they do; what is written and gone over in every step is chosen slots only.
    """
    share = rows.agg(F.coalesce(F.avg("label"), F.lit(0.0))).first()[0]
    if share in (0.0, 1.0):
        return share
    hashed = _hashed(rows.select("text", "label"), hashes)
    selector = UnivariateFeatureSelector(featuresCol="slots", outputCol="features", labelCol="label", selectionMode="fwe")
    selector = selector.setFeatureType("categorical").setLabelType("categorical").setSelectionThreshold(false_choice).fit(hashed)
    if not selector.selectedFeatures:
        return share
    machine = FMClassifier(featuresCol="features", labelCol="label", factorSize=factors, maxIter=steps, stepSize=0.05, regParam=1e-4,
                           initStd=0.01, solver="adamW", seed=SEED)
    chosen = stage(selector.transform(hashed).select("features", "label"), "toxicity-features")
    return PipelineModel([selector, machine.fit(chosen)])


def score_toxicity(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_id_col: str = "doc_id",
                   label_col: str = "toxic", max_docs: int = MAX_DOCS, held_out_of: int = HELD_OUT_OF, hashes: int = HASHES) -> DataFrame:
    """Per row of ``docs``: id, held_out, score, predicted."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    known = labels.select(F.col(label_id_col).alias("id"), F.col(label_col).alias("toxic"))
    model = fit(training_rows(rows, known, max_docs, held_out_of), hashes=hashes)
    if isinstance(model, float):
        scored = rows.withColumn("score", F.lit(model))
    else:
        scored = model.transform(_hashed(rows, hashes)).withColumn("score", vector_to_array("probability")[1])
    return scored.select(F.col("id").alias(id_col), held_out(F.col("id"), held_out_of).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))

import random
import zlib

import pytest
from pyspark.sql import functions as F

from newsloom.llm import toxicity as T


def held(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


@pytest.fixture(scope="module")
def pairs(spark):
    """Toxic where an insult and a group meet; each alone is harmless and as frequent."""
    draw, docs, labels = random.Random(6), [], []
    for i in range(900):
        words = draw.choices([f"word{k}" for k in range(60)], k=20)
        insult, group = i % 2, i // 2 % 2
        words += ["grumble" + draw.choice(["s", "ing", "ed"])] * insult + ["villagers"] * group
        draw.shuffle(words)
        docs.append((i, " ".join(words).title(), "x", "y", 0.5))
        labels.append((i, insult & group, "z"))
    return (spark.createDataFrame(docs, "doc_id long, text string, lang string, label string, score double"),
            spark.createDataFrame(labels, "doc_id long, toxic int, id string"))


def test_pairs_of_terms_are_learnt(pairs):
    docs, labels = pairs
    rows = T.score_toxicity(docs, labels).join(labels.select("doc_id", "toxic"), "doc_id").collect()
    assert all(r["held_out"] == held(r["doc_id"]) and r["predicted"] == int(r["score"] >= 0.5) and 0 <= r["score"] <= 1 for r in rows)
    out = [r for r in rows if r["held_out"]]
    assert sum(r["predicted"] == r["toxic"] for r in out) / len(out) > 0.97


def test_held_out_labels_teach_nothing(pairs):
    docs, labels = pairs
    lie = labels.withColumn("toxic", F.when(T.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    pick = lambda df: {r["doc_id"]: round(r["score"], 9) for r in df.collect()}
    assert pick(T.score_toxicity(docs, labels)) == pick(T.score_toxicity(docs, lie))


def test_odd_input(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1), (2, 1)], "doc_id long, toxic int")
    got = T.score_toxicity(odd, labels)
    assert got.count() == odd.count() and got.columns == ["doc_id", "held_out", "score", "predicted"]
    assert got.filter("score is null or doc_id is null and held_out").count() == 0
    assert T.score_toxicity(none, labels).count() == 0
    assert {r["score"] for r in T.score_toxicity(odd, labels.limit(0)).collect()} == {0.0}


def test_given_documents(spark, folder):
    folder = folder.replace("0.001", "0.1")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = T.score_toxicity(docs, labels).filter("held_out").join(labels, "doc_id").groupBy("toxic").agg(
        F.avg("predicted").alias("flagged"), F.count("*").alias("n")).collect()
    flagged = {r["toxic"]: r["flagged"] for r in rows}
    assert flagged[1] > 0.8 and flagged[0] < 0.02

"""The pipeline's stages on the given tables, stage by stage against what each must do."""

import brute
import corpus_pipeline
from pyspark.sql import functions as F

from newsloom.llm import kneser_ney, line_dedup, pieces
from newsloom.session import stage


def test_stages_take_effect(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, results = docs.columns, [docs]
    for name, function in corpus_pipeline.STAGES:
        results.append(stage(function(spark, results[-1], folder), "test-stage"))
    source, judged, lines, near, mixed, encoded = results
    for df in (judged, lines, near, mixed):
        assert df.columns == columns
    kept = {r["doc_id"] for r in kneser_ney.judge_quality(source, spark.read.parquet(f"{folder}/labels.parquet")).filter("kept").collect()}
    assert {r["doc_id"] for r in judged.collect()} == kept

    rows = [(r["doc_id"], r["text"]) for r in judged.collect()]
    gone = brute.removed_lines(rows, line_dedup.SIZE, line_dedup.SHARE)
    left = {i: "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[i]) for i, t in rows}
    assert {r["doc_id"]: r["text"] for r in lines.collect()} == {i: t for i, t in left.items() if t.strip() or not gone[i]}

    rows = [(r["doc_id"], r["text"]) for r in lines.collect()]
    assert {r["doc_id"] for r in near.collect()} == {i for i, (_, c) in brute.near_duplicates(rows).items() if c == i}

    copies = mixed.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    assert {r["doc_id"] for r in mixed.collect()} <= {r["doc_id"] for r in near.collect()} and copies.agg(F.max("n")).first()[0] <= 3
    back = pieces.decode_texts(encoded)
    assert encoded.count() == mixed.count() and back.filter(F.col("decoded") != F.col("text")).count() == 0
    whole = corpus_pipeline.run(spark, folder)
    assert sorted((r["doc_id"], r["n_ids"]) for r in whole.collect()) == sorted((r["doc_id"], r["n_ids"]) for r in encoded.collect())


def test_queries_are_registered():
    import __spark_entry__ as entry

    names = list(entry.queries())
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)) and "pipeline" in names

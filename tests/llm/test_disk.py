import os
import time

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from newsloom import session as S
from newsloom.llm import line_dedup, links


def tables(spark):
    folder = S._own_folder(spark).removeprefix("file:")
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


def shuffles(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return {n for n in (blocks.apply(i).name() for i in range(blocks.size())) if n.startswith("shuffle_")}


def test_written_tables_leave_no_shuffle_files(spark):
    before, setting = shuffles(spark), spark.conf.get(S.CLEANUP)
    staged = S.stage(spark.range(1000).repartition(5).groupBy((F.col("id") % 7).alias("k")).count(), "t")
    until = time.time() + 20
    while (left := shuffles(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert not left and staged.count() == 7 and spark.conf.get(S.CLEANUP) == setting


def test_passing_tables_go_and_kept_ones_stay(spark):
    before = tables(spark)
    with S.passing() as outer:
        with S.passing() as inner:
            S.stage(spark.range(3), "inner-gone")
            a, b = inner(S.stage(spark.range(4), "outer-gone")), inner(S.stage(spark.range(5), "kept"))
        assert a.count() == 4 and tables(spark) - before == {os.path.basename(t._staged_at) for t in (a, b)}
        outer(b)
    assert [os.path.basename(b._staged_at)] == list(tables(spark) - before) and b.count() == 5
    with pytest.raises(KeyError), S.passing():
        S.stage(spark.range(3), "failed")
        raise KeyError
    assert len(tables(spark) - before) == 1


def test_line_dedup_keeps_one_table(spark):
    lines = [f"a line that stands in several texts {i % 5} with number {i % 5}" for i in range(40)]
    docs = spark.createDataFrame([(i, i, "\n".join(lines[i:i + 4]) + f"\nown line of {i}") for i in range(30)], "__doc long, __row long, text string")
    before = tables(spark)
    gone = line_dedup.removed_lines(docs)
    assert [n.startswith("line-gone") for n in tables(spark) - before] == [True]
    assert gone.count() > 20


@pytest.mark.parametrize("repeated", [False, True])
def test_prefixes_asked_for_by_parts_are_those_of_broadcast_numbers(spark, repeated):
    rng = np.random.default_rng(3)
    base = [np.unique(rng.integers(0, 1 << 62, 60)).astype(np.uint64) for _ in range(12)]
    rows = []
    for i in range(300):
        own = base[i % 12].copy()
        own[rng.integers(0, len(own), i % 9)] = rng.integers(0, 1 << 62, i % 9).astype(np.uint64)
        own = np.unique(own)
        rows.append((i // (2 if repeated else 1), len(own), bytearray(64), bytearray(own.tobytes())))
    sets = spark.createDataFrame(rows, "id long, size int, sketch binary, items binary").repartition(6)
    members = spark.createDataFrame([(i, i % 100) for i in sorted({r[0] for r in rows})], "id long, comp long")
    found = [{tuple(r) for r in links._close_pairs(members, sets, (80, 100), links.plain_numbers, limit).collect()} for limit in (1 << 20, 0)]
    assert found[0] == found[1] and len(found[0]) > 100


def test_pipeline_keeps_the_last_result(spark, folder, monkeypatch):
    seen = []

    def passed(spark, docs, sf_dir):
        seen.append(docs.count())
        own = S.stage(docs.filter("doc_id % 5 <> 0"), "own-table")
        return own.filter(F.col("doc_id") % (2 + len(seen)) != 0)

    monkeypatch.setattr(corpus_pipeline, "STAGES", [("one", passed), ("two", passed), ("three", lambda spark, docs, sf_dir: docs)])
    before = tables(spark)
    out = corpus_pipeline.run(spark, folder)
    ids = [r["doc_id"] for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id").collect()]
    assert sorted(r["doc_id"] for r in out.collect()) == sorted(i for i in ids if i % 5 and i % 3 and i % 4)
    assert [n.startswith("pipeline-two") for n in tables(spark) - before] == [True]

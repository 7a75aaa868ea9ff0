"""Cases that once lost rows, failed or gave null."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.functions.times import normalize_timestamp
from newsloom.ml import features as V
from newsloom.operators import quality as Q
from newsloom.sinks import upsert as U
from newsloom.sources import readers as R


def test_payloads_choose_their_key_one_by_one(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"news": [{"id": 1, "t": "a"}, {"id": 2, "t": "b"}], "status": "ok"}')
    (tmp_path / "b.json").write_text('{"data": [{"id": 3, "extra": "x"}]}')
    (tmp_path / "c.json").write_text('{"articles": [{"id": 4}], "news": null}')
    (tmp_path / "d.json").write_text('{"id": 5, "t": "e"}')
    (tmp_path / "e.json").write_text('{"news": []}')
    got = R.read_payloads(spark, str(tmp_path))
    assert sorted((r["id"], r["t"], r["extra"]) for r in got.filter("id is not null").collect()) == [
        (1, "a", None), (2, "b", None), (3, None, "x"), (4, None, None), (5, "e", None)]


@pytest.mark.parametrize("text, want", [
    ("2024-01-15T10:00:00+07", "2024-01-15 03:00:00"), ("2024-01-15 10:00 AM", "2024-01-15 03:00:00"),
    ("2024-01-15 12:30 pm", "2024-01-15 05:30:00"), ("Jan 15, 2024 10:00:00", "2024-01-15 03:00:00"),
    ("January 15, 2024", "2024-01-14 17:00:00"), ("20240115T100000Z", "2024-01-15 10:00:00"), ("20240115", "2024-01-14 17:00:00"),
    ("2024-01-15 10:00:00 EST", "2024-01-15 03:00:00"), ("Mon Jan 15 10:00:00 2024", "2024-01-15 03:00:00"),
    ("25/06/2024", "2024-06-24 17:00:00"), ("01/02/2024 10:00", "2024-01-02 03:00:00"), ("25.06.2024 10:00:00", "2024-06-25 03:00:00"),
    ("Mon, 15 Jan 2024 10:00:00 GMT", "2024-01-15 10:00:00"), ("15 January 2024 10:00", "2024-01-15 03:00:00"),
    ("2024-01-15T10:00:00.123456Z", "2024-01-15 10:00:00.123456"), ("nonsense", None), ("-", None), ("13:00", None)])
def test_timestamp_shapes(column, text, want):
    found = column(lambda c: normalize_timestamp(c).cast("string"), [text])[0]
    assert found == want


def test_a_raising_rule_is_one_failed_rule(spark):
    df = spark.createDataFrame([("maybe", "u"), ("no", "v")], "t string, url string")
    rules = [Q.NotNull("t"), Q.InSet("t", values=(True, False)), Q.MatchesRegex("url", regex="(["), Q.Unique("url")]
    got = [(r["success"], r["error"] is not None) for r in Q.run_suite(df, rules).orderBy("index").collect()]
    assert got[0] == (True, False) and got[3] == (True, False) and not got[1][0] and got[2] == (False, True)


def test_every_word_counts_and_svd_takes_long_vectors(spark):
    rows = [(i, " ".join(f"word{i * 300 + k}x" for k in range(300)) + " the and") for i in range(50)]
    df = spark.createDataFrame(rows, "id int, text string")
    counted = V.Tfidf(inputCol="text", stop_words="english").fit(df)
    made = counted.transform(df)
    assert made.first()["features"].size == 15_000
    reduced = V.Svd(k=3).fit(made).transform(made)
    assert reduced.first()["svd"].size == 3


def test_csv_is_bound_by_name(spark, tmp_path):
    (tmp_path / "x.csv").write_text("b,A,c\n1,x,z\n2,y,z\n")
    got = R.read_csv(spark, str(tmp_path / "x.csv"), "a string, b int")
    assert got.columns == ["a", "b"] and sorted(map(tuple, got.collect())) == [("x", 1), ("y", 2)]
    with pytest.raises(ValueError):
        R.read_csv(spark, str(tmp_path / "x.csv"), "nope string")
    both = tmp_path / "two"
    both.mkdir()
    (both / "1.csv").write_text("a,b\n1,2\n")
    (both / "2.csv").write_text("b,a\n1,2\n")
    with pytest.raises(Exception):
        R.read_csv(spark, str(both)).collect()


def test_bucketed_loads(spark, tmp_path):
    schema = T.StructType().add("id", "integer").add("name", "string")
    rows = spark.createDataFrame([(1, "a"), (None, "k"), (None, "k"), (None, None)], schema)
    options = {"now": F.current_timestamp(), "target_schema": schema}
    path = str(tmp_path / "t")
    first = U.upsert_buckets(path, rows, ["id"], buckets=4, **options)
    again = U.upsert_buckets(path, rows, ["id"], **options)
    assert (first["rows_inserted"], again["rows_upserted"]) == (4, 0) and spark.read.schema(schema).parquet(path).count() == 4
    with pytest.raises(ValueError):
        U.upsert_buckets(path, rows, ["id"], buckets=8, **options)

import json

import pytest
from pyspark.sql import functions as F

from newsloom.sinks import writers as W
from newsloom.sources import readers as R
from newsloom.sources.snapshots import read_snapshot, snapshot_versions, write_snapshot


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_payloads(spark, tmp_path):
    for name, body in {
        "a": {"status": "ok", "news": [{"id": "1", "title": "Test Article"}, {"id": "2", "title": "b"}]},
        "b": {"status": "ok", "news": []},
    }.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(body, indent=1))
    df = R.read_source(spark, {"type": "api_url", "path": str(tmp_path)})
    assert df.columns == ["id", "title"] and rows(df) == [("1", "Test Article"), ("2", "b")]


def test_payload_without_array_is_one_row(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"id": "1", "source": {"id": "s", "name": "n"}}))
    df = R.read_payloads(spark, str(tmp_path))
    assert df.columns == ["id", "source.id", "source.name"] and rows(df) == [("1", "s", "n")]


def test_payloads_per_category_folder(spark, tmp_path):
    for category in ("health", "science"):
        (tmp_path / f"category={category}").mkdir()
        body = {"articles": [{"title": category[0], "source": {"id": None, "name": "n"}}]}
        (tmp_path / f"category={category}" / "p.json").write_text(json.dumps(body))
    df = R.read_payloads(spark, str(tmp_path), keep=["category"])
    assert rows(df.select("category", "title", "`source.name`")) == [("health", "h", "n"), ("science", "s", "n")]


def test_text_tree(spark, tmp_path):
    files = {"News Articles/sport/1.txt": "a\nb", "Summaries/sport/1.txt": "s", "News Articles/tech/2+3 é.txt": "\n",
             "Other/tech/9.txt": "no", "News Articles/stray.txt": "no"}
    for name, text in files.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(text, encoding="utf-8")
    df = R.read_source(spark, {"type": "local_bbc", "path": str(tmp_path)})
    assert df.columns == ["filename", "category", "News Articles", "Summaries"]
    assert rows(df) == [("1.txt", "sport", "a\nb", "s"), ("2+3 é.txt", "tech", "\n", None)]


def test_csv_forms(spark, tmp_path):
    df = spark.createDataFrame([("0123", 'say "hi"; \nthen', ["a", "b"]), ("7", None, None)], "sf_id string, t string, l array<string>")
    path = str(tmp_path / "x")
    W.write_csv(df, path)
    back = R.read_semicolon_csv(spark, path, multiLine=True)
    assert back.columns == ["sf_id", "t", "l"]
    assert rows(back) == [("0123", 'say "hi"; \nthen', "['a', 'b']"), ("7", None, None)]
    raw = b"".join(p.read_bytes() for p in sorted((tmp_path / "x").glob("*.csv")))
    assert raw.startswith(b"\xef\xbb\xbfsf_id;t;l")
    W.write_csv(df, str(tmp_path / "y"), columns=["t"], sep=",", bom=False)
    assert R.read_csv(spark, str(tmp_path / "y")).columns == ["t"]


def test_bad_header(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,A\n1,2\n")
    with pytest.raises(ValueError):
        R.read_csv(spark, str(tmp_path / "x.csv"))


def test_by_extension(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "id long, t string")
    W.write_parquet(df, str(tmp_path / "x.parquet"))
    W.write_json(df, str(tmp_path / "x.json"))
    for ending in ("parquet", "json"):
        assert rows(R.read_source(spark, {"type": "minio", "path": str(tmp_path / f"x.{ending}")})) == [(1, "a")]
    with pytest.raises(ValueError):
        R.read_by_extension(spark, "x.xlsx")


def test_snapshots(spark, tmp_path):
    path = str(tmp_path / "t")
    assert snapshot_versions(spark, path) == []
    with pytest.raises(ValueError):
        read_snapshot(spark, path)
    for i in range(11):
        write_snapshot(spark.range(i), path)
    (tmp_path / "t" / "v=99").mkdir()  # a write that never finished
    assert snapshot_versions(spark, path)[-2:] == ["10", "11"]
    assert read_snapshot(spark, path).count() == 10 and read_snapshot(spark, path, 3).count() == 2
    with pytest.raises(ValueError):
        read_snapshot(spark, path, 99)


def test_jdbc_options():
    with pytest.raises(ValueError):
        R.jdbc_options("jdbc:x")
    o = R.jdbc_options("jdbc:x", table="t", schema="silver", query="select 1", fetch_size=5000)
    assert o["dbtable"] == "(select 1) q" and o["fetchsize"] == "5000"
    o = R.jdbc_options("jdbc:x", table="t", schema="silver", partition_column="id", num_partitions=8)
    assert (o["dbtable"], o["partitionColumn"], o["lowerBound"], o["upperBound"], o["numPartitions"]) == (
        "silver.t", "id", "0", "100000", "8")


def test_dispatch_errors(spark):
    for cfg in ({"type": "nope"}, {}, {"type": "csv"}, {"type": "db", "table": "t"}):
        with pytest.raises(ValueError):
            R.read_source(spark, cfg)


def test_inline_rows_and_models(spark):
    df = R.inline_rows(spark, [(1,), (None,)], "id int")
    first = W.materialize(df, "my_first_model", how="table")
    second = W.materialize(first.filter(F.col("id") == 1), "my_second_model", how="view")
    assert rows(second) == [(1,)] and rows(R.read_source(spark, {"type": "table", "table": "my_first_model"})) == [(1,), (None,)]
    with pytest.raises(ValueError):
        W.materialize(df, "x", how="cube")

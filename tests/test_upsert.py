from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.sinks import upsert as U
from newsloom.sources.snapshots import read_snapshot, snapshot_versions

TARGET = (
    T.StructType().add("id", "integer").add("name", "string").add("sf_id", "long").add("createdate", "timestamp")
    .add("usercreate", "string").add("updatedate", "timestamp").add("userupdate", "string")
)
OLD, NOW = datetime(2025, 1, 1), datetime(2025, 10, 6)


@pytest.fixture
def now(spark):
    return F.lit("2025-10-06 00:00:00").cast("timestamp")


@pytest.fixture
def target(spark):
    return spark.createDataFrame(
        [(1, "a", 11, OLD, "system", None, None), (2, "b", 12, OLD, "system", OLD, "system"),
         (3, None, 13, OLD, "system", None, None), (None, "n", 14, OLD, "system", None, None)], TARGET)


def by_id(df):
    return {r["id"]: r for r in df.collect()}


def test_classify(spark, target, now):
    batch = spark.createDataFrame([(1, "A", 91), (2, "b", 92), (3, "", 93), (4, "new", 94)], "ID int, Name string, sf_id bigint")
    got = by_id(U.classify(target, batch, ["id"], now=now))
    assert [got[i]["action"] for i in (1, 2, 3, 4)] == ["update", "unchanged", "unchanged", "insert"]
    assert (got[1]["name"], got[1]["sf_id"], got[1]["createdate"], got[1]["updatedate"], got[1]["userupdate"]) == (
        "A", 11, OLD, NOW, "system")
    assert got[2]["updatedate"] == OLD and got[3]["name"] is None
    assert (got[4]["sf_id"], got[4]["createdate"], got[4]["usercreate"], got[4]["updatedate"]) == (94, NOW, "system", None)
    assert got[None]["action"] == "unchanged"


def test_null_keys_insert(spark, target, now):
    batch = spark.createDataFrame([(None, "p"), (None, "q")], "id int, name string")
    out = U.classify(target, batch, ["id"], now=now)
    assert out.filter("id is null and action = 'insert'").count() == 2 and out.count() == 6


def test_repeated_keys(spark, target, now):
    batch = spark.createDataFrame([(7, "x", 1), (7, "y", 2)], "id int, name string, sf_id bigint")
    with pytest.raises(Exception, match="repeated key"):
        U.classify(target, batch, ["id"], now=now).collect()
    got = by_id(U.classify(target, batch, ["id"], now=now, on_duplicate="last", order_by=["sf_id"]))
    assert got[7]["name"] == "y"


def test_only_keys(spark, target, now):
    """With nothing to compare a match counts as changed, unless there is nothing to set."""
    batch = spark.createDataFrame([(1,), (9,)], "id int")
    got = by_id(U.classify(target, batch, ["id"], now=now))
    assert (got[1]["action"], got[9]["action"]) == ("update", "insert")
    got = by_id(U.classify(target.select("id"), batch, ["id"], now=now))
    assert (got[1]["action"], got[9]["action"]) == ("unchanged", "insert")


def test_insert_only_and_delete_insert(spark, target, now):
    batch = spark.createDataFrame([(1, "A"), (5, "e"), (5, "e"), (None, "z")], "id int, name string")
    done = U.insert_only(target, batch, ["id"], now=now)
    got = by_id(done.filter("id is not null"))
    assert got[1]["name"] == "a" and got[5]["createdate"] == NOW and done.count() == 6
    replaced = U.delete_insert(target.select("id", "name"), batch, ["id"])
    assert sorted(map(str, map(tuple, replaced.collect()))) == sorted(map(str, [
        (2, "b"), (3, None), (None, "n"), (1, "A"), (5, "e"), (5, "e"), (None, "z")]))


def test_stored_table(spark, tmp_path, now):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, name string")
    with pytest.raises(ValueError):
        U.upsert_snapshot(path, first, ["id"], now=now)
    report = U.upsert_snapshot(path, first, ["id"], now=now, target_schema=TARGET)
    assert (report["status"], report["rows_inserted"], report["version"]) == ("success", 3, "1")
    report = U.upsert_snapshot(path, first, ["id"], now=now)
    assert (report["rows_upserted"], report["rows_unchanged"]) == (0, 3)
    with pytest.raises(Exception):
        U.upsert_snapshot(path, first.union(first), ["id"], now=now)
    assert snapshot_versions(spark, path) == ["1", "2"] and read_snapshot(spark, path).count() == 3


def test_buckets_rewrite_only_what_is_hit(spark, tmp_path, now):
    path = str(tmp_path / "t")
    options = {"buckets": 16, "now": now, "target_schema": TARGET}
    U.upsert_buckets(path, spark.range(200).select(F.col("id").cast("int"), F.lit("a").alias("name")), ["id"], **options)
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "t").glob("__bucket=*/*.parquet")}
    U.upsert_buckets(path, spark.createDataFrame([(5, "z"), (999, "n")], "id int, name string"), ["id"], **options)
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "t").glob("__bucket=*/*.parquet")}
    assert len(set(before) - set(after)) <= 2
    got = by_id(spark.read.schema(TARGET).parquet(path))
    assert len(got) == 201 and got[5]["name"] == "z" and got[6]["name"] == "a" and got[999]["name"] == "n"


def test_a_repeated_load_writes_nothing(spark, tmp_path, now):
    """Buckets in which a batch changes nothing stay as they are; they count as unchanged."""
    path = str(tmp_path / "t")
    options = {"buckets": 4, "now": now, "target_schema": TARGET}
    rows = spark.createDataFrame([(i, f"n{i}" if i % 3 else None) for i in range(40)] + [(None, "p"), (None, "q")], "id int, name string")
    report = U.upsert_buckets(path, rows, ["id"], **options)
    assert (report["rows_inserted"], report["rows_updated"], report["rows_unchanged"]) == (42, 0, 0)
    files = lambda: {p: p.stat().st_mtime_ns for p in (tmp_path / "t").glob("__bucket=*/*.parquet")}
    before = files()
    report = U.upsert_buckets(path, rows, ["id"], **options)
    assert (report["rows_upserted"], report["rows_unchanged"]) == (0, 42) and files() == before
    report = U.upsert_buckets(path, spark.createDataFrame([(3, "x"), (4, "n4"), (None, "p"), (99, "y")], "id int, name string"), ["id"], **options)
    assert (report["rows_inserted"], report["rows_updated"]) == (1, 1)
    got = by_id(spark.read.schema(TARGET).parquet(path))
    assert got[3]["name"] == "x" and got[4]["updatedate"] is None and spark.read.schema(TARGET).parquet(path).count() == 43
    for _ in range(2):  # on a new table and on a stored one
        with pytest.raises(Exception, match="repeated key"):
            U.upsert_buckets(path, rows.union(rows), ["id"], **options)
        path += "-new"


def test_merge_statement():
    sql = U.merge_sql("t", "s", ["id", "name", "updatedate"], ["id"], "now()")
    assert "NOT (t.name <=> s.name)" in sql and "t.updatedate = now()" in sql and "INSERT (id, name, updatedate)" in sql

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.operators import dedup as D
from newsloom.operators import frames as O


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_successive_dedup(spark):
    df = spark.createDataFrame([(0, 1, "x"), (1, 1, "y"), (2, 2, "x"), (3, 3, "z")], "n int, a int, b string")
    assert rows(D.keep_first_successive(df, ["a", "missing", "b"], "n").drop("n")) == [(1, "x"), (3, "z")]


def test_whole_row_dedup_and_nulls(spark):
    df = spark.createDataFrame([(0, None, 1), (1, None, 1), (2, "a", None), (3, "a", None)], "n int, a string, b int")
    assert rows(D.keep_first_successive(df, None, "n")) == [(0, None, 1), (2, "a", None)]


def test_keep_first_does_not_depend_on_partitions(spark):
    df = spark.range(2000).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("k"))
    want = rows(D.keep_first(df.coalesce(1), "k", "id"))
    assert rows(D.keep_first(df.repartition(8), "k", "id")) == want
    plan = D.keep_first(df, "k", "id")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_min(" in plan and "SortAggregate" not in plan


def test_duplicate_ids_compare_as_one_type(spark):
    df = spark.createDataFrame([("5",), ("5",), ("6",), (None,), (None,)], "sf_id string")
    with pytest.raises(ValueError, match="5"):
        D.assert_unique(df, "sf_id")
    D.assert_unique(df.filter("sf_id = 6"), "sf_id")


def test_metadata(spark):
    df = spark.createDataFrame([("en", 1), (None, 2)], "language string, n int")
    out = O.append_metadata(df, {"language": "th", "layer": "bronze", "updatedate": None}, {"updatedate": "timestamp"})
    assert rows(out) == [("en", 1, "bronze", None), ("th", 2, "bronze", None)]
    assert dict(out.dtypes)["updatedate"] == "timestamp"


def test_layout(spark):
    df = spark.createDataFrame([("1", "x")], "a string, b string")
    assert O.drop_columns(df, ["b", "zz"]).columns == ["a"]
    assert O.rename_columns(df, {"a": "c", "zz": "y"}).columns == ["c", "b"]
    assert dict(O.cast_columns(df, {"a": "int", "zz": "int"}).dtypes)["a"] == "int"
    assert O.cast_columns(df, {"b": "int"}, lenient=True).first()["b"] is None
    with pytest.raises(Exception):
        O.cast_columns(df, {"b": "int"}).collect()
    assert O.ensure_column(df, "region").columns == ["a", "b", "region"]
    assert O.missing_columns(df, ["a", "z"]) == {"z"}


def test_flatten(spark):
    kind = T.StructType.fromDDL("id string, source struct<id: string, deep: struct<n: int>>, tags array<struct<t: int>>")
    df = spark.createDataFrame([("1", ("a", (2,)), [(3,)])], kind)
    assert O.flatten_structs(df).columns == ["id", "source.id", "source.deep.n", "tags"]


def test_header():
    assert O.check_header(["﻿id ", " Name"]) == ["id", "Name"]
    for bad in (["a", "A"], ["a", ""], []):
        with pytest.raises(ValueError):
            O.check_header(bad)


def test_align(spark):
    target = T.StructType.fromDDL("id bigint, Name string, other int")
    df = spark.createDataFrame([(1, "x", 2.0)], "ID int, NAME string, extra double")
    out = O.align_to_schema(df, target, ["id"])
    assert out.columns == ["id", "Name"] and out.first() == (1, "x")
    for keys, frame in ((["nokey"], df), (["other"], df), ([], df.select("extra"))):
        with pytest.raises(ValueError):
            O.align_to_schema(frame, target, keys)


def test_incremental_filter(spark):
    df = spark.createDataFrame([(1, 10), (2, 20), (3, None)], "id int, at int")
    some = spark.createDataFrame([(10,), (5,)], "at int")
    assert rows(O.newer_than(df, some, "at")) == [(2, 20)]
    assert len(rows(O.newer_than(df, some.filter("at > 99"), "at"))) == 3


def test_concat(spark):
    a = spark.createDataFrame([(1, "x")], "id int, a string")
    b = spark.createDataFrame([(2, "y")], "id int, b string")
    assert rows(O.concat_frames([a, b], "part")) == [(1, "x", 0, None), (2, None, 1, "y")]
    assert rows(O.concat_frames([a])) == [(1, "x")]


def test_join_rules(spark):
    left = spark.createDataFrame([(1, "l"), (2, "m")], "k int, v string")
    right = spark.createDataFrame([(1, "r")], "k int, v string")
    with pytest.raises(ValueError):
        O.join_frames(left, right, "k")
    out = O.join_frames(left, right, "k", "left", lsuffix="_l", rsuffix="_r")
    assert out.columns == ["k", "v_l", "v_r"] and rows(out) == [(1, "l", "r"), (2, "m", None)]
    with pytest.raises(ValueError):
        O.join_frames(left, right.drop("v"))
    assert O.join_frames(left, right.select(F.col("v").alias("w")), how="cross").count() == 2


def test_loadable(spark):
    df = spark.createDataFrame([("u",)], "url string")
    assert O.is_loadable(df) and not O.is_loadable(df.limit(0)) and not O.is_loadable(df, "id")


def test_null_rules(spark):
    df = spark.createDataFrame([(None, "a"), ("", "b"), ("x", None)], "s string, t string")
    assert len(rows(O.drop_nulls(df, []))) == 3 and rows(O.drop_nulls(df, ["s", "t"])) == [("", "b")]
    assert df.filter(O.is_missing_id(F.col("s"))).count() == 2

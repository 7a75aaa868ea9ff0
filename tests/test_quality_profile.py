import math

import pytest
from pyspark.sql import functions as F

from newsloom.operators import profile as P
from newsloom.operators import quality as Q
from newsloom.plans import silver


@pytest.fixture
def demo(spark):
    return spark.createDataFrame([(1.0, "a", 1.1), (2.0, "b", 2.2), (None, "c", 3.3)],
                                 "column1 double, column2 string, column3 double")


def test_suite(spark):
    df = spark.createDataFrame([("http://a", "x"), ("http://a", None), ("ftp", "yy"), (None, "zzz")], "url string, t string")
    rules = [Q.ColumnExists("url"), Q.ColumnExists("no"), Q.NotNull("url"), Q.Unique("url"),
             Q.MatchesRegex("url", 0.6, "^http"), Q.MatchesRegex("url", regex="^http"), Q.LengthBetween("t", low=1, high=2),
             Q.InSet("t", values=("x", "yy", "zzz")), Q.NotNull("no")]
    got = [(r["success"], r["unexpected"], r["total"]) for r in Q.run_suite(df, rules).orderBy("index").collect()]
    assert got == [(True, 0, 0), (False, 0, 0), (False, 1, 4), (False, 2, 3), (True, 1, 3), (False, 1, 3), (False, 1, 3),
                   (True, 0, 3), (False, 0, 0)]
    summary = Q.summarise(Q.run_suite(df, rules)).first()
    assert (summary["passed"], summary["failed"], summary["total"]) == (3, 6, 9)
    with pytest.raises(ValueError, match=r"\[9\] NotNull \(no\): column 'no' does not exist"):
        Q.enforce(Q.run_suite(df, rules))
    assert Q.summarise(Q.run_suite(df, [])).first()["success_rate"] == 0.0


def test_suite_sizes_and_empty_input(spark):
    assert [len(s) for s in (Q.bronze_suite(), Q.silver_suite(), Q.combined_suite())] == [10, 19, 31]
    empty = silver.empty_combined(spark)
    assert Q.summarise(Q.run_suite(empty, Q.combined_suite())).first()["failed"] == 0


def test_combined_suite_finds_bad_rows(spark):
    good = silver.empty_combined(spark).schema
    row = ("1", "s", "n", "a", None, "t", None, "https://a", None, None, None, None, None)
    from datetime import datetime

    tail = (datetime(2025, 1, 1), None, None, "b", "silver", None, None, True)
    df = spark.createDataFrame([row + tail], good)
    silver.check_combined(df)
    for change in ({"url": "x"}, {"layer": "gold"}, {"title": ""}, {"published_at": None}, {"sf_id": None}):
        bad = df.withColumns({k: F.lit(v).cast(dict(df.dtypes)[k]) for k, v in change.items()})
        with pytest.raises(ValueError):
            silver.check_combined(bad)
    with pytest.raises(ValueError):
        silver.check_combined(df.union(df))


def test_engine_checks(spark, demo):
    assert Q.null_columns(demo, ["column1", "column2"]) == ["column1"]
    assert Q.type_mismatches(demo, {"column1": "double", "column2": "int", "zz": "int"}) == ["column2", "zz"]
    df = spark.createDataFrame([(1, None), (1, None), (2, "a")], "a int, b string")
    assert Q.duplicate_count(df, ["a", "b"]).first()[0] == 1
    assert Q.failing_rows(df, Q.NotNull("b")).count() == 2
    assert [tuple(r) for r in Q.failing_rows(df, Q.Unique("a")).collect()] == [(1, 2)]
    assert Q.failing_rows(df, Q.Unique("b")).count() == 0


def test_validate_kinds(spark, demo, tmp_path):
    path = str(tmp_path / "x.parquet")
    demo.write.parquet(path)
    for source in (demo, path, demo.toPandas(), f"select * from parquet.`{path}`"):
        assert Q.validate(spark, source, [Q.NotNull("column2")]).first()["success"]
    with pytest.raises(ValueError):
        Q.validate(spark, 5, [])


def test_profile(spark, demo):
    assert {r["column"]: r["nulls"] for r in P.null_counts(demo).collect()} == {"column1": 1, "column2": 0, "column3": 0}
    means = {r["column"]: r["mean"] for r in P.column_means(demo).collect()}
    assert means["column1"] == 1.5 and means["column3"] == pytest.approx(2.2) and set(means) == {"column1", "column3"}
    assert {r["column"]: r["mean"] for r in P.column_means(demo, ["column2", "column1"]).collect()} == {"column2": None, "column1": 1.5}
    assert [r["count"] for r in P.value_counts(demo, ["column1"]).collect()] == [1, 1, 1]
    assert P.info(demo).filter("column = 'column1'").first()["non_null"] == 2
    assert [r["column2"] for r in P.tail(demo, "column2", 2).collect()] == ["b", "c"]


def test_histogram_edges(spark):
    df = spark.createDataFrame([(float(x),) for x in [0, 1, 2, 3, 4, 10, 10]], "v double")
    assert [r["count"] for r in P.histogram(df, "v", 5).collect()] == [2, 2, 1, 0, 2]
    same = spark.createDataFrame([(2.0,), (2.0,)], "v double")
    assert [r["count"] for r in P.histogram(same, "v", 3).collect()] == [2, 0, 0]


@pytest.mark.parametrize("accuracy", [10_000, 50, 4])
def test_exact_quantiles(spark, accuracy):
    import numpy as np

    values = np.concatenate([np.full(400, 3.0), np.random.default_rng(1).normal(size=601)])
    df = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(5)
    row = P.describe(df, ["v"], accuracy=accuracy).first()
    assert [row["q25"], row["q50"], row["q75"]] == pytest.approx(list(np.quantile(values, [0.25, 0.5, 0.75])))
    assert row["std"] == pytest.approx(values.std(ddof=1)) and row["count"] == 1001


def test_pivot_first(spark):
    df = spark.createDataFrame([("f", "a", 1, None), ("f", "a", 2, "x"), ("f", "a", 3, "y"), ("f", "b", 1, "z")],
                               "k string, p string, n int, v string")
    assert P.pivot_first(df, ["k"], "p", "v", "n", ["a", "b", "c"]).first() == ("f", "x", "z", None)


def test_encoding(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), (None,)], "c string")
    assert sorted(((r["c"], r["encoded_c"]) for r in P.encode_labels(df, "c").collect()), key=str) == [
        ("a", 0), ("b", 1), ("b", 1), (None, None)]
    assert not math.isnan(1.0)

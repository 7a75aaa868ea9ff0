import pytest
from pyspark.sql import functions as F

from newsloom.operators import quality as Q

RULES = [
    Q.ColumnExists("id"), Q.ColumnExists("gone"), Q.NotNull("id"), Q.MatchesRegex("url", 0.5, "^http"), Q.LengthBetween("url", low=1, high=9),
    Q.Unique("id"), Q.InSet("kind", values=("a", "b")), Q.NotNull("gone"),
]


@pytest.fixture
def rows(spark):
    return spark.createDataFrame([(1, "http://a", "a"), (1, "ftp://b", "c"), (None, "http://long-one", None), (3, None, "b")], "id int, url string, kind string")


def test_counts_while_writing_equal_counts_afterwards(rows):
    written, results, more = Q.stage_checked(rows, "checked", RULES, top=F.max("id"), n=F.count("*"))
    assert results.collect() == Q.run_suite(rows, RULES).collect()
    assert more == {"top": 3, "n": 4} and sorted(written.collect(), key=str) == sorted(rows.collect(), key=str)


def test_a_rule_that_raises_is_counted_apart(spark):
    df = spark.createDataFrame([("x",), ("1",)], "v string")

    class Odd(Q.Rule):
        def violated(self, c):
            return c.cast("int") > F.raise_error(F.lit("no")).cast("int")

    _, results, more = Q.stage_checked(df, "checked", [Odd("v"), Q.NotNull("v")], n=F.count("*"))
    first, second = results.collect()
    assert not first["success"] and first["error"] and second["success"] and more == {"n": 2}


def test_row_rules_are_counted_by_no_further_scan(rows, spark):
    group = "checked-scan"
    spark.sparkContext.setJobGroup(group, "checked")
    Q.stage_checked(rows, "checked", [r for r in RULES if r.name != "Unique"])
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) == 1


def test_failed_rules_by_row(rows):
    got = [sorted(r["f"]) for r in rows.select(Q.failed_rules(rows.columns, RULES).alias("f")).collect()]
    # the regular expression allows exceptions, so no row fails it
    assert got == [[], ["InSet (kind)"], ["LengthBetween (url)", "NotNull (id)"], []]

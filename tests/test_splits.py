from collections import Counter

import pytest
from pyspark.sql import functions as F

from newsloom.ml import models as M


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(3000).select("id", F.when(F.col("id") % 10 == 0, "rare").when(F.col("id") == 7, "one").when(F.col("id") != 9, "many").alias("label"),
                                    F.lit("x").alias("h"), F.lit(1).alias("at")).cache()


@pytest.mark.parametrize("small", [100_000, 20, 1])
def test_shares_are_exact_and_independent_of_the_range(rows, small):
    got = M.stratified_split(rows, "label", "id", small=small).select("id", "label", "is_test").collect()
    sizes = Counter((r["label"], r["is_test"]) for r in got)
    assert sizes == {("rare", True): 120, ("rare", False): 180, ("many", True): 1079, ("many", False): 1619, ("one", False): 1, (None, None): 1}
    want = M.stratified_split(rows, "label", "id").select("id", "is_test").collect()
    assert sorted((r["id"], r["is_test"]) for r in got) == sorted((r["id"], r["is_test"]) for r in want)


@pytest.mark.parametrize("small", [100_000, 30])
def test_folds_differ_by_one_at_most(rows, small):
    got = M.stratified_folds(rows, "label", "id", folds=7, small=small).filter("label is not null")
    sizes = {(r["label"], r["fold"]): r["n"] for r in got.groupBy("label", "fold").agg(F.count("*").alias("n")).collect()}
    for label, n in (("rare", 300), ("many", 2698), ("one", 1)):
        assert [sizes.get((label, i), 0) for i in range(7)] == [(n - i + 6) // 7 for i in range(7)]


def test_repeated_keys_stay_together_and_nothing_is_sorted_with_the_rows(rows):
    both = rows.union(rows)
    got = M.stratified_split(both, "label", "id").filter("label is not null")
    assert got.groupBy("id").agg(F.countDistinct("is_test").alias("n")).filter("n > 1").count() == 0
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" not in plan and "Sort" not in plan

import pytest

from newsloom import session as S


def test_stage_and_clear(spark):
    staged = S.stage(spark.range(10), "t")
    assert staged.count() == 10 and spark.conf.get("spark.checkpoint.dir") in staged.inputFiles()[0]
    S.clear_scratch(spark)
    with pytest.raises(Exception):
        S.stage(spark.range(0), "gone") and spark.read.parquet(staged.inputFiles()[0]).count()


def test_spread_only_small_scans(spark, folder):
    small = spark.read.parquet(f"{folder}/documents.parquet")
    assert S.spread(small).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    wide = spark.range(0, 100, 1, 32)
    assert S.spread(wide) is wide


def test_builder_keeps_given_settings(spark):
    made = S.builder("x", spark__sql__session__timeZone="UTC")
    assert made._options["spark.sql.session.timeZone"] == "UTC" and made._options["spark.sql.adaptive.enabled"] == "true"

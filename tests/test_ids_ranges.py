from pyspark.sql import functions as F

from newsloom.functions.ids import IdLayout
from newsloom.operators import ids as I

LAYOUT = IdLayout()


def exchanges_of_texts(made):
    plan = made._jdf.queryExecution().executedPlan().toString()
    return sum("Exchange" in line and "text" in line for line in plan.split("\n"))


def test_ids_sent_by_ranges_are_those_sent_at_once(spark, monkeypatch):
    rows = [(n, None if n % 41 == 0 else 1_760_000_000_000 + n % 3, str(5 + n) if n % 17 == 0 else None, f"text {n}") for n in range(2000)]
    df = spark.createDataFrame(rows, "n long, ms long, sf_id string, text string").repartition(5).withColumn("createdate", F.timestamp_millis("ms"))
    at_once = {r["n"]: r for r in I.assign_ids(df, LAYOUT, ["n"]).collect()}
    monkeypatch.setattr(I, "LOOKUP_BYTES", 16 * 300)
    made = I.assign_ids(df, LAYOUT, ["n"])
    assert exchanges_of_texts(made) == 0  # whole rows are not moved for their ids
    got = made.collect()
    assert len(got) == 2000 and {r["n"]: r for r in got} == at_once
    assert made.columns == df.columns


def test_ranges_cover_all_rows_once(spark):
    df = spark.range(0, 1000, 1, 7).filter("id % 3 = 0").select(F.monotonically_increasing_id().alias("__row")).withColumn("x", F.col("__row"))
    for most in (1, 10, 64, 100_000):
        ranges = I._row_ranges(df, most)
        counts = [df.filter(F.col("__row").between(lo, hi)).count() for lo, hi in (ranges if most > 1 else ranges[:20])]
        assert max(counts) <= most and (most == 1 or sum(counts) == df.count())
    assert I._row_ranges(df.limit(0), 5) == [(0, (1 << 63) - 1)]

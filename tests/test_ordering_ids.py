import random

import pytest
from pyspark.sql import functions as F

from newsloom.functions.ids import IdLayout
from newsloom.operators import ids as I
from newsloom.operators import ordering as O

LAYOUT = IdLayout()


@pytest.fixture(scope="module")
def skewed(spark):
    """Half of the rows share one key and one time, the rest is spread out."""
    draw = random.Random(7)
    rows = [(i, 0 if draw.random() < 0.5 else draw.randrange(40), draw.randrange(1000)) for i in range(3000)]
    return rows, spark.createDataFrame(rows, "id long, k int, v long").repartition(7)


def test_global_index(skewed):
    rows, df = skewed
    want = {r[0]: i for i, r in enumerate(sorted(rows, key=lambda r: (r[2], r[0])))}
    for ranges in (1, 13):
        got = O.running_index(df, ["v", "id"], ranges=ranges)
        assert {r["id"]: r["idx"] for r in got.collect()} == want


def test_index_within_groups_with_and_without_cutting(skewed):
    rows, df = skewed
    seen, want = {}, {}
    for r in sorted(rows, key=lambda r: (r[2], r[0])):
        want[r[0]] = seen.get(r[1], 0)
        seen[r[1]] = want[r[0]] + 1
    for ranges in (None, 1, 9):
        got = O.running_index(df, ["v", "id"], within=["k"], ranges=ranges)
        assert {r["id"]: r["idx"] for r in got.collect()} == want


def test_null_group_is_a_group(spark):
    df = spark.createDataFrame([(i, None if i % 2 else "a") for i in range(20)], "id long, k string")
    for ranges in (1, 3):
        got = O.running_index(df, ["id"], within=["k"], ranges=ranges)
        assert {r["id"]: r["idx"] for r in got.collect()} == {i: i // 2 for i in range(20)}


def test_running_sum_and_max(skewed):
    rows, df = skewed
    sums, top, total, high = {}, {}, 0, -1
    for r in sorted(rows):
        total, high = total + r[2], max(high, r[2])
        sums[r[0]], top[r[0]] = total, high
    assert {r["id"]: r["s"] for r in O.running(df, "id", F.col("v"), "s", ranges=11).collect()} == sums
    assert {r["id"]: r["s"] for r in O.running(df, "id", F.col("v"), "s", how=F.max, ranges=11).collect()} == top
    before = O.running(df, "id", F.col("v"), "s", inclusive=False, ranges=11)
    assert {r["id"]: r["s"] for r in before.collect()} == {
        r[0]: (None if r[0] == 0 else sums[r[0]] - r[2]) for r in rows}


@pytest.mark.parametrize("max_bytes", [0, 10_000_000])
def test_dense_index_of_numbers_and_texts(spark, skewed, max_bytes):
    rows, df = skewed
    order = {v: i for i, v in enumerate(sorted({r[2] for r in rows}))}
    got = O.dense_index(df, "v", max_bytes=max_bytes, ranges=6).collect()
    assert {r["id"]: r["rank"] for r in got} == {r[0]: order[r[2]] for r in rows}
    texts = df.select("id", F.concat(F.lit("https://long.prefix/é"), "v").alias("t"))
    order = {t: i for i, t in enumerate(sorted({f"https://long.prefix/é{r[2]}" for r in rows}, key=lambda t: t.encode()))}
    got = O.dense_index(texts, "t", max_bytes=max_bytes, ranges=6).collect()
    assert {r["id"]: r["rank"] for r in got} == {r[0]: order[f"https://long.prefix/é{r[2]}"] for r in rows}


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("max_bytes", [0, 1_000_000])
def test_lookup_join_is_a_join(skewed, how, max_bytes):
    rows, df = skewed
    lookup = df.filter("k % 2 = 0").groupBy("k").agg(F.sum("v").alias("total"))
    want = df.join(lookup, "k", how).select("id", "k", "v", "total")
    got = O.lookup_join(df, lookup, "k", max_bytes=max_bytes, how=how).select("id", "k", "v", "total")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


# --- ids ----------------------------------------------------------------------------------------------


def test_id_value(spark):
    ts = F.unix_millis(F.lit("2025-10-06T06:00:00.123Z").cast("timestamp"))
    from newsloom.functions.ids import pack_id

    assert spark.range(1).select(pack_id(ts, F.lit(5), LAYOUT)).first()[0] == 233468382928838661


def _timed(spark, rows):
    return spark.createDataFrame(rows, "n int, createdate string, sf_id string").withColumn(
        "createdate", F.to_timestamp("createdate"))


def test_assign_numbers_equal_milliseconds_and_keeps_given_ids(spark):
    df = _timed(spark, [(1, "2025-01-01 00:00:00.001", None), (2, "2025-01-01 00:00:00.001", ""),
                        (3, "2025-01-01 00:00:00.002", None), (4, "2025-01-01 00:00:00.001", "77"), (5, None, None)])
    got = {r["n"]: r for r in I.decode_ids(I.assign_ids(df, LAYOUT, ["n"]), LAYOUT).collect()}
    assert got[4]["sf_id"] == 77 and got[5]["sf_id"] is None
    assert [(got[i]["timestamp_ms"] - 1735689600000, got[i]["sequence"]) for i in (1, 2, 3)] == [(1, 0), (1, 1), (2, 0)]
    assert all((got[i]["datacenter_id"], got[i]["worker_id"]) == (1, 2) for i in (1, 2, 3))


def test_overflow_is_an_error_or_carried(spark):
    tight = IdLayout(sequence_bits=1)
    rows = [(i, f"2025-01-01 00:00:00.00{ms}", None) for i, ms in enumerate([1, 1, 1, 1, 1, 2, 5, 5, 5, 9])]
    df = _timed(spark, rows)
    with pytest.raises(ValueError):
        I.assign_ids(df, tight, ["n"], on_overflow="error")
    base, free, want = 1735689600000, 0, []
    for _, at, _ in rows:
        free = max(free, (base + int(at[-1])) * 2)
        want.append((free // 2, free % 2))
        free += 1
    for options in ({}, {"ranges": 3}):
        done = I.assign_ids(df, tight, ["n"], on_overflow="carry", **options)
        got = I.decode_ids(done, tight).orderBy("n").collect()
        assert [(r["timestamp_ms"], r["sequence"]) for r in got] == want


def test_many_hot_groups_and_constant_first_column(spark):
    """1 001 groups, texts with one shared head and an order column that is the same in all rows."""
    df = spark.range(4_004).select(
        "id", (F.col("id") % 1_001).alias("k"), F.lit(1).alias("same"), F.concat(F.lit("x" * 80), F.lpad("id", 6, "0")).alias("t"))
    got = O.running_index(df, ["same", "t"], within=["k"], ranges=8).collect()
    assert all(r["idx"] == r["id"] // 1_001 for r in got)
    ranged = O._ranged(df, ["same", "t"], 8)
    assert ranged.select("__range").distinct().count() > 4
    assert all(r["idx"] == r["id"] for r in O.running_index(df, ["same", "t"], ranges=8).collect())


def test_new_ids_start_after_given_ones(spark):
    df = spark.range(5_002).select(
        F.col("id").alias("n"), F.timestamp_millis(F.lit(1735689600001)).alias("createdate"),
        F.when(F.col("id") == 0, F.lit((((1735689600001 - LAYOUT.epoch_ms) << 22) | LAYOUT.writer_part | 7))).when(
            F.col("id") == 1, F.lit((((1735689600002 - LAYOUT.epoch_ms) << 22) | LAYOUT.writer_part | 1))).alias("sf_id"))
    done = I.assign_ids(df, LAYOUT, ["n"])
    assert done.select("sf_id").distinct().count() == 5_002 and done.filter("sf_id is null").count() == 0
    few = I.assign_ids(df.limit(12).filter("n <> 1"), LAYOUT, ["n"])
    assert min(r["sequence"] for r in I.decode_ids(few.filter("n > 1"), LAYOUT).collect()) == 8


def test_bulk_ids_never_repeat(spark):
    df = spark.range(10_000).repartition(5)
    ids = [r["sf_id"] for r in I.bulk_ids(df, 1759730400123, LAYOUT, ["id"]).orderBy("id").collect()]
    assert len(set(ids)) == 10_000 and ids == sorted(ids)
    cut = I.bulk_ids(df, 1759730400123, LAYOUT, ["id"], ranges=7).orderBy("id").collect()
    assert [r["sf_id"] for r in cut] == ids


def test_rank_ids_repeat_with_the_timestamp(spark):
    df = _timed(spark, [(1, "2025-01-01 00:00:00", None), (2, "2025-01-01 00:00:00", None), (3, "2025-01-02 00:00:00", None)])
    got = I.decode_ids(I.ids_by_rank(df.drop("sf_id"), "createdate", LAYOUT), LAYOUT).orderBy("n").collect()
    assert [r["sequence"] for r in got] == [0, 0, 1] and got[0]["sf_id"] == got[1]["sf_id"]


def test_configuration_tables(spark):
    config = spark.createDataFrame(
        [(1, 41, 5, 5, 12, "2024-01-01 00:00:00", False), (2, 41, 4, 6, 12, "2024-01-01 00:00:00", True),
         (3, 41, 5, 5, 10, "2023-01-01 00:00:00", True)],
        "version_no int, timestamp_bits int, datacenter_bits int, worker_bits int, sequence_bits int, "
        "epoch_start string, active_flag boolean").withColumn("epoch_start", F.col("epoch_start").cast("timestamp_ntz"))
    registry = spark.createDataFrame([("a", 1, 2, None, True), ("b", 3, 4, 50, False)],
                                     "source_name string, datacenter_id int, worker_id int, last_timestamp long, active_flag boolean")
    assert I.active_config(config).version_no == 3
    layout = I.registered_layout(config, registry, "a", 1)
    assert (layout.datacenter, layout.worker, layout.sequence_bits, layout.epoch_ms) == (1, 2, 12, 1704067200000)
    with pytest.raises(ValueError):
        I.registered_layout(config, registry, "b")
    with pytest.raises(ValueError):
        I.active_config(config, 9)
    seen = spark.createDataFrame([("a", 5), ("a", 9), ("b", 10)], "source_name string, last_timestamp long")
    assert sorted((r["source_name"], r["last_timestamp"]) for r in I.advance_registry(registry, seen).collect()) == [
        ("a", 9), ("b", 50)]

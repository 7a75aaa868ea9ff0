"""Time-ordered ids and positions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsloom.catalog.book import Book, table
from newsloom.functions.ids import IdLayout
from newsloom.operators.dedup import duplicate_keys
from newsloom.operators.ids import (
    advance_registry, assign_ids, bulk_ids, decode_ids, ids_by_rank, merge_run_log, run_summary,
)
from newsloom.operators.ordering import dense_index, running_index

BOOK = Book()
LAYOUT = IdLayout()
# order dates lie before the default epoch; two sequence bits make days overflow
OLD = IdLayout(epoch_ms=631152000000)  # 1990-01-01T00:00:00Z
TIGHT = IdLayout(epoch_ms=631152000000, sequence_bits=2)
NOW_MS = 1759730400123


def _id_sql(ms: str, seq: str, layout: IdLayout) -> str:
    return (
        f"((({ms}) - {layout.epoch_ms}) << {layout.time_shift}) | cast({layout.writer_part} as bigint) "
        f"| cast({seq} as bigint)"
    )


@BOOK.query("snowflake_assign", f"""
  with e as (select event_id, epoch_us(ts) // 1000 as ms, case when event_id % 10 = 0 then event_id end as given from events),
  n as (select *, row_number() over (partition by ms, given is null order by event_id) - 1 as seq from e)
  select event_id, coalesce(given, {_id_sql('ms', 'seq', LAYOUT)}) as sf_id from n""")
def snowflake_assign(spark, folder):
    given = F.when(F.col("event_id") % 10 == 0, F.col("event_id").cast("string")).when(F.col("event_id") % 10 == 1, "")
    e = table(spark, folder, "events").select("event_id", F.col("ts").alias("createdate"), given.alias("sf_id"))
    return assign_ids(e, LAYOUT, ["event_id"]).select("event_id", "sf_id")


@BOOK.query("snowflake_carry", f"""
  with o as (select o_orderkey, epoch_us(o_orderdate) // 1000 as ms,
    row_number() over (order by o_orderdate, o_orderkey) - 1 as i from orders),
  s as (select o_orderkey, i + max(ms * {TIGHT.slots} - i) over (order by i) as slot from o)
  select o_orderkey, {_id_sql(f'slot >> {TIGHT.sequence_bits}', f'slot & {TIGHT.slots - 1}', TIGHT)} as sf_id
  from s""")
def snowflake_carry(spark, folder):
    o = table(spark, folder, "orders").select("o_orderkey", F.col("o_orderdate").alias("createdate"))
    return assign_ids(o, TIGHT, ["o_orderkey"], on_overflow="carry").select("o_orderkey", "sf_id")


@BOOK.query("snowflake_rank", f"""
  with o as (select o_orderkey, epoch_us(o_orderdate) // 1000 as ms, dense_rank() over (order by o_orderdate) - 1 as r
    from orders)
  select o_orderkey, {_id_sql('ms', f'r & {OLD.slots - 1}', OLD)} as sf_id from o""")
def snowflake_rank(spark, folder):
    o = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    return ids_by_rank(o, "o_orderdate", OLD).select("o_orderkey", "sf_id")


@BOOK.query("snowflake_bulk", f"""
  with c as (select c_custkey, row_number() over (order by c_custkey) - 1 as i from customer)
  select c_custkey, {_id_sql(f'{NOW_MS} + (i >> 12)', 'i & 4095', LAYOUT)} as sf_id from c""")
def snowflake_bulk(spark, folder):
    return bulk_ids(table(spark, folder, "customer").select("c_custkey"), NOW_MS, LAYOUT, ["c_custkey"])


@BOOK.query("snowflake_decode", """
  select event_id, epoch_us(ts) // 1000 as timestamp_ms, cast(1 as bigint) as datacenter_id, cast(2 as bigint) as worker_id,
    row_number() over (partition by epoch_us(ts) // 1000 order by event_id) - 1 as sequence from events""")
def snowflake_decode(spark, folder):
    e = table(spark, folder, "events").select("event_id", F.col("ts").alias("createdate"))
    return decode_ids(assign_ids(e, LAYOUT, ["event_id"]), LAYOUT).drop("createdate", "sf_id")


@BOOK.query("duplicate_ids", """
  select cast(o_custkey as varchar) as o_custkey, count(*) as n from orders
  group by o_custkey having count(*) > 1""")
def duplicate_ids(spark, folder):
    return duplicate_keys(table(spark, folder, "orders"), "o_custkey")


@BOOK.query("id_run_log", f"""
  with e as (select event_type, epoch_us(ts) // 1000 as ms,
    row_number() over (partition by epoch_us(ts) // 1000 order by event_id) - 1 as seq from events),
  i as (select event_type, {_id_sql('ms', 'seq', LAYOUT)} as id from e)
  select event_type as source_name, 'daily' as job_name, cast(min(id) as varchar) as id_start,
    cast(max(id) as varchar) as id_end from i group by event_type""")
def id_run_log(spark, folder):
    e = table(spark, folder, "events").select("event_id", "event_type", F.col("ts").alias("createdate"))
    return run_summary(assign_ids(e, LAYOUT, ["event_id"]), source_col="event_type", job_name="daily")


_LOG = """select event_type as source_name, 'daily' as job_name, cast(min(event_id) as varchar) as id_start,
    cast(max(event_id) as varchar) as id_end from events where value < 10 group by event_type"""


@BOOK.query("run_log_merge", f"""
  with log as ({_LOG}),
  run as (select event_type as source_name, case when event_type = 'error' then 'extra' else 'daily' end as job_name,
    cast(min(event_id) + 1000000000 as varchar) as id_start, cast(max(event_id) + 1000000000 as varchar) as id_end
    from events group by event_type)
  select coalesce(log.source_name, run.source_name) as source_name, coalesce(log.job_name, run.job_name) as job_name,
    coalesce(log.id_start, run.id_start) as id_start, coalesce(run.id_end, log.id_end) as id_end,
    log.source_name is not null and run.source_name is not null as updated
  from log full join run on log.source_name = run.source_name and log.job_name = run.job_name""")
def run_log_merge(spark, folder):
    e = table(spark, folder, "events")
    stamps = {"createdate": F.lit("2025-01-01").cast("timestamp"), "usercreate": F.lit("system"),
              "updatedate": F.lit(None).cast("timestamp"), "userupdate": F.lit(None).cast("string")}
    log = run_summary(e.filter("value < 10"), source_col="event_type", job_name="daily", id_col="event_id")
    run = run_summary(e.withColumn("event_id", F.col("event_id") + 1_000_000_000), source_col="event_type",
                      job_name="daily", id_col="event_id").withColumn(
        "job_name", F.when(F.col("source_name") == "error", "extra").otherwise("daily"))
    merged = merge_run_log(log.withColumns(stamps), run, F.lit("2025-10-06").cast("timestamp"))
    return merged.select("source_name", "job_name", "id_start", "id_end", F.col("updatedate").isNotNull().alias("updated"))


@BOOK.query("registry_advance", """
  with r as (select event_type as source_name, case when event_type = 'click' then null
      else epoch_us(median(ts)) // 1000 end as last_timestamp from events group by event_type),
  s as (select event_type as source_name, max(epoch_us(ts) // 1000) as seen from events where event_type <> 'error'
    group by event_type)
  select source_name, case when seen is null then last_timestamp
    else greatest(coalesce(last_timestamp, 0), seen) end as last_timestamp from r left join s using (source_name)""")
def registry_advance(spark, folder):
    e = table(spark, folder, "events").select(
        F.col("event_type").alias("source_name"), F.unix_millis(F.col("ts").cast("timestamp")).alias("last_timestamp"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("us"))
    # the registry starts at each source's median, empty for one source
    median = F.floor(F.percentile("us", F.lit(0.5)) / 1000).cast("long")
    registry = e.groupBy("source_name").agg(
        F.when(F.col("source_name") != "click", median).alias("last_timestamp"))
    seen = e.filter(F.col("source_name") != "error").select("source_name", "last_timestamp")
    return advance_registry(registry, seen)


@BOOK.query("running_position", """
  select o_orderkey, row_number() over (order by o_totalprice, o_orderkey) - 1 as idx,
    row_number() over (partition by o_orderpriority order by o_totalprice, o_orderkey) - 1 as within_priority
  from orders""")
def running_position(spark, folder):
    o = table(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    o = running_index(o, ["o_totalprice", "o_orderkey"])
    o = running_index(o, ["o_totalprice", "o_orderkey"], within=["o_orderpriority"], out="within_priority")
    return o.select("o_orderkey", "idx", "within_priority")


@BOOK.query("dense_rank_of_dates", """
  select o_orderkey, dense_rank() over (order by o_orderdate) - 1 as rank from orders""")
def dense_rank_of_dates(spark, folder):
    return dense_index(table(spark, folder, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate").select(
        "o_orderkey", "rank")

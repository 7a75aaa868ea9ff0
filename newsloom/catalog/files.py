"""Sources, sinks and streams: the tables written out, and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.catalog import sqltext as S
from newsloom.catalog.book import ARTICLES_SQL, Book, articles, table
from newsloom.catalog.jobs import _SILVER_SQL
from newsloom.catalog.tables import _LOAD_SQL, NOW, target_and_batch
from newsloom.session import scratch_path
from newsloom.sinks import upsert as U
from newsloom.sinks import writers as W
from newsloom.sources import readers as R
from newsloom.sources.snapshots import read_snapshot, write_snapshot
from newsloom.streaming import incremental as Z

BOOK = Book()

_ALL_DOCUMENTS = "select doc_id, text, lang, source, n_chars from documents"
_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@BOOK.query("csv_semicolon", _ALL_DOCUMENTS)
def csv_semicolon(spark, folder):
    path = scratch_path(spark, "csv")
    W.write_csv(table(spark, folder, "documents"), path)
    return R.read_source(spark, {"type": "semicolon_csv", "path": path, "schema": _SCHEMA, "text_columns": [], "multiLine": True})


@BOOK.query("csv_comma", "select event_id, event_type, value from events")
def csv_comma(spark, folder):
    path = scratch_path(spark, "csv") + ".csv"
    W.write_csv(table(spark, folder, "events"), path, sep=",", columns=["event_id", "event_type", "value"], bom=False)
    return R.read_by_extension(spark, path, "event_id bigint, event_type string, value double")


@BOOK.query("json_files", _ALL_DOCUMENTS)
def json_files(spark, folder):
    path = scratch_path(spark, "json") + ".json"
    W.write_json(table(spark, folder, "documents"), path)
    return R.read_source(spark, {"type": "minio", "path": path, "schema": _SCHEMA})


@BOOK.query("parquet_files", "select lang, count(*) as n, cast(sum(n_chars) as bigint) as chars from documents group by lang")
def parquet_files(spark, folder):
    path = scratch_path(spark, "pq") + ".parquet"
    W.write_parquet(table(spark, folder, "documents"), path, partition_by=["lang"])
    return R.read_by_extension(spark, path).groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars"))


@BOOK.query("snapshot_versions", """
  select 'first' as version, count(*) as n from orders
  union all select 'newest', count(*) from customer""")
def snapshot_versions(spark, folder):
    path = scratch_path(spark, "snapshots")
    write_snapshot(table(spark, folder, "orders").select(F.col("o_orderkey").alias("k")), path, "20250101_000000")
    write_snapshot(table(spark, folder, "customer").select(F.col("c_custkey").alias("k")), path, "20250102_000000")
    first = read_snapshot(spark, path, "20250101_000000").agg(F.count(F.lit(1)).alias("n"))
    newest = R.read_source(spark, {"type": "dvc", "path": path}).agg(F.count(F.lit(1)).alias("n"))
    return first.select(F.lit("first").alias("version"), "n").unionByName(newest.select(F.lit("newest").alias("version"), "n"))


# --- payloads --------------------------------------------------------------------------------------------

_ARTICLE = "struct<ord: bigint, id: string, title: string, description: string, url: string, image: string, " \
           "author: string, category: string, language: string, published: string>"
PER_PAYLOAD = 10


def _land(df: DataFrame, path: str, key: str, *partition: str) -> None:
    """Payload documents with ten articles each under one array key."""
    entry = F.struct(*[c for c in df.columns if c not in partition])
    payloads = df.groupBy(*partition, F.floor(F.col("ord") / PER_PAYLOAD).alias("__p")).agg(
        F.sort_array(F.collect_list(entry)).alias(key)).withColumn("status", F.lit("ok")).drop("__p")
    payloads.write.partitionBy(*partition).json(path)


_ARTICLE_COLUMNS = "ord, id, title, description, url, image, author, category, language, published"


@BOOK.query("payload_envelope", f"with {ARTICLES_SQL} select {_ARTICLE_COLUMNS} from articles")
def payload_envelope(spark, folder):
    path = scratch_path(spark, "landing")
    _land(articles(spark, folder), path, "news")
    schema = f"status string, news array<{_ARTICLE}>"
    return R.read_source(spark, {"type": "api_url", "path": path, "schema": schema, "multiline": False})


@BOOK.query("payload_per_category", f"""with {ARTICLES_SQL}
  select 'example' as "source.name", id as "source.id", ord, title, category from articles""")
def payload_per_category(spark, folder):
    path = scratch_path(spark, "landing")
    a = articles(spark, folder).select(
        "ord", F.struct("id", F.lit("example").alias("name")).alias("source"), "title", "category")
    _land(a, path, "articles", "category")
    return R.read_payloads(spark, path, keep=["category"], multiline=False)


@BOOK.query("text_tree", """
  select 'quiz' as category, kind, text from benchmark, (values ('News Articles'), ('Summaries')) k(kind)""")
def text_tree(spark, folder):
    path = scratch_path(spark, "tree")
    for tree in R.CORPUS_TREES:  # one file per text, as such corpora come
        table(spark, folder, "benchmark").select("text").write.option("maxRecordsPerFile", 1).text(f"{path}/{tree}/quiz")
    files = R.read_text_tree(spark, path)
    return files.select("category", F.col("article_or_summary").alias("kind"),
                        F.regexp_replace("text_content", r"\n$", "").alias("text"))


# --- keyed loads into stored tables ---------------------------------------------------------------------------

_STORED = ["id", "name", "price", "sf_id"]


@BOOK.query("upsert_snapshot", f"with {_LOAD_SQL} select id, name, price, sf_id from loaded")
def upsert_snapshot(spark, folder):
    """The target loaded into an empty table, then the batch into it."""
    path = scratch_path(spark, "table")
    target, batch = target_and_batch(spark, folder)
    now = F.lit(NOW).cast("timestamp")
    U.upsert_snapshot(path, target, ["id"], now=now, target_schema=target.schema)
    U.upsert_snapshot(path, batch, ["id"], now=now)
    return read_snapshot(spark, path).select(*_STORED)


@BOOK.query("upsert_buckets", f"with {_LOAD_SQL} select id, name, price, sf_id from loaded")
def upsert_buckets(spark, folder):
    path = scratch_path(spark, "buckets")
    target, batch = target_and_batch(spark, folder)
    options = {"buckets": 8, "now": F.lit(NOW).cast("timestamp"), "target_schema": target.schema}
    U.upsert_buckets(path, target, ["id"], **options)
    U.upsert_buckets(path, batch, ["id"], **options)
    return spark.read.schema(target.schema).parquet(path).select(*_STORED)


@BOOK.query("upsert_repeated", f"with {_LOAD_SQL} select count(*) as rows_unchanged from loaded")
def upsert_repeated(spark, folder):
    """A repeated load changes nothing."""
    path = scratch_path(spark, "table")
    target, batch = target_and_batch(spark, folder)
    now = F.lit(NOW).cast("timestamp")
    U.upsert_snapshot(path, target, ["id"], now=now, target_schema=target.schema)
    U.upsert_snapshot(path, batch, ["id"], now=now)
    report = U.upsert_snapshot(path, batch, ["id"], now=now)
    return spark.createDataFrame([(report["rows_unchanged"],)] if not report["rows_upserted"] else [], "rows_unchanged long")


@BOOK.query("upsert_replay_keyless", """
  with rows as (select case when doc_id % 5 <> 0 then doc_id end as id, lang, source from documents)
  select id, lang, source from rows""")
def upsert_replay_keyless(spark, folder):
    """Rows without a key, loaded twice, are there once."""
    path = scratch_path(spark, "buckets")
    key = F.when(F.col("doc_id") % 5 != 0, F.col("doc_id")).alias("id")
    rows = table(spark, folder, "documents").select(key, "lang", "source")
    for _ in range(2):
        U.upsert_buckets(path, rows, ["id"], now=F.lit(NOW).cast("timestamp"), target_schema=rows.schema)
    return spark.read.schema(rows.schema).parquet(path).select(*rows.columns)


@BOOK.query("upsert_buckets_other_count", "select count(*) as rows, 8 as buckets, 'refused' as other from customer")
def upsert_buckets_other_count(spark, folder):
    """The stored bucket count holds: a load with another one is refused, and the table stays as it is."""
    path = scratch_path(spark, "buckets")
    rows = table(spark, folder, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    options = {"now": F.lit(NOW).cast("timestamp"), "target_schema": rows.schema}
    U.upsert_buckets(path, rows, ["id"], buckets=8, **options)
    try:
        U.upsert_buckets(path, rows, ["id"], buckets=16, **options)
        other = "taken"
    except ValueError:
        other = "refused"
    report = U.upsert_buckets(path, rows, ["id"], **options)
    return spark.read.schema(rows.schema).parquet(path).agg(
        F.count(F.lit(1)).alias("rows"), F.lit(report["buckets"]).alias("buckets"), F.lit(other).alias("other"))


# --- streams -----------------------------------------------------------------------------------------------------


@BOOK.query("stream_to_silver", f"""with {_SILVER_SQL}
  select id, title, description, url, author, category, language, source_news, published_us, 'silver' as layer
  from silver""")
def stream_to_silver(spark, folder):
    landing, silver, checkpoint = (scratch_path(spark, x) for x in ("landing", "silver", "checkpoint"))
    _land(articles(spark, folder), landing, "news")
    schema = T.StructType.fromDDL(f"status string, news array<{_ARTICLE}>")
    rows = Z.read_landing(spark, landing, schema, multiline=False)
    target = T.StructType.fromDDL(
        "ord bigint, id string, title string, description string, url string, image_url string, author string, "
        "category string, language string, published_at timestamp, source_news string, region string, layer string")
    query = Z.stream_to_silver(rows, "currentsapi", silver, checkpoint, order_by="ord", target_schema=target, now_ms=0)
    query.awaitTermination()
    return spark.read.schema(target).parquet(silver).select(
        "id", "title", "description", "url", "author", "category", "language", "source_news",
        F.unix_micros("published_at").alias("published_us"), "layer")


@BOOK.query("stream_first_seen", f"with {ARTICLES_SQL} select distinct {S.normalize_url('url')} as url from articles")
def stream_first_seen(spark, folder):
    landing, out, checkpoint = (scratch_path(spark, x) for x in ("landing", "seen", "checkpoint"))
    a = articles(spark, folder)
    a.select("url", F.timestamp_seconds(F.lit(1735689600) + F.col("ord")).alias("published_at")).write.parquet(landing)
    rows = spark.readStream.schema("url string, published_at timestamp").parquet(landing)
    Z.append_stream(Z.first_seen(rows, remember="3650 days"), out, checkpoint).awaitTermination()
    return spark.read.schema("url string, published_at timestamp").parquet(out).select("url")

"""Text, URL, time and category expressions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsloom.catalog import sqltext as S
from newsloom.catalog.book import ARTICLES_SQL, Book, articles, table, texts
from newsloom.constants import CATEGORY_TYPOS
from newsloom.functions import text as X
from newsloom.functions.times import normalize_timestamp
from newsloom.operators.frames import (
    lower_columns, replace_in_columns, replace_values, sentinels_to_null, strip_columns,
)
from newsloom.plans.gold import gold_category

BOOK = Book()


@BOOK.query("sentinel_null", f"""with {ARTICLES_SQL}
  select id, {S.null_if_in('title')} as title, {S.null_if_in('author')} as author,
    {S.null_if_in('category')} as category from articles""")
def sentinel_null(spark, folder):
    return sentinels_to_null(articles(spark, folder)).select("id", "title", "author", "category")


@BOOK.query("strip_lower_replace", f"""with {ARTICLES_SQL}, s as (
  select id, lower({S.strip('author')}) as author, lower(category) as category, {S.strip('title')} as title
  from articles)
  select id, case when author in ('n/a', '-') then null else author end as author, category, title from s""")
def strip_lower_replace(spark, folder):
    df = strip_columns(articles(spark, folder), ["author", "title", "missing"])
    df = lower_columns(df, ["author", "category"])
    return replace_in_columns(df, ["author"], ["n/a", "-"]).select("id", "author", "category", "title")


@BOOK.query("replace_map", f"""with {ARTICLES_SQL}
  select id, case category when 'poiltics' then 'politics' when 'poltics' then 'politics'
    when 'politic' then 'politics' else category end as category from articles""")
def replace_map(spark, folder):
    return replace_values(articles(spark, folder), "category", CATEGORY_TYPOS).select("id", "category")


@BOOK.query("normalize_text", f"select doc_id, {S.normalize_text('text')} as cleaned from documents")
def normalize_text(spark, folder):
    return texts(spark, folder, "documents").select("doc_id", X.normalize_text(F.col("text")).alias("cleaned"))


@BOOK.query("normalize_text_pages",
            f"select page_id, {S.normalize_text('html', entities=True)} as cleaned from pages")
def normalize_text_pages(spark, folder):
    return texts(spark, folder, "pages").select("page_id", X.normalize_text(F.col("html")).alias("cleaned"))


@BOOK.query("clean_keep_meaning", f"select doc_id, {S.clean_keep_meaning('text')} as cleaned from documents")
def clean_keep_meaning(spark, folder):
    return texts(spark, folder, "documents").select("doc_id", X.clean_keep_meaning(F.col("text")).alias("cleaned"))


@BOOK.query("clean_keep_meaning_pages", f"select page_id, {S.clean_keep_meaning('html')} as cleaned from pages")
def clean_keep_meaning_pages(spark, folder):
    return texts(spark, folder, "pages").select("page_id", X.clean_keep_meaning(F.col("html")).alias("cleaned"))


@BOOK.query("feature_text", f"""
  select 'd' || doc_id as id, {S.feature_text('text')} as cleaned from documents
  union all select 'p' || page_id, {S.feature_text('html')} from pages""")
def feature_text(spark, folder):
    d = texts(spark, folder, "documents").select(F.concat(F.lit("d"), "doc_id").alias("id"), "text")
    p = texts(spark, folder, "pages").select(F.concat(F.lit("p"), "page_id").alias("id"), F.col("html").alias("text"))
    return d.unionByName(p).select("id", X.feature_text(F.col("text")).alias("cleaned"))


@BOOK.query("text_for_embedding", f"""with {ARTICLES_SQL}
  select id, {S.feature_text('title')} || ' ' || {S.feature_text('description')} as text_for_embed from articles""")
def text_for_embedding(spark, folder):
    return articles(spark, folder).select("id", F.concat_ws(
        " ", X.feature_text(F.col("title")), X.feature_text(F.col("description"))).alias("text_for_embed"))


@BOOK.query("normalize_url", f"""with u as (
  select page_id, case page_id % 5 when 0 then url when 1 then ' ' || upper(url) || ' '
    when 2 then replace(url, 'http', 'ftp') when 3 then 'N/A' else url end as raw from pages)
  select page_id, {S.normalize_url('raw')} as url from u""")
def normalize_url(spark, folder):
    kind = F.col("page_id") % 5
    raw = (
        F.when(kind == 1, F.concat(F.lit(" "), F.upper("url"), F.lit(" ")))
        .when(kind == 2, F.replace(F.col("url"), F.lit("http"), F.lit("ftp"))).when(kind == 3, "N/A")
        .otherwise(F.col("url"))
    )
    return table(spark, folder, "pages").select("page_id", X.normalize_url(raw).alias("url"))


@BOOK.query("root_domain", f"""with {ARTICLES_SQL}
  select 'p' || page_id as id, {S.root_domain('url')} as domain from pages
  union all select 'a' || id, {S.root_domain('url')} from articles""")
def root_domain(spark, folder):
    p = table(spark, folder, "pages").select(F.concat(F.lit("p"), "page_id").alias("id"), "url")
    a = articles(spark, folder).select(F.concat(F.lit("a"), "id").alias("id"), "url")
    return p.unionByName(a).select("id", X.root_domain(F.col("url")).alias("domain"))


@BOOK.query("normalize_timestamp", """
  select event_id, epoch_us(case event_id % 6
    when 0 then date_trunc('second', ts) when 1 then date_trunc('second', ts) - interval 7 hour
    when 2 then date_trunc('second', ts) - interval 2 hour when 3 then date_trunc('second', ts)
    when 4 then date_trunc('day', ts) - interval 7 hour else null end) as at_us from events""")
def timestamps(spark, folder):
    kind = F.col("event_id") % 6
    raw = (
        F.when(kind == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(kind == 1, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .when(kind == 2, F.date_format("ts", "yyyy-MM-dd HH:mm:ss '+0200'"))
        .when(kind == 3, F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss 'GMT'"))
        .when(kind == 4, F.date_format("ts", "yyyy-MM-dd")).otherwise("undefined")
    )
    return table(spark, folder, "events").select("event_id", F.unix_micros(normalize_timestamp(raw)).alias("at_us"))


@BOOK.query("category_chain", f"""with {ARTICLES_SQL}, f as (
  select id, {S.first_category('category')} as first from articles), a as (
  select id, first, {S.allowed_or_default('first')} as category from f)
  select id, first, category, {S.category_code('category')} as code, category as back from a""")
def category_chain(spark, folder):
    df = articles(spark, folder).select("id", X.first_category(F.col("category")).alias("first"))
    df = df.withColumn("category", X.allowed_or_default(F.col("first")))
    df = df.withColumn("code", X.category_code(F.col("category")))
    return df.withColumn("back", X.category_name(F.col("code")))


@BOOK.query("category_list", f"""with {ARTICLES_SQL}
  select id, category from articles""")
def category_list(spark, folder):
    listed = F.concat(F.lit(" '"), F.replace(F.col("category"), F.lit(","), F.lit("', '")), F.lit("' "))
    return articles(spark, folder).select("id", X.canonical_category_list(listed).alias("category"))


_RARE = f"""r as (select id, case when category is null then null
    when count(*) over (partition by category) < 5 then 'general' else category end as category from raw),
  f as (select id, {S.first_category('category')} as first from r)
  select id, {S.allowed_or_default('first')} as category from f"""


@BOOK.query("rare_to_general", f"""with raw as (select p_partkey as id,
    case when p_partkey % 13 = 0 then p_name || ',x' when p_partkey % 3 = 0 then ' Politic '
      when p_partkey % 3 = 1 then 'technology,' || p_type else 'health,' || p_partkey end as category from part),
  {_RARE}""")
def rare_to_general(spark, folder):
    n = F.col("p_partkey")
    raw = (
        F.when(n % 13 == 0, F.concat("p_name", F.lit(",x"))).when(n % 3 == 0, " Politic ")
        .when(n % 3 == 1, F.concat(F.lit("technology,"), "p_type"))
        .otherwise(F.concat(F.lit("health,"), n.cast("string")))
    )
    return gold_category(table(spark, folder, "part").select(n.alias("id"), raw.alias("category")))


@BOOK.query("parse_vector", """select vec_id, len(embedding) as n, round(cast(embedding[1] as double), 4) as first
  from embeddings""")
def parse_vector(spark, folder):
    text = F.to_json("embedding")
    v = X.parse_vector(text)
    return table(spark, folder, "embeddings").select(
        "vec_id", F.size(v).cast("long").alias("n"), F.round(v[0].cast("double"), 4).alias("first"))

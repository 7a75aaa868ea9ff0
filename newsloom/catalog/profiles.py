"""Profiling operators over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsloom.catalog import sqltext as S
from newsloom.catalog.book import ARTICLES_SQL, Book, articles, table, texts
from newsloom.operators import profile as P
from newsloom.operators.ordering import dense_index

BOOK = Book()
NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@BOOK.query("value_counts", " union all ".join(
    f"select '{c}' as \"column\", cast({c} as varchar) as value, count(*) as count from lineitem group by {c}"
    for c in ("l_returnflag", "l_linestatus", "l_linenumber")))
def value_counts(spark, folder):
    return P.value_counts(table(spark, folder, "lineitem"), ["l_returnflag", "l_linestatus", "l_linenumber"])


@BOOK.query("null_counts", f"""with {ARTICLES_SQL}
  select 'author' as "column", count(*) filter (where author in ('N/A', '-')) as nulls from articles
  union all select 'title', count(*) filter (where {S.null_if_in('title')} is null) from articles""")
def null_counts(spark, folder):
    from newsloom.operators.frames import sentinels_to_null

    return P.null_counts(sentinels_to_null(articles(spark, folder).select("author", "title")))


@BOOK.query("column_info", """
  select 'doc_id' as "column", count(doc_id) as non_null, 'bigint' as dtype from documents
  union all select 'text', count(text), 'string' from documents
  union all select 'lang', count(lang), 'string' from documents
  union all select 'source', count(source), 'string' from documents
  union all select 'n_chars', count(n_chars), 'bigint' from documents""")
def column_info(spark, folder):
    return P.info(table(spark, folder, "documents"))


@BOOK.query("shape", "select count(*) as rows, 11 as columns from lineitem")
def shape(spark, folder):
    return P.shape(table(spark, folder, "lineitem"))


@BOOK.query("dup_count", """
  select count(*) - (select count(*) from (select distinct event_type, user_id, value from events)) as duplicates
  from events""")
def dup_count(spark, folder):
    return P.duplicate_rows(table(spark, folder, "events").select("event_type", "user_id", "value"))


@BOOK.query("column_bytes", """
  select 'text' as "column", sum(octet_length(encode(text))) as bytes from documents
  union all select 'lang', sum(octet_length(encode(lang))) from documents
  union all select 'doc_id', sum(octet_length(encode(cast(doc_id as varchar)))) from documents""".replace(
    "sum(", "cast(sum(").replace("))) as bytes", "))) as bigint) as bytes").replace(
    "(lang)))", "(lang))) as bigint)").replace("as varchar))))", "as varchar)))) as bigint)"))
def column_bytes(spark, folder):
    return P.column_bytes(table(spark, folder, "documents").select("text", "lang", "doc_id"))


@BOOK.query("column_means", """
  select 'o_totalprice' as "column", round(avg(o_totalprice), 4) as mean from orders
  union all select 'o_orderstatus', null from orders where o_orderkey = (select min(o_orderkey) from orders)""")
def column_means(spark, folder):
    return P.column_means(table(spark, folder, "orders"), ["o_totalprice", "o_orderstatus"]).withColumn(
        "mean", F.round("mean", 4))


def _describe_sql(c: str) -> str:
    return (
        f"select '{c}' as \"column\", count({c}) as count, round(avg({c}), 4) as mean, "
        f"round(stddev_samp({c}), 4) as std, min({c}) as min, round(quantile_cont({c}, 0.25), 4) as q25, "
        f"round(quantile_cont({c}, 0.5), 4) as q50, round(quantile_cont({c}, 0.75), 4) as q75, max({c}) as max "
        "from lineitem")


def _rounded(df):
    return df.withColumns({c: F.round(c, 4) for c in ("mean", "std", "q25", "q50", "q75")})


@BOOK.query("describe", " union all ".join(map(_describe_sql, NUMBERS)))
def describe(spark, folder):
    return _rounded(P.describe(table(spark, folder, "lineitem"), NUMBERS))


@BOOK.query("describe_bracketed", " union all ".join(map(_describe_sql, ["l_extendedprice"])))
def describe_bracketed(spark, folder):
    # the way for columns with more distinct values than one aggregation buffer may hold
    return _rounded(P.describe(table(spark, folder, "lineitem"), ["l_extendedprice"], accuracy=100))


@BOOK.query("bar_counts", "select p_brand, count(*) as count from part group by p_brand")
def bar_counts(spark, folder):
    return P.bar_counts(table(spark, folder, "part"), "p_brand")


@BOOK.query("histogram", """
  with e as (select min(l_extendedprice) as lo, max(l_extendedprice) as hi,
      (max(l_extendedprice) - min(l_extendedprice)) / 20 as w from lineitem),
  b as (select least(floor((l_extendedprice - lo) / w), 19) as bin, count(*) as n from lineitem, e group by 1)
  select cast(i as integer) as bin, round(lo + i * w, 4) as low, round(lo + (i + 1) * w, 4) as high,
    coalesce(n, 0) as count from e, range(20) r(i) left join b on bin = i""")
def histogram(spark, folder):
    return P.histogram(table(spark, folder, "lineitem"), "l_extendedprice", 20).withColumns(
        {c: F.round(c, 4) for c in ("low", "high")})


@BOOK.query("pivot_first", """
  select conv_id, min_by(text, turn) filter (where role = 'user') as user,
    min_by(text, turn) filter (where role = 'assistant') as assistant, cast(null as varchar) as moderator
  from conversations group by conv_id""")
def pivot_first(spark, folder):
    return P.pivot_first(table(spark, folder, "conversations"), ["conv_id"], "role", "text", "turn",
                         ["user", "assistant", "moderator"])


@BOOK.query("head_tail", """
  (select 'head' as part, o_orderkey from orders order by o_orderkey limit 5)
  union all (select 'tail', o_orderkey from orders order by o_orderkey desc limit 5)""")
def head_tail(spark, folder):
    o = table(spark, folder, "orders").select("o_orderkey")
    h = P.head(o, "o_orderkey").withColumn("part", F.lit("head"))
    return h.unionByName(P.tail(o, "o_orderkey").withColumn("part", F.lit("tail")))


@BOOK.query("word_top30", f"""
  select word, count(*) as n from (select unnest({S.words('text')}) as word from documents)
  group by word order by n desc, word limit 30""")
def word_top30(spark, folder):
    return P.top_words(texts(spark, folder, "documents"), "text", 30)


@BOOK.query("label_encode_texts", """
  select doc_id, dense_rank() over (order by text) - 1 as encoded_text from documents""")
def label_encode_texts(spark, folder):
    # more values than a task may number alone: the way over slices and a shuffled lookup
    d = table(spark, folder, "documents").select("doc_id", "text")
    return dense_index(d, "text", out="encoded_text", max_bytes=100, ranges=8).select("doc_id", "encoded_text")

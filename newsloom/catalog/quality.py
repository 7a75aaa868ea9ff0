"""Data-quality suites and checks over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsloom.catalog.book import ARTICLES_SQL, Book, articles, table
from newsloom.operators import quality as Q

BOOK = Book()

URL = "^https?://"
PAGE_RULES = [
    Q.ColumnExists("page_id"), Q.ColumnExists("title"), Q.NotNull("url"), Q.Unique("url"),
    Q.MatchesRegex("url", 0.5, "^https://"), Q.MatchesRegex("url", regex="^https://"),
    Q.LengthBetween("html", low=1, high=5000), Q.InSet("page_id", values=(0, 1, 2)), Q.NotNull("title"),
]


def _line(i, name, column, ok, bad="0", n="0", error="null"):
    return (
        f"select {i} as index, '{name}' as expectation, '{column}' as \"column\", {ok} as success, "
        f"cast({bad} as bigint) as unexpected, cast({n} as bigint) as total, cast({error} as varchar) as error from s"
    )


@BOOK.query("dq_suite_pages", "with s as (select count(*) as n, count(*) - count(url) as no_url, "
            "(select coalesce(sum(c), 0) from (select count(*) as c from pages where url is not null group by url "
            "having count(*) > 1)) as repeated, count(*) filter (where not starts_with(url, 'https://')) as not_https, "
            "count(*) filter (where length(html) not between 1 and 5000) as long, "
            "count(*) filter (where page_id not in (0, 1, 2)) as other from pages) " + " union all ".join([
                _line(1, "ColumnExists", "page_id", "true"), _line(2, "ColumnExists", "title", "false"),
                _line(3, "NotNull", "url", "no_url = 0", "no_url", "n"),
                _line(4, "Unique", "url", "repeated = 0", "repeated", "n"),
                _line(5, "MatchesRegex", "url", "(n - not_https) / n >= 0.5", "not_https", "n"),
                _line(6, "MatchesRegex", "url", "not_https = 0", "not_https", "n"),
                _line(7, "LengthBetween", "html", "long = 0", "long", "n"),
                _line(8, "InSet", "page_id", "other = 0", "other", "n"),
                _line(9, "NotNull", "title", "false", error="'column ''title'' does not exist'"),
            ]))
def dq_suite_pages(spark, folder):
    return Q.run_suite(table(spark, folder, "pages"), PAGE_RULES)


@BOOK.query("dq_bronze_suite", f"""with {ARTICLES_SQL},
  s as (select count(*) as n, count(*) filter (where not regexp_matches(url, '^https?://')) as bad_url,
    count(*) filter (where not regexp_matches(published, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}')) as bad_date,
    count(*) - count(title) as no_title from articles)
  select 10 as total, 10 - cast(no_title > 0 as integer) - cast(bad_url > n * 0.1 as integer)
    - cast(bad_date > n * 0.1 as integer) as passed from s""")
def dq_bronze_suite(spark, folder):
    results = Q.run_suite(articles(spark, folder), Q.bronze_suite())
    return Q.summarise(results).select(F.col("total").cast("int").alias("total"), F.col("passed").cast("int").alias("passed"))


@BOOK.query("dq_summary", """
  with r as (select count(*) = count(distinct url) as u, count(*) filter (where not starts_with(url, 'https://')) as h,
    count(*) as n, count(*) filter (where length(html) not between 1 and 5000) as l,
    count(*) filter (where page_id not in (0, 1, 2)) as o from pages),
  p as (select 2 + cast(u as integer) + cast((n - h) / n >= 0.5 as integer) + cast(h = 0 as integer)
    + cast(l = 0 as integer) + cast(o = 0 as integer) as passed from r)
  select cast(passed as bigint) as passed, cast(9 - passed as bigint) as failed, cast(9 as bigint) as total,
    round(passed * 100.0 / 9, 6) as success_rate from p""")
def dq_summary(spark, folder):
    return Q.summarise(Q.run_suite(table(spark, folder, "pages"), PAGE_RULES)).withColumn(
        "success_rate", F.round("success_rate", 6))


@BOOK.query("dq_first_failures", """
  select index from (values (2), (6), (7), (8), (9)) t(index)
  where index <> 7 or exists (select 1 from pages where length(html) not between 1 and 5000)
  order by index limit 10""")
def dq_first_failures(spark, folder):
    return Q.failures(Q.run_suite(table(spark, folder, "pages"), PAGE_RULES), 10).select("index")


@BOOK.query("dq_duplicate_count", """
  select count(*) - (select count(*) from (select distinct lang, source, text from documents)) as duplicates
  from documents""")
def dq_duplicate_count(spark, folder):
    return Q.duplicate_count(table(spark, folder, "documents"), ["lang", "source", "text"])


@BOOK.query("dq_failing_rows_unique", """
  select text, count(*) as n from documents group by text having count(*) > 1""")
def dq_failing_rows_unique(spark, folder):
    return Q.failing_rows(table(spark, folder, "documents"), Q.Unique("text"))


@BOOK.query("dq_failing_rows_set", """
  select event_id, event_type from events where event_type not in ('click', 'view')""")
def dq_failing_rows_set(spark, folder):
    return Q.failing_rows(table(spark, folder, "events").select("event_id", "event_type"),
                          Q.InSet("event_type", values=("click", "view")))


@BOOK.query("dq_failing_rows_null", """
  select d.doc_id from documents d left join labels l using (doc_id) where l.quality is null""")
def dq_failing_rows_null(spark, folder):
    d, l = table(spark, folder, "documents").select("doc_id"), table(spark, folder, "labels")
    return Q.failing_rows(d.join(l, "doc_id", "left"), Q.NotNull("quality")).select("doc_id")


@BOOK.query("dq_validate_query", """
  select 1 as index, count(*) filter (where length(text) > 2000) = 0 as success,
    count(*) filter (where length(text) > 2000) as unexpected from documents""")
def dq_validate_query(spark, folder):
    table(spark, folder, "documents").createOrReplaceTempView("checked_documents")
    return Q.validate(spark, "select text from checked_documents", [Q.LengthBetween("text", low=0, high=2000)]).select(
        "index", "success", "unexpected")

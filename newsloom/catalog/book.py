"""A book of queries, the tables they read and the adapters on top of them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.session import spread


class Book:
    """Queries of one area by name, with the SQL that gives the same rows."""

    def __init__(self) -> None:
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.sql: dict[str, str] = {}

    def query(self, name: str, sql: str | None = None):
        def register(fn):
            if name in self.queries:
                raise ValueError(f"query '{name}' is registered twice")
            self.queries[name] = fn
            if sql is not None:
                self.sql[name] = sql
            return fn

        return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table whose texts get costly work: spread if it is a small file."""
    return spread(table(spark, folder, name))


# --- adapters: news-shaped rows from the given tables, in Spark and in SQL ------------------

# fixed values: one made-up category per last digit of the document number
ADAPTER_CATEGORIES = [
    "business", "Sports", "poiltics", "technology,science", "general", "health", "politic", "weather",
    "entertainment", "science",
]
FIRST_SECOND = 1735689600  # 2025-01-01T00:00:00Z


def articles(spark: SparkSession, folder: str) -> DataFrame:
    """Article rows of the first source's shape from ``documents``; ``ord`` is the row's position."""
    d = table(spark, folder, "documents")
    n = F.col("doc_id")
    at = F.timestamp_seconds(F.lit(FIRST_SECOND) + n * 60)
    known = n - F.when(n % 10 == 9, 9).otherwise(0)  # every tenth article repeats an earlier URL
    url = F.concat(F.lit("https://www.paper"), (known % 23).cast("string"), F.lit(".com/"), known.cast("string"))
    return d.select(
        n.alias("ord"), n.cast("string").alias("id"), F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"),
        F.col("text").alias("description"), url.alias("url"), F.concat(url, F.lit("/image.png")).alias("image"),
        F.when(n % 7 == 0, "N/A").when(n % 11 == 0, "-").otherwise(
            F.concat(F.lit(" Author "), (n % 30).cast("string"))).alias("author"),
        F.get(F.array(*[F.lit(c) for c in ADAPTER_CATEGORIES]), (n % 10).cast("int")).alias("category"),
        F.upper("lang").alias("language"),
        F.when(n % 2 == 0, F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise(
            F.date_format(at, "yyyy-MM-dd HH:mm:ss")).alias("published"),
    )


_CASES = " ".join(f"when {i} then '{c}'" for i, c in enumerate(ADAPTER_CATEGORIES))
_KNOWN = "(doc_id - case when doc_id % 10 = 9 then 9 else 0 end)"
_URL = f"'https://www.paper' || ({_KNOWN} % 23) || '.com/' || {_KNOWN}"
_AT = f"make_timestamp(({FIRST_SECOND} + doc_id * 60) * 1000000)"
ARTICLES_SQL = f"""
articles as (
  select doc_id as ord, cast(doc_id as varchar) as id, split_part(text, chr(10), 1) as title, text as description,
    {_URL} as url, {_URL} || '/image.png' as image,
    case when doc_id % 7 = 0 then 'N/A' when doc_id % 11 = 0 then '-' else ' Author ' || (doc_id % 30) end as author,
    case doc_id % 10 {_CASES} end as category, upper(lang) as language,
    case when doc_id % 2 = 0 then strftime({_AT}, '%Y-%m-%dT%H:%M:%SZ')
         else strftime({_AT}, '%Y-%m-%d %H:%M:%S') end as published
  from documents)
"""

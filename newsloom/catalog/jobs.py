"""The composed jobs over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.catalog import sqltext as S
from newsloom.catalog.book import ARTICLES_SQL, FIRST_SECOND, Book, articles, table
from newsloom.functions.ids import IdLayout
from newsloom.operators.quality import combined_suite, run_suite, silver_suite
from newsloom.plans import bronze, corpus, gold, jobs, silver
from newsloom.session import passing, scratch_path, shuffles_removed, stage

BOOK = Book()
LAYOUT = IdLayout()
NOW_MS = 1759730400123

# --- bronze ------------------------------------------------------------------------------------------


@BOOK.query("bronze_job", f"""with {ARTICLES_SQL},
  k as (select *, row_number() over (order by ord) - 1 as i from articles where category is not null)
  select id, url, coalesce(language, 'en') as language, 'system' as usercreate, 'run-1' as batch_id,
    'currentsapi' as source_system, 'bronze' as layer, true as activedata, {NOW_MS // 1000 * 1000 + 123} as created_ms,
    ((({NOW_MS} + (i >> 12)) - {LAYOUT.epoch_ms}) << 22) | {LAYOUT.writer_part} | (i & 4095) as sf_id from k""")
def bronze_job(spark, folder):
    return _bronze(spark, folder).select(
        "id", "url", "language", "usercreate", "batch_id", "source_system", "layer", "activedata",
        F.unix_millis("createdate").alias("created_ms"), "sf_id")


def _bronze(spark, folder) -> DataFrame:
    return bronze.currentsapi(articles(spark, folder), batch_id="run-1", now_ms=NOW_MS, layout=LAYOUT, order_by=["ord"])


# --- silver -------------------------------------------------------------------------------------------

_SILVER_SQL = f"""{ARTICLES_SQL},
  cleaned as (select ord, id, {S.normalize_text('title')} as title, {S.normalize_text('description')} as description,
    {S.normalize_url('url')} as url, {S.normalize_text('author')} as author, {S.normalize_text('category')} as category,
    lower({S.normalize_text('language')}) as language, {S.root_domain('url')} as source_news,
    {S.published('published')} as published_us from articles),
  silver as (select * from cleaned where url is not null qualify row_number() over (partition by url order by ord) = 1)
"""


@BOOK.query("silver_job", f"""with {_SILVER_SQL}
  select id, title, description, url, author, category, language, source_news, published_us, 'silver' as layer from silver""")
def silver_job(spark, folder):
    return _silver(spark, folder).select(
        "id", "title", "description", "url", "author", "category", "language", "source_news",
        F.unix_micros("published_at").alias("published_us"), "layer")


def _silver(spark, folder) -> DataFrame:
    return silver.clean(articles(spark, folder), "currentsapi", "ord")


@BOOK.query("silver_quality", f"""with {_SILVER_SQL}
  select 19 as rules, count(*) filter (where title is null) as no_title, count(*) as rows from silver""")
def silver_quality(spark, folder):
    results = run_suite(silver.clean(_bronze(spark, folder), "currentsapi", "ord"), silver_suite())
    found = results.agg(
        F.count(F.lit(1)).cast("int").alias("rules"),
        F.max(F.when(F.col("expectation") == "LengthBetween", F.col("total"))).alias("titled"),
        F.max(F.when(F.col("expectation") == "Unique", F.col("total"))).alias("rows"))
    return found.select("rules", (F.col("rows") - F.col("titled")).alias("no_title"), "rows")


# --- four sources into one table ---------------------------------------------------------------------------
# documents, pages, conversations and benchmark stand for the four sources.



def _common(n, system: str, batch: str = "run-1"):
    at = F.timestamp_seconds(F.lit(FIRST_SECOND) + n)
    return {
        "sf_id": F.lit(None).cast("long"), "source_system": F.lit(system), "createdate": at,
        "updatedate": F.lit(None).cast("timestamp"), "batch_id": F.lit(batch), "layer": F.lit("bronze"),
        "usercreate": F.lit("system"), "userupdate": F.lit(None).cast("string"), "activedata": F.lit(True),
    }


def four_sources(spark, folder) -> dict[str, DataFrame]:
    """Cleaned rows of each source, ready for the combined layout."""
    a = articles(spark, folder)
    first = a.withColumns(_common(F.col("ord"), "currentsapi")).withColumn("region", F.lit(None).cast("string"))

    p = table(spark, folder, "pages")
    n = F.col("page_id")
    second = p.select(
        n.alias("ord"), "url", F.concat(F.lit("Page "), n.cast("string")).alias("title"), F.col("html").alias("description"),
        F.lit("N/A").alias("author"), F.lit(" Web ").alias("source"), F.col("url").alias("image"),
        F.lit("general").alias("category"), F.lit("EN").alias("language"), F.lit("us").alias("country"),
        F.date_format(F.timestamp_seconds(F.lit(FIRST_SECOND) + n), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("published_at"),
        *[v.alias(k) for k, v in _common(n, "mediastack").items()])

    c = table(spark, folder, "conversations")
    m = F.col("conv_id") * 100 + F.col("turn")
    third = bronze.flat_newsapi(c.select(
        m.alias("ord"), F.struct(F.col("role").alias("id"), F.lit("Talk").alias("name")).alias("source"),
        F.col("role").alias("author"), F.lit("talk").alias("title"), F.col("text").alias("description"),
        F.concat(F.lit("https://talk.example.org/"), m.cast("string")).alias("url"), F.lit(None).cast("string").alias("urlToImage"),
        F.date_format(F.timestamp_seconds(F.lit(FIRST_SECOND) + m), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("publishedAt"),
        F.col("text").alias("content"), F.lit("science").alias("category"), F.lit("us").alias("region"), F.lit("en").alias("language"),
        *[v.alias(k) for k, v in _common(m, "newsapi").items()]))

    b = table(spark, folder, "benchmark")
    i = F.col("item_id")
    staged = b.select(
        i.cast("string").alias("id"), F.timestamp_seconds(F.lit(FIRST_SECOND) + i).alias("publishedtime"),
        F.col("text").alias("titlenews"), F.col("text").alias("description"), F.lit(None).cast("string").alias("imageurl"),
        F.concat(F.lit("https://bench.example.org/"), i.cast("string")).alias("url"), F.lit("health").alias("category"),
        F.lit("bench").alias("source"), F.lit("team").alias("author"), F.lit("en").alias("language"),
        F.timestamp_seconds(F.lit(FIRST_SECOND) + i).alias("createdate"), F.lit("system").alias("usercreate"),
        F.lit(None).cast("timestamp").alias("updatedate"), F.lit(None).cast("string").alias("userupdate"),
        F.lit(True).alias("activedata"))
    return {
        "currentsapi": silver.clean(first, "currentsapi", "ord"),
        "mediastack": silver.clean(second, "mediastack", "ord"),
        "newsapi": silver.clean(third, "newsapi", "ord"),
        "staging": staged,
    }


_SECONDS = f"({FIRST_SECOND} + {{n}}) * 1000000"
_COMBINED_SQL = f"""{_SILVER_SQL},
  pg as (select page_id, 'Page ' || page_id as title, html, url from pages),
  pages_clean as (select page_id, {S.normalize_text('title')} as title, {S.normalize_text('html', entities=True)} as description,
    {S.normalize_url('url')} as url from pg qualify row_number() over (partition by url order by page_id) = 1),
  talk as (select conv_id * 100 + turn as m, {S.normalize_text('role')} as author, role, {S.normalize_text('text')} as text
    from conversations),
  combined as (
    select 'currentsapi' as source_system, source_news as source_name, id as article_id, author, title, description, url,
      category, language, cast(null as varchar) as region, cast(null as varchar) as content, published_us,
      {_SECONDS.format(n='ord')} as created_us, 'silver' as layer from silver
    union all select 'mediastack', 'Web', null, null, title, description, url, 'general', 'en', 'us', null,
      {_SECONDS.format(n='page_id')}, {_SECONDS.format(n='page_id')}, 'silver' from pages_clean
    union all select 'newsapi', 'talk.example.org', role, author, 'talk', text, 'https://talk.example.org/' || m, 'science',
      'en', 'us', text, {_SECONDS.format(n='m')}, {_SECONDS.format(n='m')}, 'silver' from talk
    union all select null, 'bench', cast(item_id as varchar), 'team', text, text, 'https://bench.example.org/' || item_id,
      'health', 'en', null, null, {_SECONDS.format(n='item_id')}, {_SECONDS.format(n='item_id')}, 'silver' from benchmark)
""".replace("'talk.example.org'", "'example'")
_SHOWN = ["source_system", "source_name", "article_id", "author", "title", "description", "url", "category", "language",
          "region", "content", "layer"]


def _shown(df: DataFrame) -> DataFrame:
    return df.select(*_SHOWN, F.unix_micros("published_at").alias("published_us"), F.unix_micros("createdate").alias("created_us"))


@BOOK.query("combined_job", f"with {_COMBINED_SQL} select * from combined")
def combined_job(spark, folder):
    return _shown(silver.combine(four_sources(spark, folder)))


@BOOK.query("combined_incremental", f"""with {_COMBINED_SQL},
  old as (select * from combined where source_system is null)
  select * from combined where published_us > (select max(published_us) from old)
  union all select * from old where url not in (
    select url from combined where published_us > (select max(published_us) from old))""")
def combined_incremental(spark, folder):
    sources = four_sources(spark, folder)
    target = stage(silver.combine({"staging": sources["staging"]}), "combined")  # what an earlier run has loaded
    return _shown(silver.refresh_combined(sources, target))


@BOOK.query("combined_ids", f"""with {_COMBINED_SQL},
  n as (select url, created_us // 1000 as ms, row_number() over (partition by created_us order by url) - 1 as seq
    from combined)
  select url, cast(((ms - {LAYOUT.epoch_ms}) << 22) | {LAYOUT.writer_part} | seq as varchar) as sf_id from n""")
def combined_ids(spark, folder):
    return silver.finish_combined(silver.combine(four_sources(spark, folder)), LAYOUT, ["url"]).select("url", "sf_id")


@BOOK.query("combined_quality", f"""with {_COMBINED_SQL}
  select 31 as rules, 31 - cast(count(*) filter (where published_us is null) > 0 as integer)
    - cast(count(*) filter (where length(title) not between 1 and 5000) > 0 as integer) as passed from combined""")
def combined_quality(spark, folder):
    rows = stage(silver.finish_combined(silver.combine(four_sources(spark, folder)), LAYOUT, ["url"]), "combined")
    return run_suite(rows, combined_suite()).agg(
        F.count(F.lit(1)).cast("int").alias("rules"), F.count_if("success").cast("int").alias("passed"))


# --- gold -------------------------------------------------------------------------------------------------

_GOLD_SQL = f"""{_COMBINED_SQL},
  raw as (select url as id, category from combined),
  r as (select id, case when category is not null and count(*) over (partition by category) < 5 then 'general'
    else category end as category from raw),
  f as (select id, {S.first_category('category')} as first from r),
  g as (select id, {S.allowed_or_default('first')} as category from f)
"""


@BOOK.query("gold_job", f"""with {_GOLD_SQL}
  select url, source_system, g.category, {S.feature_text('title')} as title_clean,
    {S.feature_text('description')} as description_clean, published_us, {S.category_code('g.category')} as category_encode
  from combined join g on id = url""")
def gold_job(spark, folder):
    made = gold.build(stage(silver.combine(four_sources(spark, folder)), "combined"))  # the job reads the stored table
    return made.select("url", "source_system", "category", "title_clean", "description_clean",
                       F.unix_micros("published_at").alias("published_us"), "category_encode")


# --- jobs from payload to stored table ----------------------------------------------------------------------

# a made-up article without a line end has its whole text for a title, so some break the suites' length rule and are split off
_TOO_LONG = "coalesce(length(title) not between 1 and 5000, false)"


def _stored(spark, path: str, like: DataFrame) -> DataFrame:
    return spark.read.schema(like.schema).parquet(path)


def _logged(done: dict, key: str) -> DataFrame:
    """What the run log says of a load, beside what the load says of itself."""
    return done["log"].select(
        F.lit(key).alias("job"), F.lit(done["rows_inserted"]).cast("long").alias("inserted"),
        (F.col("id_start") <= F.col("id_end")).alias("ordered"))


@BOOK.query("load_bronze", f"""with {ARTICLES_SQL},
  k as (select *, row_number() over (order by ord) - 1 as i from articles where category is not null)
  select id, url, 'currentsapi' as source_system,
    ((({NOW_MS} + (i >> 12)) - {LAYOUT.epoch_ms}) << 22) | {LAYOUT.writer_part} | (i & 4095) as sf_id from k""")
def load_bronze(spark, folder):
    """The bronze job run twice: the second run finds everything in place."""
    path = scratch_path(spark, "bronze")
    for _ in range(2):
        jobs.bronze_job(articles(spark, folder), "currentsapi", path, batch_id="run-1", now_ms=NOW_MS, layout=LAYOUT, order_by=["ord"])
    return _stored(spark, path, _bronze(spark, folder)).select("id", "url", "source_system", "sf_id")


@BOOK.query("load_bronze_others", """
  select 'mediastack' as job, count(*) as inserted, true as ordered from (select distinct url from pages)
  union all select 'newsapi', count(*), true from conversations""")
def load_bronze_others(spark, folder):
    p = table(spark, folder, "pages").dropDuplicates(["url"]).select(F.col("page_id").alias("ord"), "url")
    c = table(spark, folder, "conversations")
    m = F.col("conv_id") * 100 + F.col("turn")
    talk = bronze.flat_newsapi(c.select(
        m.alias("ord"), F.struct(F.col("role").alias("id"), F.lit("Talk").alias("name")).alias("source"),
        F.concat(F.lit("https://talk.example.org/"), m.cast("string")).alias("url"), F.col("text").alias("content")))
    out = None
    for rows, source in ((p, "mediastack"), (talk, "newsapi")):
        done = jobs.bronze_job(rows, source, scratch_path(spark, source), batch_id="run-1", now_ms=NOW_MS, layout=LAYOUT, order_by=["ord"])
        out = _logged(done, source) if out is None else out.unionByName(_logged(done, source))
    return out


@BOOK.query("load_silver", f"""with {_SILVER_SQL}
  select id, title, description, url, author, category, language, source_news, published_us, 'silver' as layer, {_TOO_LONG} as rejected
  from silver where category is not null""")
def load_silver(spark, folder):
    """Bronze stored, read back, cleaned, checked by the whole silver suite and stored; rows that break it apart."""
    raw, clean, rejects = (scratch_path(spark, k) for k in ("bronze", "silver", "rejects"))
    first = _bronze(spark, folder)
    jobs.bronze_job(articles(spark, folder), "currentsapi", raw, batch_id="run-1", now_ms=NOW_MS, layout=LAYOUT, order_by=["ord"])
    jobs.silver_job(_stored(spark, raw, first), "currentsapi", clean, now_ms=NOW_MS, order_by="ord", rejects=rejects)
    like = silver.clean(first, "currentsapi", "ord")
    shown = ["id", "title", "description", "url", "author", "category", "language", "source_news",
             F.unix_micros("published_at").alias("published_us"), "layer"]
    rejected = _stored(spark, rejects, like.withColumn("failed_rules", F.array(F.lit("")))).filter("array_contains(failed_rules, 'LengthBetween (title)')")
    return _stored(spark, clean, like).select(*shown, F.lit(False).alias("rejected")).unionByName(
        rejected.select(*shown, F.lit(True).alias("rejected")))


@BOOK.query("load_combined", f"""with {_COMBINED_SQL}
  select url, 21 as columns, 1 as ids, {_TOO_LONG} as rejected from combined""")
def load_combined(spark, folder):
    """The combined job: suites, unique ids, load; the stored table has the layout's columns and no others."""
    path, rejects = scratch_path(spark, "combined"), scratch_path(spark, "rejects")
    jobs.combined_job(four_sources(spark, folder), path, now_ms=NOW_MS, layout=LAYOUT, rejects=rejects)
    stored = spark.read.parquet(path).drop("__bucket").withColumn("rejected", F.lit(False))
    rejected = spark.read.parquet(rejects).drop("failed_rules").withColumn("rejected", F.lit(True))
    both = stored.unionByName(rejected)
    per_id = both.groupBy("sf_id").agg(F.count(F.lit(1)).cast("int").alias("ids"))
    return both.join(per_id, "sf_id").select("url", F.lit(len(both.columns) - 1).alias("columns"), "ids", "rejected")


@BOOK.query("load_combined_batch", f"""with {_COMBINED_SQL},
  u as (select distinct concat(url, '#', k) as url from combined, range(4) r(k)),
  n as (select url, row_number() over (order by url) - 1 as i from u)
  select url, cast((({NOW_MS} + (i >> 12) - {LAYOUT.epoch_ms}) << 22) | {LAYOUT.writer_part} | (i & 4095) as varchar) as sf_id from n""")
def load_combined_batch(spark, folder):
    """The combined job on rows that one batch made in the same millisecond, however many: their ids move on to the next."""
    path = scratch_path(spark, "combined")
    at = F.timestamp_millis(F.lit(NOW_MS))
    sources = {k: d.withColumn("createdate", at) if "createdate" in d.columns else d for k, d in four_sources(spark, folder).items()}
    # a URL's rows are made one before they become four, so that a quarter of them is moved
    rows = silver.combine(sources).dropDuplicates(["url"]).withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(3))))
    rows = rows.filter("url is not null or k = 0").withColumn("url", F.concat("url", F.lit("#"), F.col("k").cast("string"))).drop("k")
    rows = rows.withColumns({"createdate": at, "sf_id": F.lit(None).cast("string")})
    with passing(), shuffles_removed(spark):  # only the stored table is read later
        made = silver.finish_combined(rows, LAYOUT, ["url"])
        made.write.parquet(path)
    return _stored(spark, path, made).select("url", "sf_id")


@BOOK.query("load_gold", f"""with {_GOLD_SQL},
  e as (select url, concat_ws(' ', {S.feature_text('title')}, {S.feature_text('description')}) as t from combined where not {_TOO_LONG})
  select e.url, {S.category_code('g.category')} as category_encode, 64 as dim,
    case when len({S.words('t')}) > 0 then 1.0 else 0.0 end as length from e join g on id = e.url""")
def load_gold(spark, folder):
    """The gold job on a stored combined table, embedding included, stored by id."""
    combined, path = scratch_path(spark, "combined"), scratch_path(spark, "gold")
    jobs.combined_job(four_sources(spark, folder), combined, now_ms=NOW_MS, layout=LAYOUT, rejects=scratch_path(spark, "rejects"))
    jobs.gold_job(spark.read.parquet(combined).drop("__bucket"), path, now_ms=NOW_MS)
    size = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    return spark.read.parquet(path).select(
        "url", "category_encode", F.size("embedding").alias("dim"), F.round(F.sqrt(size), 4).alias("length"))


# --- corpora -------------------------------------------------------------------------------------------------

_LABELS = "case source when 'src1' then 'sports' when 'src2' then 'technology' else source end"


def _corpora(spark, folder) -> dict[str, DataFrame]:
    d = table(spark, folder, "documents")
    topic = F.when(F.col("source") == "src1", "sports").when(F.col("source") == "src2", "technology").otherwise(F.col("source"))
    c = table(spark, folder, "conversations")
    b = table(spark, folder, "benchmark")
    return {
        "warehouse": d.select("doc_id", F.col("doc_id").cast("string").alias("id"), F.col("lang").alias("titlenews"),
                              F.col("text").alias("description"), topic.alias("category"), F.col("lang").alias("language")),
        "sentiment": c.select((F.col("conv_id") * 100 + F.col("turn")).alias("doc_id"), F.col("role").alias("Title"),
                              F.col("text").alias("Description"), F.lit("Technology").alias("Type"), F.lit("x").alias("URL")),
        "labelled_tree": b.select(F.col("item_id").alias("doc_id"), F.lit("f").alias("filename"), F.lit(" Quiz ").alias("News Articles"),
                                  F.col("text").alias("Summaries"), F.lit("sports").alias("category")),
    }


@BOOK.query("corpus_training_set", f"""
  with a as (select distinct lang as t, text as d, {_LABELS} as c from documents
      union all select distinct role, text, 'Technology' from conversations
      union all select distinct ' Quiz ', text, 'sports' from benchmark),
  b as (select {S.strip('t')} as t, {S.strip('d')} as d, c from a),
  l as (select distinct lower(t) as t, lower(d) as d, lower(c) as c from b
    where t not in ('', ' ') and d not in ('', ' '))
  select t as title, d as description, case c when 'sports' then 'sport' when 'technology' then 'tech' else c end as categories
  from l""")
def corpus_training_set(spark, folder):
    return corpus.training_set(_corpora(spark, folder), "doc_id")


@BOOK.query("corpus_profile", """
  select source as label, dense_rank() over (order by source) - 1 as code, count(*) as count
  from documents group by source""")
def corpus_profile(spark, folder):
    d = table(spark, folder, "documents")
    found = corpus.profile(d, counts_of=["lang"], casts={"n_chars": "string"}, names={"source": "label"}, label="label")
    return found["encoded"].groupBy("label", F.col("encoded_label").alias("code")).agg(F.count(F.lit(1)).alias("count"))


@BOOK.query("title_words", f"""with {ARTICLES_SQL}
  select word, count(*) as n from (select unnest({S.words('title')}) as word from articles)
  group by word order by n desc, word limit 30""")
def title_words(spark, folder):
    found = corpus.title_statistics(articles(spark, folder), "ord", label="category")
    return found["top_words"]

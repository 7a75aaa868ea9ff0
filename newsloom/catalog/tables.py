"""Layout, dedup, union, join and load operators over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.catalog.book import ARTICLES_SQL, Book, articles, table
from newsloom.operators import frames as O
from newsloom.operators.dedup import keep_first, keep_first_successive
from newsloom.operators.profile import encode_labels, map_column
from newsloom.sinks import upsert as U

BOOK = Book()


# --- dedup -----------------------------------------------------------------------------------


@BOOK.query("dedup_keep_first", """
  select doc_id, lang, source, n_chars from documents
  qualify row_number() over (partition by text order by doc_id) = 1""")
def dedup_keep_first(spark, folder):
    return keep_first(table(spark, folder, "documents"), "text", "doc_id").drop("text")


@BOOK.query("dedup_successive", """
  with a as (select * from conversations qualify row_number() over (partition by text order by conv_id, turn) = 1),
  b as (select * from a qualify row_number() over (partition by conv_id order by turn) = 1)
  select conv_id, turn, role, text from b""")
def dedup_successive(spark, folder):
    return keep_first_successive(table(spark, folder, "conversations"), ["text", "absent", "conv_id"],
                                 ["conv_id", "turn"])


@BOOK.query("dedup_whole_rows", """
  select min(doc_id) as doc_id, text, lang, source, n_chars from documents group by text, lang, source, n_chars""")
def dedup_whole_rows(spark, folder):
    return keep_first_successive(table(spark, folder, "documents"), None, "doc_id")


# --- layout ------------------------------------------------------------------------------------


@BOOK.query("metadata_append", """
  select id, coalesce(nullif(author, 'N/A'), 'unknown') as author, 'run-1' as batch_id,
    cast(null as varchar) as userupdate, true as activedata, 'silver' as layer, cast(null as varchar) as region
  from (with """ + ARTICLES_SQL + """ select * from articles)""")
def metadata_append(spark, folder):
    a = articles(spark, folder).select("id", F.nullif(F.col("author"), F.lit("N/A")).alias("author"))
    a = O.append_metadata(a, {"author": "unknown", "batch_id": "run-1", "userupdate": None, "activedata": True})
    return O.ensure_column(O.stamp(a, layer="silver"), "region")


@BOOK.query("cast_rename_drop", """
  select cast(l_orderkey as varchar) as order_id, cast(l_quantity as bigint) as quantity, l_shipmode_missing
  from (select l_orderkey, l_quantity, cast(null as varchar) as l_shipmode_missing from lineitem)""")
def cast_rename_drop(spark, folder):
    df = O.drop_columns(table(spark, folder, "lineitem").select("l_orderkey", "l_quantity", "l_tax"),
                        ["l_tax", "absent"])
    df = O.cast_columns(df, {"l_orderkey": "string", "l_quantity": "bigint", "absent": "int"})
    df = O.rename_columns(df, {"l_orderkey": "order_id", "l_quantity": "quantity", "absent": "x"})
    return O.ensure_column(df, "l_shipmode_missing")


@BOOK.query("align_schema", """
  select c_custkey as id, c_name as name, cast(floor(c_acctbal) as bigint) as balance from customer""")
def align_schema(spark, folder):
    c = table(spark, folder, "customer")
    wild = c.select(F.col("c_custkey").alias("ID"), F.col("c_name").alias("Name"),
                    F.floor("c_acctbal").cast("double").alias("BALANCE"), F.col("c_mktsegment").alias("other"))
    target = T.StructType.fromDDL("id bigint, name string, balance bigint, city string")
    return O.align_to_schema(wild, target, ["id"])


@BOOK.query("json_flatten", """
  select event_id, event_type as "kind.type", user_id as "kind.user.id",
    cast(json_extract_string(props, '$.k') as bigint) as "props.k" from events""")
def json_flatten(spark, folder):
    e = table(spark, folder, "events").select(
        "event_id",
        F.struct(F.col("event_type").alias("type"), F.struct(F.col("user_id").alias("id")).alias("user")).alias("kind"),
        F.from_json("props", "struct<k: bigint>").alias("props"))
    return O.flatten_structs(e)


# --- filters -----------------------------------------------------------------------------------


@BOOK.query("drop_nulls", f"""with {ARTICLES_SQL}
  select id, author, category from articles where author not in ('N/A', '-') and category <> 'weather'""")
def drop_nulls(spark, folder):
    a = articles(spark, folder).select("id", "author", F.nullif(F.col("category"), F.lit("weather")).alias("category"))
    return O.require(O.drop_nulls(O.sentinels_to_null(a), ["author"]), "category")


@BOOK.query("missing_ids", """
  select count(*) filter (where doc_id % 3 <> 2) as missing, count(*) filter (where doc_id % 3 = 2) as present
  from documents""")
def missing_ids(spark, folder):
    n = F.col("doc_id")
    d = table(spark, folder, "documents").select(F.when(n % 3 == 1, "").when(n % 3 == 2, n.cast("string")).alias("sf"))
    absent = O.is_missing_id(F.col("sf"))
    return d.agg(F.count_if(absent).alias("missing"), F.count_if(~absent).alias("present"))


@BOOK.query("incremental_filter", """
  select e.event_id from events e
  where e.ts > (select max(ts) from events where ts < timestamp '2024-01-15')""")
def incremental_filter(spark, folder):
    e = table(spark, folder, "events")
    done = e.filter(F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz"))  # what earlier runs have loaded
    return O.newer_than(e, done, "ts").select("event_id")


# --- unions and joins --------------------------------------------------------------------------------


@BOOK.query("concat_by_name", """
  select 0 as part, doc_id as id, text, lang, cast(null as varchar) as role from documents
  union all select 1, item_id, text, null, null from benchmark
  union all select 2, conv_id, text, null, role from conversations""")
def concat_by_name(spark, folder):
    d = table(spark, folder, "documents").select(F.col("doc_id").alias("id"), "text", "lang")
    b = table(spark, folder, "benchmark").select(F.col("item_id").alias("id"), "text")
    c = table(spark, folder, "conversations").select(F.col("conv_id").alias("id"), "text", "role")
    return O.concat_frames([d, b, c], ordinal="part")


def _joined(how: str):
    return f"""select o_orderkey, c_custkey, o.status, c.status as status_customer, o_totalprice, c_acctbal
      from (select o_orderkey, o_custkey + 500 as k, o_orderstatus as status, o_totalprice from orders) o
      {how} join (select c_custkey as k, c_custkey, c_mktsegment as status, c_acctbal from customer) c using (k)"""


def _join(how):
    def run(spark, folder):
        o = table(spark, folder, "orders").select(
            "o_orderkey", (F.col("o_custkey") + 500).alias("k"), F.col("o_orderstatus").alias("status"), "o_totalprice")
        c = table(spark, folder, "customer").select(
            F.col("c_custkey").alias("k"), "c_custkey", F.col("c_mktsegment").alias("status"), "c_acctbal")
        return O.join_frames(o, c, "k", how, rsuffix="_customer").drop("k")

    return run


for _how, _sql in (("inner", "inner"), ("left", "left"), ("right", "right"), ("outer", "full outer")):
    BOOK.query(f"join_frames_{_how}", _joined(_sql))(_join(_how))


@BOOK.query("code_lookup", """
  select c_custkey, n_name from customer left join nation on c_nationkey = n_nationkey""")
def code_lookup(spark, folder):
    c = table(spark, folder, "customer").select("c_custkey", F.col("c_nationkey").alias("k"))
    n = table(spark, folder, "nation").select(F.col("n_nationkey").alias("k"), "n_name")
    return O.decode_by_table(c, n, "k").select("c_custkey", "n_name")


# --- encoders ------------------------------------------------------------------------------------------


@BOOK.query("label_encode", """
  select o_orderkey, o_orderpriority, dense_rank() over (order by o_orderpriority) - 1 as encoded_o_orderpriority
  from orders""")
def label_encode(spark, folder):
    return encode_labels(table(spark, folder, "orders").select("o_orderkey", "o_orderpriority"), "o_orderpriority")


@BOOK.query("map_encode", """
  select o_orderkey, o_orderstatus, case o_orderstatus when 'F' then 'filled' when 'O' then 'open'
    else o_orderstatus end as mapped_o_orderstatus from orders""")
def map_encode(spark, folder):
    return map_column(table(spark, folder, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus",
                      {"F": "filled", "O": "open"})


# --- loads -----------------------------------------------------------------------------------------------
# The target holds every order as loaded before; the batch holds every order again:
# a third unchanged, a third with another price, a third under new keys.

NOW = "2025-10-06 06:00:00"
THEN = "2025-01-01 00:00:00"


def target_and_batch(spark, folder):
    o = table(spark, folder, "orders")
    k = F.col("o_orderkey")
    target = o.select(
        k.alias("id"), F.col("o_orderpriority").alias("name"), F.col("o_totalprice").alias("price"),
        k.alias("sf_id"), F.lit(THEN).cast("timestamp").alias("createdate"), F.lit("system").alias("usercreate"),
        F.lit(None).cast("timestamp").alias("updatedate"), F.lit(None).cast("string").alias("userupdate"))
    batch = o.select(
        F.when(k % 3 == 2, -k - 1).otherwise(k).alias("ID"),
        F.when(k % 6 == 4, "").otherwise(F.col("o_orderpriority")).alias("name"),
        F.when(k % 3 == 1, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).alias("price"),
        (k + 1_000_000).alias("sf_id"))
    return target, batch


_LOAD_SQL = f"""
  t as (select o_orderkey as id, o_orderpriority as name, o_totalprice as price, o_orderkey as sf_id from orders),
  s as (select case when o_orderkey % 3 = 2 then -o_orderkey - 1 else o_orderkey end as id,
    nullif(case when o_orderkey % 6 = 4 then '' else o_orderpriority end, '') as name,
    case when o_orderkey % 3 = 1 then o_totalprice + 1 else o_totalprice end as price,
    o_orderkey + 1000000 as sf_id from orders),
  m as (select t.id as tid, s.id as sid, t.name as tname, s.name as sname, t.price as tprice, s.price as sprice,
      t.sf_id as tsf, s.sf_id as ssf,
      case when t.id is null then 'insert'
        when s.id is not null and (t.name is distinct from s.name or t.price is distinct from s.price) then 'update'
        else 'unchanged' end as action
    from t full join s on t.id = s.id),
  loaded as (select coalesce(tid, sid) as id,
      case when action = 'unchanged' then tname else sname end as name,
      case when action = 'unchanged' then tprice else sprice end as price,
      coalesce(tsf, ssf) as sf_id,
      case when action = 'insert' then '{NOW}' else '{THEN}' end as createdate, 'system' as usercreate,
      case when action = 'update' then '{NOW}' end as updatedate,
      case when action = 'update' then 'system' end as userupdate, action from m)
"""


def _stamps_as_text(df):
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("createdate", "updatedate")})


@BOOK.query("upsert_changed", f"with {_LOAD_SQL} select * from loaded")
def upsert_changed(spark, folder):
    target, batch = target_and_batch(spark, folder)
    return _stamps_as_text(U.classify(target, batch, ["id"], now=F.lit(NOW).cast("timestamp")))


@BOOK.query("upsert_report", f"""with {_LOAD_SQL}
  select count(*) filter (where action <> 'unchanged') as rows_upserted,
    count(*) filter (where action = 'insert') as rows_inserted,
    count(*) filter (where action = 'update') as rows_updated,
    count(*) filter (where action = 'unchanged') as rows_unchanged from loaded""")
def upsert_report(spark, folder):
    target, batch = target_and_batch(spark, folder)
    return U.load_report(U.classify(target, batch, ["id"], now=F.lit(NOW).cast("timestamp")))


@BOOK.query("upsert_insert_only", f"""with {_LOAD_SQL}
  select id, name, price, sf_id, '{THEN}' as createdate from t
  union all select id, name, price, sf_id, '{NOW}' from s where id not in (select id from t)""")
def upsert_insert_only(spark, folder):
    target, batch = target_and_batch(spark, folder)
    done = U.insert_only(target, batch, ["id"], now=F.lit(NOW).cast("timestamp"))
    return _stamps_as_text(done).select("id", "name", "price", "sf_id", "createdate")


@BOOK.query("incremental_merge", f"""with {_LOAD_SQL}
  select id, name, price from t where id not in (select id from s)
  union all select id, name, price from s""")
def incremental_merge(spark, folder):
    target, batch = target_and_batch(spark, folder)
    staged = U.stage_rows(target, batch, ["id"])
    return U.delete_insert(target.select("id", "name", "price"), staged.select("id", "name", "price"), ["id"])


@BOOK.query("upsert_last_wins", """
  with s as (select o_custkey as id, o_orderstatus as name, o_totalprice as price from orders
    qualify row_number() over (partition by o_custkey order by o_orderkey desc) = 1)
  select c_custkey as id, coalesce(s.name, c_mktsegment) as name, coalesce(s.price, c_acctbal) as price
  from customer left join s on c_custkey = s.id
  union all select id, name, price from s where id not in (select c_custkey from customer)""")
def upsert_last_wins(spark, folder):
    target = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("name"), F.col("c_acctbal").alias("price"),
        F.lit(None).cast("long").alias("loaded_from"))
    batch = table(spark, folder, "orders").select(
        F.col("o_custkey").alias("id"), F.col("o_orderstatus").alias("name"), F.col("o_totalprice").alias("price"),
        F.col("o_orderkey").alias("loaded_from"))
    done = U.classify(target, batch, ["id"], now=F.lit(NOW).cast("timestamp"), on_duplicate="last",
                      order_by=["loaded_from"])
    return done.select("id", "name", "price")

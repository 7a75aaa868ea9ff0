"""Named models, configuration lookups, schema checks and a plugged-in encoder over the given tables."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from newsloom.catalog.book import Book, table
from newsloom.ml import features as V
from newsloom.operators.frames import decode_by_table, missing_columns
from newsloom.operators.ids import active_config, registered_layout
from newsloom.operators.quality import null_columns, type_mismatches
from newsloom.plans import corpus
from newsloom.sinks.writers import materialize
from newsloom.sources.readers import inline_rows, read_source

BOOK = Book()


@BOOK.query("named_models", "select o_orderkey, o_custkey, o_totalprice from orders where o_orderstatus = 'F' and o_custkey is not null")
def named_models(spark, folder):
    """A staging view of orders, and a model that takes the rows of one status from it."""
    staged = table(spark, folder, "orders").filter("o_custkey is not null")
    materialize(staged, "newsloom_stg_orders", how="view")
    orders = read_source(spark, {"type": "table", "table": "newsloom_stg_orders"})
    return materialize(orders.filter(F.col("o_orderstatus") == "F"), "newsloom_final_orders", how="view").select("o_orderkey", "o_custkey", "o_totalprice")


@BOOK.query("inline_codes", """
  select o_orderkey, code from orders left join (values ('F', 1), ('O', 2), ('P', null)) c(status, code) on status = o_orderstatus""")
def inline_codes(spark, folder):
    codes = inline_rows(spark, [("F", 1), ("O", 2), ("P", None)], "o_orderstatus string, code int")
    return decode_by_table(table(spark, folder, "orders"), codes, "o_orderstatus").select("o_orderkey", "code")


@BOOK.query("registered_layouts", """
  with c as (select max(r_regionkey) filter (r_regionkey < 3) as latest from region)
  select version_no, n_regionkey as datacenter, n_nationkey as worker, epoch_ms from nation,
    (select latest as version_no, 1704067200000 + latest * 86400000 as epoch_ms from c union all select 1, 1704067200000 + 86400000)
  where n_nationkey = 7""")
def registered_layouts(spark, folder):
    """The layout of a registered source under the latest active configuration, and under a named version."""
    r, n = table(spark, folder, "region"), table(spark, folder, "nation")
    config = r.select(
        F.col("r_regionkey").cast("int").alias("version_no"), F.lit(5).alias("datacenter_bits"), F.lit(5).alias("worker_bits"),
        F.lit(12).alias("sequence_bits"), F.timestamp_millis(F.lit(1704067200000) + F.col("r_regionkey") * 86400000).alias("epoch_start"),
        (F.col("r_regionkey") < 3).alias("active_flag"))
    registry = n.select(F.concat(F.lit("source-"), F.col("n_nationkey").cast("string")).alias("source_name"), F.col("n_regionkey").cast("int").alias("datacenter_id"),
                        F.col("n_nationkey").cast("int").alias("worker_id"), (F.col("n_nationkey") != 8).alias("active_flag"))
    latest = active_config(config).version_no
    found = [registered_layout(config, registry, "source-7", v) for v in (None, 1)]
    rows = [(v, x.datacenter, x.worker, x.epoch_ms) for v, x in zip((latest, 1), found)]
    return inline_rows(spark, rows, "version_no int, datacenter int, worker int, epoch_ms long")


_NULLS = " union all ".join(f"select 'null' as finding, '{c}' as name where exists (select 1 from documents where {c} is null)"
                            for c in ("doc_id", "text", "lang", "source", "n_chars"))


@BOOK.query("schema_findings", f"""
  select 'missing' as finding, w.name from (values ('text'), ('headline'), ('lang'), ('url')) w(name)
    where w.name not in (select column_name from information_schema.columns where table_name = 'documents')
  union all select 'type', column_name from information_schema.columns where table_name = 'documents' and (column_name, data_type) in
    (('doc_id', 'BIGINT'), ('n_chars', 'BIGINT'))
  union all {_NULLS}""")
def schema_findings(spark, folder):
    """Columns that are missing, hold nulls, or have another type than expected."""
    d = table(spark, folder, "documents")
    found = [("missing", c) for c in missing_columns(d, ["text", "headline", "lang", "url"])]
    found += [("type", c) for c in type_mismatches(d, {"doc_id": "string", "text": "string", "n_chars": "int"})]
    found += [("null", c) for c in null_columns(d, ["doc_id", "text", "lang", "source", "n_chars"])]
    return inline_rows(spark, found, "finding string, name string")


def _letters():
    """An encoder of batches: code points and letters e of every text."""
    def encode(texts):
        return np.array([[len(t), t.count("e")] for t in texts], dtype=np.float32)

    return encode


@BOOK.query("embed_with_encoder", "select doc_id, length(text) as size, length(text) - length(replace(text, 'e', '')) as letters from documents where text is not null")
def embed_with_encoder(spark, folder):
    """Texts through a plugged-in batch encoder, loaded once per worker."""
    d = table(spark, folder, "documents").select("doc_id", "text").filter("text is not null")
    e = V.embed(d, "text", make_encoder=_letters)
    return e.select("doc_id", F.get("embedding", 0).cast("long").alias("size"), F.get("embedding", 1).cast("long").alias("letters"))


@BOOK.query("extract_report", "select (select count(*) from orders) as rows, o_orderkey from orders order by o_orderkey limit 5")
def extract_report(spark, folder):
    """Rows of a configured source, and its first ones."""
    materialize(table(spark, folder, "orders"), "newsloom_extract", how="view")
    report = corpus.extract_report(spark, {"type": "table", "table": "newsloom_extract"}, "o_orderkey")
    return inline_rows(spark, [(report["rows"], r["o_orderkey"]) for r in report["head"]], "rows long, o_orderkey long")

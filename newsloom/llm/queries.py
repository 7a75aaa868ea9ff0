"""The registered queries of this subpackage, with SQL where it can say the same over whole tables."""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.catalog.book import Book, table

from . import (
    context_mixing, hilbert_search, kneser_ney, line_dedup, mixing, near_dedup, passages, pieces, prefix_trie, secret_scan, spelling, topk,
    toxicity,
)

BOOK = Book()
query = BOOK.query


@query("op1_context_mixing")
def op1_context_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return context_mixing.score_texts(table(spark, folder, "documents"))


@query("op3_source_mix")
def op3_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


@query("op5_hilbert_nearest", """
with v as (
  select vec_id, cast(embedding as double[]) as e from embeddings
  where embedding is not null and len(embedding) > 0 and vec_id is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
s as (
  select q.vec_id as query_id, c.vec_id, max(list_inner_product(q.e, c.e)) as score
  from (select * from v where vec_id % 20 = 0) q join v c on c.vec_id <> q.vec_id and len(c.e) = len(q.e) group by 1, 2),
r as (
  select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score from s)
select * from r where rank <= 20""")
def op5_hilbert_nearest(spark: SparkSession, folder: str) -> DataFrame:
    return hilbert_search.nearest(table(spark, folder, "embeddings"))


@query("op6_secret_scan")
def op6_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan_secrets(table(spark, folder, "documents")))


@query("op8_exact_top_k", """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as e
  from embeddings where embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and vec_id is not null),
s as (
  select q.vec_id as query_id, c.vec_id,
    cast(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) as bigint) as score
  from (select * from v where vec_id % 100 = 0) q join v c on c.vec_id <> q.vec_id and len(c.e) = len(q.e)),
r as (
  select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score from s)
select * from r where rank <= 10""")
def op8_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(table(spark, folder, "embeddings"))


_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query("op2_near_dedup", rf"""with recursive
w as (select doc_id, regexp_extract_all({_LOWERED}, '[^\x20\x09-\x0D]+') as ws from documents),
g as (select distinct doc_id, md5(array_to_string(ws[i:i + 4], ' ')) as s
  from (select doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) as i from w where len(ws) > 0)),
n as (select doc_id, count(*) as n from g group by doc_id),
p as (select a.doc_id as a, b.doc_id as b, count(*) as k from g a join g b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2),
l as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * k >= 75 * (x.n + y.n - k)),
e as (select a, b from l union all select b, a from l),
r(doc_id, reached) as (select doc_id, doc_id from documents union select r.doc_id, e.b from r join e on e.a = r.reached)
select d.doc_id, cast(coalesce(n.n, 0) as bigint) as n_shingles, c.component_id, d.doc_id = c.component_id as kept
from documents d left join n on n.doc_id = d.doc_id
join (select doc_id, min(reached) as component_id from r group by doc_id) c on c.doc_id = d.doc_id""")
def op2_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_dup_table(table(spark, folder, "documents"))


@query("op4_line_dedup")
def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cut = line_dedup.remove_lines(table(spark, folder, "documents"))
    return cut.select("doc_id", "n_lines", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op9_passage_dedup", r"""
with w as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
v as (select doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) as h
  from (select doc_id, ws, unnest(range(1, len(ws) - 48)) as i from w where len(ws) >= 50)),
f as (select h, min(doc_id) as first from v group by h),
c as (select distinct doc_id, unnest(range(i, i + 50)) as at from v join f on v.h = f.h where first < doc_id),
x as (select doc_id, unnest(ws) as word, generate_subscripts(ws, 1) as at from w where len(ws) > 0),
k as (select x.doc_id, string_agg(word, ' ' order by x.at) as kept, count(*) as n
  from x left join c on c.doc_id = x.doc_id and c.at = x.at where c.at is null group by x.doc_id)
select w.doc_id, cast(len(ws) as bigint) as n_words, cast(len(ws) - coalesce(k.n, 0) as bigint) as n_removed,
  sha256(coalesce(kept, '')) as kept_sha256 from w left join k on k.doc_id = w.doc_id""")
def op9_passage_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cut = passages.remove_passages(table(spark, folder, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op7_sentencepiece")
def op7_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    encoded = pieces.encode_texts(table(spark, folder, "documents").select("doc_id", "text"), check=True)
    return encoded.select("doc_id", "n_ids", "ids", "round_trip")


@query("op10_quality_classifier")
def op10_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    judged = kneser_ney.judge_quality(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return judged.select("doc_id", "lang", "n_grams", "perplexity", "threshold", "kept")


def _crc32(text: str, of: str = "crc_table.t") -> str:
    """SQL for the unsigned crc32 of a text's UTF-8 bytes, with ``of`` as the table of remainders."""
    code = f"list_transform(range(cast(len(hex({text})) / 2 as bigint)), lambda i: cast(concat('0x', substr(hex({text}), 2 * i + 1, 2)) as bigint))"
    return f"xor(list_reduce(list_prepend(4294967295, {code}), lambda a, b: xor(a >> 8, {of}[1 + (xor(a, b) & 255)])), 4294967295)"


_CRC_TABLE = """crc_table as (select list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
  lambda a, b: case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end)) as t)"""


@query("op11_prefix_trie", f"""
with {_CRC_TABLE},
o as (select conv_id as c, list({{'r': coalesce(role, ''), 'x': coalesce(text, '')}} order by turn nulls first) as s
  from conversations where conv_id is not null group by conv_id),
h as (select c, s, {_crc32("cast(c as varchar)")} % 6 as h from o, crc_table),
n as (select a.c, case when a.c % 100 = 0 then a.s else coalesce(b.s[1:a.h], []) || a.s[a.h + 1:] end as s
  from h a left join o b on b.c = a.c - a.c % 100),
p as (select c, s, unnest(range(0, len(s) + 1)) as d from n),
m as (select s[1:d] as p, d, min(c) as conv_id, count(*) as n_convs, string_agg(cast(c as varchar), ',' order by c) filter (len(s) = d) as e
  from p group by 1, 2),
k as (select p[1:d - 1] as p, count(*) as n from m where d > 0 group by 1),
w as (select m.*, coalesce(k.n, 0) as n_children, case when d = 0 then 0 else (n_convs - 1) * len(m.p[d].x) end as w
  from m left join k on k.p = m.p),
u as (select p[1:i] as p, sum(w) as saved, count(*) filter (n_children = 0) as leaves from (select *, unnest(range(0, d + 1)) as i from w) group by 1)
select w.conv_id, w.d as depth, up.conv_id as parent_conv_id, w.n_convs, w.n_children, u.leaves as n_leaves,
  cast(u.saved as bigint) as saved_tokens, sha256(coalesce(w.e, '')) as ends_sha256
from w join u on u.p = w.p left join m up on up.d = w.d - 1 and up.p = w.p[1:w.d - 1]""")
def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.shared_head_trie(table(spark, folder, "conversations"))


@query("op12_spelling_variants", f"""
with recursive {_CRC_TABLE},
r as (select doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '{spelling.RUN}')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz') as w from documents),
d as (select doc_id, w, count(*) as n from r where length(w) >= 5 group by 1, 2),
h as (select w, n, {_crc32("concat(doc_id, ':', w)")} as h from d, crc_table),
c as (select case when h % 97 = 0 then concat(left(w, h % length(w)), substr(w, h % length(w) + 2)) else w end as w, n from h),
v as (select w, cast(sum(n) as bigint) as n from c where length(w) >= 5 group by w having sum(n) >= 3),
x as (select w, n, unnest(range(1, length(w) + 1)) as i from v),
y as (select distinct w, i, concat(left(w, i - 1), substr(w, i + 1)) as cut from x),
e as (select a.w as a, b.w as b from y a join y b on a.i = b.i and a.cut = b.cut and length(a.w) = length(b.w) and a.w <> b.w
  union select y.w, v.w from y join v on v.w = y.cut union select v.w, y.w from y join v on v.w = y.cut),
f as (select e.a as w, count(*) as n_near, arg_min(b, (-n, b)) as f, max(n) as fn from e join v on v.w = e.b group by e.a),
g as (select v.w, v.n, coalesce(n_near, 0) as n_near, case when fn >= 2 * v.n then f end as f, case when fn >= 2 * v.n then fn end as fn
  from v left join f on f.w = v.w),
t(w, root, f) as (select w, w, f from g union all select t.w, t.f, g.f from t join g on g.w = t.f)
select g.w as word, g.f as form, t.root, g.n, g.n_near, g.fn as form_n from g join t on t.w = g.w where t.f is null""")
def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.group_variants(spelling.word_counts(table(spark, folder, "documents")))


@query("op13_toxicity")
def op13_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("pipeline")
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_pipeline.run(spark, folder)

"""Features, selection, splits, models and metrics over whole tables."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsloom.catalog import sqltext as S
from newsloom.catalog.book import Book, articles, table, texts
from newsloom.ml import evaluate as E
from newsloom.ml import features as V
from newsloom.ml import lowrank
from newsloom.ml import models as M
from newsloom.ml import runs as R
from newsloom.ml import select as C
from newsloom.ml.score import score_texts, score_vectors
from newsloom.operators.ordering import dense_index
from newsloom.plans import gold, training
from newsloom.session import scratch_path, stage

BOOK = Book()

# --- long-form text features ----------------------------------------------------------------------

_BAG = f"""w as (select doc_id, unnest({S.words('text')}) as word from documents),
  bag as (select doc_id, word, count(*) as tf from w group by all)"""
_WEIGHTS = """n as (select count(*) as n from documents),
  idf as (select word, ln((1 + n) / (1 + count(*))) + 1 as idf from bag, n{where} group by word, n),
  raw as (select doc_id, word, tf * idf as x from bag join idf using (word)),
  tfidf as (select doc_id, word, x / sqrt(sum(x * x) over (partition by doc_id)) as weight from raw)"""


def _documents(spark, folder) -> DataFrame:
    return texts(spark, folder, "documents").select("doc_id", "text")


@BOOK.query("bag_of_words", f"with {_BAG} select * from bag")
def bag_of_words(spark, folder):
    return V.bag_of_words(_documents(spark, folder), "doc_id", "text")


@BOOK.query("tfidf", f"with {_BAG}, {_WEIGHTS.format(where='')} "
            "select doc_id, word, round(weight, 6) as weight from tfidf")
def tfidf(spark, folder):
    return V.tfidf(_documents(spark, folder), "doc_id", "text").withColumn("weight", F.round("weight", 6))


@BOOK.query("tfidf_top500", f"with {_BAG}, top as (select word from bag group by word order by sum(tf) desc, word "
            f"limit 500), {_WEIGHTS.format(where=' where word in (select word from top)')} "
            "select doc_id, word, round(weight, 6) as weight from tfidf")
def tfidf_top500(spark, folder):
    return V.tfidf(_documents(spark, folder), "doc_id", "text", max_features=500).withColumn(
        "weight", F.round("weight", 6))


_LABELLED = _BAG + ", lab as (select doc_id, quality as label from labels), v as (select * from bag join lab using (doc_id))"


def _labelled(spark, folder) -> tuple[DataFrame, DataFrame]:
    classes = table(spark, folder, "labels").select("doc_id", F.col("quality").alias("label"))
    labelled = _documents(spark, folder).join(classes, "doc_id", "left_semi")  # others need not be taken apart
    return V.bag_of_words(labelled, "doc_id", "text").join(classes, "doc_id"), classes


@BOOK.query("chi2_topk", f"""with {_LABELLED},
  s as (select label, count(*) / (select count(*) from lab) as share from lab group by label),
  o as (select word, s.label, share, coalesce(sum(tf) filter (where v.label = s.label), 0) as o, sum(tf) as t
    from v cross join s group by word, s.label, share),
  c as (select word, sum((o - share * t) ** 2 / (share * t)) as chi2 from o group by word)
  select word, round(chi2, 6) as chi2 from c order by round(chi2, 6) desc, word limit 50""")
def chi2_topk(spark, folder):
    values, classes = _labelled(spark, folder)
    scores = C.chi2_scores(values, classes).withColumn("chi2", F.round("chi2", 6))
    return C.top_features(scores, 50, "chi2")


@BOOK.query("mutual_info", f"""with {_LABELLED}, n as (select count(*) as n from lab),
  pl as (select label, count(*) as c from lab group by label),
  seen as (select word, label, count(*) as k from v group by all), f as (select word, sum(k) as t from seen group by word),
  cells as (select f.word, pl.label, c, t, n, coalesce(k, 0) as k from f cross join pl cross join n
    left join seen on seen.word = f.word and seen.label = pl.label),
  mi as (select word, sum(case when k > 0 then k / n * ln(k * n / (t * c)) else 0 end
    + case when c > k then (c - k) / n * ln((c - k) * n / ((n - t) * c)) else 0 end) as mi from cells group by word)
  select word, round(mi, 6) as mi from mi""")
def mutual_info(spark, folder):
    values, classes = _labelled(spark, folder)
    return C.mutual_information(values, classes).withColumn("mi", F.round(F.col("mi") + 0.0, 6))


# --- metrics ----------------------------------------------------------------------------------------

_SCORED = "s as (select label, cast((label * 7 + vec_id) % 10 as integer) as prediction from embeddings)"


def _scored(spark, folder) -> DataFrame:
    return table(spark, folder, "embeddings").select(
        "label", ((F.col("label") * 7 + F.col("vec_id")) % 10).cast("int").alias("prediction"))


@BOOK.query("confusion", f"with {_SCORED}, l as (select i as label from range(10) r(i)) "
            "select cast(l.label as integer) as label, " + ", ".join(
                f"count(*) filter (where prediction = {i}) as p_{i}" for i in range(10))
            + " from l left join s on l.label = s.label group by l.label")
def confusion(spark, folder):
    return E.confusion_matrix(_scored(spark, folder), list(range(10)))


@BOOK.query("class_report", f"""with {_SCORED},
  c as (select label as k from s union select prediction from s),
  x as (select cast(k as varchar) as class,
    (select count(*) from s where label = k and prediction = k) as hit,
    (select count(*) from s where prediction = k) as predicted,
    (select count(*) from s where label = k) as support from c),
  p as (select class, coalesce(hit / nullif(predicted, 0), 0) as precision, coalesce(hit / nullif(support, 0), 0) as recall,
    hit, support from x),
  r as (select class, precision, recall,
    case when precision + recall > 0 then 2 * precision * recall / (precision + recall) else 0 end as f1, hit, support
    from p),
  u as (select class, precision, recall, f1, support from r
    union all select 'accuracy', sum(hit) / sum(support), sum(hit) / sum(support), sum(hit) / sum(support), sum(support) from r
    union all select 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) from r
    union all select 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
      sum(f1 * support) / sum(support), sum(support) from r)
  select class, round(precision, 6) as precision, round(recall, 6) as recall, round(f1, 6) as f1,
    cast(support as bigint) as support from u""")
def class_report(spark, folder):
    return _rounded(E.classification_report(_scored(spark, folder)))


def _rounded(report: DataFrame) -> DataFrame:
    return report.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


@BOOK.query("regression_metrics", """
  with e as (select l_extendedprice as y, l_quantity * 1500 as p from lineitem)
  select round(avg((y - p) ** 2), 2) as mse, round(sqrt(avg((y - p) ** 2)), 4) as rmse,
    round(avg(abs(y - p)), 4) as mae, round(1 - avg((y - p) ** 2) / var_pop(y), 6) as r2 from e""")
def regression_metrics(spark, folder):
    df = table(spark, folder, "lineitem").select(
        F.col("l_extendedprice").alias("label"), (F.col("l_quantity") * 1500).alias("prediction"))
    return E.regression_metrics(df).select(
        F.round("mse", 2).alias("mse"), F.round("rmse", 4).alias("rmse"), F.round("mae", 4).alias("mae"),
        F.round("r2", 6).alias("r2"))


@BOOK.query("best_version", """
  with v as (select p_brand as version, min(p_partkey) as ordinal,
    case when p_brand <> 'Brand#7' then round(avg(p_size) / 50, 2) end as val_accuracy from part group by p_brand)
  select version, val_accuracy from v where val_accuracy is not null
  order by val_accuracy desc, ordinal limit 1""")
def best_version(spark, folder):
    versions = table(spark, folder, "part").groupBy(F.col("p_brand").alias("version")).agg(
        F.min("p_partkey").alias("ordinal"),
        F.when(F.first("p_brand") != "Brand#7", F.round(F.avg("p_size") / 50, 2)).alias("val_accuracy"))
    return R.best_version(versions)


# --- splits -------------------------------------------------------------------------------------------


@BOOK.query("stratified_split_sizes", """
  select label, count(*) as rows, cast(floor(count(*) * 0.4 + 0.5) as bigint) as test_rows
  from embeddings group by label""")
def stratified_split_sizes(spark, folder):
    split = M.stratified_split(_vectors(spark, folder), "label", "vec_id")
    return split.groupBy("label").agg(F.count(F.lit(1)).alias("rows"), F.count_if("is_test").alias("test_rows"))


@BOOK.query("kfold_sizes", """
  select label, cast(i as integer) as fold, (count(*) - i + 4) // 5 as rows
  from embeddings, range(5) r(i) group by label, i""")
def kfold_sizes(spark, folder):
    folded = M.stratified_folds(_vectors(spark, folder), "label", "vec_id")
    return folded.groupBy("label", "fold").agg(F.count(F.lit(1)).alias("rows"))


# --- vector features and models (no SQL form) ------------------------------------------------------------


def _vectors(spark, folder) -> DataFrame:
    e = table(spark, folder, "embeddings")
    return e.select("vec_id", "label", V.as_vector(F.col("embedding")).alias("features"))


def _texts(spark, folder) -> DataFrame:
    labels = table(spark, folder, "labels").select("doc_id", F.col("quality").cast("int").alias("label"))
    return _documents(spark, folder).join(labels, "doc_id")


@BOOK.query("pca_2d", """select count(*) as rows, 0.0 as mean_1, 0.0 as mean_2, 0.0 as cross, true as ordered from embeddings""")
def pca_2d(spark, folder):
    """The two components are centred and orthogonal, and the first has the larger variance."""
    v = _vectors(spark, folder)
    out = V.Pca(k=2).fit(v).transform(v).withColumn("p", vector_to_array("pca"))
    x, y = F.col("p")[0], F.col("p")[1]
    return out.agg(
        F.count(F.lit(1)).alias("rows"), _zero(F.avg(x)).alias("mean_1"), _zero(F.avg(y)).alias("mean_2"),
        _zero(F.avg(x * y)).alias("cross"), (F.var_pop(x) >= F.var_pop(y)).alias("ordered"))


def _zero(c):
    """A number of six digits without a sign on zero."""
    return F.round(c, 6) + F.lit(0.0)


@BOOK.query("pca_energy", """
  with x as (select unnest(embedding) as x, generate_subscripts(embedding, 1) as j from embeddings),
  d as (select j, sum(cast(x as double) * x) - sum(cast(x as double)) ** 2 / count(*) as e from x group by j)
  select round(sum(e), 3) as energy from d""")
def pca_energy(spark, folder):
    # all components of the centred vectors keep their sum of squares
    v = _vectors(spark, folder)
    out = V.Pca(k=64).fit(v).transform(v).withColumn("p", vector_to_array("pca"))
    return out.select(F.explode("p").alias("x")).agg(F.round(F.sum(F.col("x") * F.col("x")), 3).alias("energy"))


@BOOK.query("svd_energy", """
  select round(sum(list_sum(list_transform(embedding, lambda x: cast(x as double) * cast(x as double)))), 4) as energy
  from embeddings""")
def svd_energy(spark, folder):
    # a projection on all components keeps the sum of squares
    v = _vectors(spark, folder)
    out = V.Svd(k=64).fit(v).transform(v).withColumn("p", vector_to_array("svd"))
    return out.select(F.explode("p").alias("x")).agg(F.round(F.sum(F.col("x") * F.col("x")), 4).alias("energy"))


@BOOK.query("lsa_all_words", f"with {_BAG}, {_WEIGHTS.format(where='')} "
            "select count(distinct doc_id) as docs, count(distinct word) as words, 100 as components, round(sum(weight * weight), 3) as energy, "
            "true as orthonormal, true as kept_reaches_scales, true as within from tfidf")
def lsa_all_words(spark, folder):
    """TF-IDF with every word, reduced to 100 components."""
    weights = stage(V.tfidf(_documents(spark, folder), "doc_id", "text"), "lsa-weights")
    words = dense_index(weights.select("word").distinct(), "word", out="f")
    entries = weights.join(words, "word").select(F.col("doc_id").alias("id"), "f", F.col("weight").alias("value"))
    rows = stage(lowrank.entry_rows(entries), "lsa-rows")
    found = lowrank.truncated_svd(rows, 100, passes=2)
    scales = [float(s) for s in found.scales]
    norms = found.components().groupBy("component").agg(F.sum(F.col("weight") * F.col("weight")).alias("n"))
    projected = found.project(rows).select(F.posexplode("vector").alias("component", "x")).groupBy("component").agg(F.sum(F.col("x") * F.col("x")).alias("kept"))
    expected = spark.createDataFrame(list(enumerate(scales)), "component int, scale double")
    fits = norms.join(projected, "component").join(expected, "component").agg(
        F.bool_and(F.abs(F.col("n") - 1) < 1e-6).alias("orthonormal"),
        F.bool_and(F.sqrt("kept") >= F.col("scale") - 1e-6).alias("kept_reaches_scales"), F.sum("kept").alias("kept"))
    whole = weights.agg(F.countDistinct("doc_id").alias("docs"), F.countDistinct("word").alias("words"), F.sum(F.col("weight") * F.col("weight")).alias("energy"))
    return whole.join(F.broadcast(fits)).select(
        "docs", "words", F.lit(len(scales)).alias("components"), F.round("energy", 3).alias("energy"), "orthonormal", "kept_reaches_scales",
        (F.col("kept") <= F.col("energy")).alias("within"))


_FLAGS = "case l_returnflag when 'A' then 0 when 'N' then 1 else 2 end"


@BOOK.query("boosted_first_cuts", f"""
  with r as (select row_number() over () as id, {_FLAGS} as y, [cast(l_quantity as double), l_linenumber, l_discount, l_tax] as xs from lineitem),
  u as (select y, unnest(xs) as v, generate_subscripts(xs, 1) - 1 as f from r), n as (select count(*) as n from lineitem),
  k as (select i as class from range(3) c(i)),
  s as (select class, f, v, sum(1 / 3 - case when y = class then 1 else 0 end) as g, count(*) * 4 / 9 as h from u, k group by all),
  w as (select class, f, v, sum(g) over up as gl, sum(h) over up as hl, sum(g) over (partition by class, f) as g,
    sum(h) over (partition by class, f) as h from s window up as (partition by class, f order by v)),
  c as (select *, gl * gl / (hl + 1) + (g - gl) * (g - gl) / (h - hl + 1) - g * g / (h + 1) as gain from w where hl >= 1 and h - hl >= 1)
  select cast(class as integer) as class, cast(f as integer) as feature, v as threshold, round(-0.05 * gl / (hl + 1), 5) as left_value,
    round(-0.05 * (g - gl) / (h - hl + 1), 5) as right_value
  from c qualify row_number() over (partition by class order by gain desc, f, v) = 1""")
def boosted_first_cuts(spark, folder):
    """The first cut of each class's first tree, on values few enough that every one is a possible cut."""
    y = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2)
    x = F.array(*[F.col(c).cast("double") for c in ("l_quantity", "l_linenumber", "l_discount", "l_tax")])
    rows = table(spark, folder, "lineitem").select(y.alias("label"), V.as_vector(x).alias("features"))
    trees = M.make_stage("model", "xgb", n_estimators=1, max_depth=1, subsample=1.0, colsample_bytree=1.0).fit(rows).rounds()[0]
    found = [(k, trees["feature"][k][1], trees["threshold"][k][1], round(trees["value"][k][2], 5), round(trees["value"][k][3], 5)) for k in range(3)]
    return spark.createDataFrame(found, "class int, feature int, threshold double, left_value double, right_value double")


@BOOK.query("boosted_fit", """
  with c as (select label, count(*) as n from embeddings group by label)
  select sum(n) as rows, max(label) + 1 as classes, round(ln(max(label) + 1), 6) as first_loss, 4 as falls, true as above_majority from c""")
def boosted_fit(spark, folder):
    """Four rounds over the given vectors: the loss starts at that of a guess and falls with every round."""
    rows = _vectors(spark, folder)
    model = M.make_stage("model", "xgb", n_estimators=4, max_depth=2, learning_rate=0.3).fit(rows)
    losses = model.getOrDefault(model.losses)
    right = model.transform(rows).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("label"))).agg(
        F.count(F.lit(1)).alias("rows"), (F.max("label") + 1).alias("classes"), F.count_if(F.col("prediction") == F.col("label")).alias("right"), F.max("n").alias("majority"))
    return right.select("rows", "classes", F.lit(round(losses[0], 6)).alias("first_loss"), F.lit(sum(b < a for a, b in zip(losses, losses[1:]))).alias("falls"),
                        (F.col("right") > F.col("majority")).alias("above_majority"))


@BOOK.query("embed_texts", f"""select doc_id, 64 as dim, case when len({S.words('text')}) > 0 then 1.0 else 0.0 end as length
  from documents""")
def embed_texts(spark, folder):
    e = V.embed(_documents(spark, folder), "text")
    size = F.aggregate(F.transform("embedding", lambda x: x.cast("double") * x.cast("double")), F.lit(0.0),
                       lambda a, b: a + b)
    return e.select("doc_id", F.size("embedding").alias("dim"), F.round(F.sqrt(size), 4).alias("length"))


@BOOK.query("select_chi2", f"""with {_LABELLED},
  s as (select label, count(*) / (select count(*) from lab) as share from lab group by label),
  o as (select word, s.label, share, coalesce(sum(tf) filter (where v.label = s.label), 0) as o, sum(tf) as t
    from v cross join s group by word, s.label, share),
  c as (select word, sum((o - share * t) ** 2 / (share * t)) as chi2 from o group by word)
  select word from c order by chi2 desc, word limit 20""")
def select_chi2(spark, folder):
    """The words behind the chosen places of the count vectors."""
    t = _texts(spark, folder)
    counter = V.WordCounts(inputCol="text").fit(t)
    words = counter.stages[-1].vocabulary
    chosen = C.SelectChi2(k=20).fit(counter.transform(t)).getIndices()
    return spark.createDataFrame([(words[i],) for i in chosen], "word string")


@BOOK.query("select_mutual_info", """
  with x as (select label, cast(unnest(embedding) as double) as x, generate_subscripts(embedding, 1) - 1 as f from embeddings),
  e as (select f, min(x) as lo, (max(x) - min(x)) / 5 as w from x group by f),
  b as (select x.f, label, least(floor((x - lo) / w), 4) as v from x join e on x.f = e.f),
  n as (select f, label, v, count(*) as n from b group by all),
  l as (select f, label, sum(n) as n from n group by all), m as (select f, v, sum(n) as n from n group by all),
  t as (select count(*) as t from embeddings),
  s as (select n.f, sum(n.n / t * ln((n.n * t) / (l.n * m.n))) as mi from n join l on n.f = l.f and n.label = l.label
    join m on n.f = m.f and n.v = m.v, t group by n.f)
  select cast(f as integer) as feature from s order by mi desc, f limit 8""")
def select_mutual_info(spark, folder):
    chosen = C.SelectMutualInfo(k=8, bins=5).fit(_vectors(spark, folder)).getIndices()
    return spark.createDataFrame([(i,) for i in chosen], "feature int")


def _psi(n: str) -> str:
    """SQL for the digamma function."""
    x = f"(({n}) + 6.0)"
    return (f"(ln{x} - 1 / (2 * {x}) - 1 / (12 * {x} ** 2) + 1 / (120 * {x} ** 4) - 1 / (252 * {x} ** 6) - "
            + " - ".join(f"1 / (({n}) + {i}.0)" for i in range(6)) + ")")


@BOOK.query("mutual_info_nearest", f"""
  with x as (select vec_id as id, label, generate_subscripts(embedding, 1) - 1 as f, cast(unnest(embedding) as double) as x from embeddings),
  d as (select a.f, a.id, a.label, a.x, list_sort(list(abs(b.x - a.x))) as d
    from x a join x b on a.f = b.f and a.label = b.label and a.id <> b.id group by a.f, a.id, a.label, a.x),
  r as (select *, least(len(d), 3) as k, d[least(len(d), 3)] as r from d),
  c as (select f, label, count(*) as n from r group by f, label),
  m as (select a.f, a.id, count(*) filter (abs(b.x - a.x) < a.r or (a.r = 0 and b.x = a.x)) as m from r a join r b on a.f = b.f group by 1, 2),
  p as (select r.f, count(*) as n, avg({_psi("r.k")}) as pk, avg({_psi("c.n")}) as pc, avg({_psi("m.m")}) as pm
    from r join c on c.f = r.f and c.label = r.label join m on m.f = r.f and m.id = r.id group by r.f)
  select cast(f as integer) as f, round(greatest({_psi("n")} + pk - pc - pm, 0), 6) as mi from p""")
def mutual_info_nearest(spark, folder):
    scores = C.SelectMutualInfo().scores(_vectors(spark, folder))
    return scores.select("f", F.round("mi", 6).alias("mi"))


@BOOK.query("select_l1", "select vec_id, true as half from embeddings")
def select_l1(spark, folder):
    """At least half of the features reach the median weight."""
    v = _vectors(spark, folder)
    selected = C.SelectL1(C=1.0, maxIter=20).fit(v).transform(v)
    return selected.select("vec_id", (F.size(vector_to_array("selected")) * 2 >= F.size(vector_to_array("features"))).alias("half"))


_CONDITIONS = """
  select cast(k.i as integer) as class, cast(f.i as integer) as feature, (select count(*) from embeddings where label = k.i) as own, true as holds
  from range((select max(label) + 1 from embeddings)) k(i), range((select max(len(embedding)) + 1 from embeddings)) f(i)"""


def _conditions(spark, folder, penalty: str, c: float) -> DataFrame:
    """Whether each weight of a fitted model is where the objective is least, by slopes summed over all rows in SQL."""
    v = _vectors(spark, folder)
    w = M.SquaredHingeSvm(C=c, penalty=penalty, tol=1e-8).fit(v).weights()
    lines = spark.createDataFrame([(k, line.tolist()) for k, line in enumerate(w)], "class int, w array<double>")
    one = F.array(F.lit(1.0))
    rows = v.select("label", F.concat(vector_to_array("features"), one).alias("x")).join(F.broadcast(lines))  # one line per class
    z = F.when(F.col("label") == F.col("class"), 1.0).otherwise(-1.0)
    margin = F.aggregate(F.zip_with("x", "w", lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
    pull = rows.select("class", "label", "x", "w", (-2 * c * z * F.greatest(1 - z * margin, F.lit(0.0))).alias("pull"))
    weighed = F.transform(F.arrays_zip("x", "w"), lambda e: F.struct((e["x"] * F.col("pull")).alias("g"), e["w"].alias("w")))
    parts = pull.select("class", "label", F.posexplode(weighed).alias("feature", "e"))
    slopes = parts.groupBy("class", "feature").agg(F.sum("e.g").alias("g"), F.first("e.w").alias("w"), F.count_if(F.col("label") == F.col("class")).alias("own"))
    l1 = F.when(F.col("w") != 0, F.abs(F.col("g") + F.signum("w"))).otherwise(F.abs("g") - 1)
    off = F.abs(F.col("g") + F.col("w")) if penalty == "l2" else l1
    return slopes.select("class", "feature", "own", (off <= 1e-4).alias("holds"))


@BOOK.query("svm_optimum", _CONDITIONS)
def svm_optimum(spark, folder):
    return _conditions(spark, folder, "l2", 1.0)


@BOOK.query("l1_optimum", _CONDITIONS)
def l1_optimum(spark, folder):
    return _conditions(spark, folder, "l1", 0.1)


@BOOK.query("select_l1_svc", "select vec_id, true as half from embeddings")
def select_l1_svc(spark, folder):
    """At least half of the features reach the median weight, those that the penalty leaves at zero lose to any other."""
    v = _vectors(spark, folder)
    selected = M.make_stage("selector", "l1_svc", C=0.1).fit(v).transform(v)
    return selected.select("vec_id", (F.size(vector_to_array("selected")) * 2 >= F.size(vector_to_array("features"))).alias("half"))


def _support_sql(rows: str) -> str:
    """Rows of a report on a 0.4 test share: test rows per class, and scores that are shares."""
    return f"""with r as ({rows}), c as (select cast(label as varchar) as class,
      cast(floor(count(*) * 0.4 + 0.5) as bigint) as support from r group by label),
    t as (select cast(sum(support) as bigint) as support, max(support) / sum(support) as most from c)
    select class, support, true as shares, cast(null as double) as majority, cast(null as boolean) as reached from c
    union all select k, support, true, case when k = 'accuracy' then round(most, 6) end, case when k = 'accuracy' then true end
      from t, (values ('accuracy'), ('macro avg'), ('weighted avg')) v(k)"""


_QUALITY_ROWS = "select quality as label from documents join labels using (doc_id)"


def _report(estimator, rows: DataFrame, key: str) -> DataFrame:
    split = M.stratified_split(rows, "label", key)
    model = estimator.fit(split.filter("not is_test"))
    scored = model.transform(split.filter("is_test")).select("label", F.col("prediction").cast("int").alias("prediction"))
    return _supports(E.classification_report(scored))


def _supports(report: DataFrame) -> DataFrame:
    shares = F.lit(True)
    for c in ("precision", "recall", "f1"):
        shares = shares & F.col(c).between(0, 1)
    # the accuracy has to reach what always saying the largest class would
    per_class = ~F.col("class").isin("accuracy", "macro avg", "weighted avg")
    most = report.agg(F.max(F.when(per_class, F.col("support"))).alias("most"), F.sum(F.when(per_class, F.col("support"))).alias("all"))
    accuracy = F.col("class") == "accuracy"
    return report.join(F.broadcast(most)).select(
        "class", "support", shares.alias("shares"), F.when(accuracy, F.round(F.col("most") / F.col("all"), 6)).alias("majority"),
        F.when(accuracy, F.col("recall") >= F.col("most") / F.col("all") - 1e-9).alias("reached"))


@BOOK.query("logreg_report", _support_sql(_QUALITY_ROWS))
def logreg_report(spark, folder):
    config = {"steps": {
        "1_tfidf": {"kind": "fe", "name": "tfidf", "inputCol": "text", "max_features": 500},
        "2_chi2": {"kind": "selector", "name": "chi2", "k": 200},
        "3_model": {"kind": "model", "name": "logreg", "featuresCol": "selected", "maxIter": 20},
    }}
    return _report(M.pipeline_from_config(config), _texts(spark, folder), "doc_id")


@BOOK.query("svm_report", _support_sql(_QUALITY_ROWS))
def svm_report(spark, folder):
    config = {"steps": {
        "1_tfidf": {"kind": "fe", "name": "tfidf", "inputCol": "text", "max_features": 500},
        "2_chi2": {"kind": "selector", "name": "chi2", "k": 200},
        "3_model": {"kind": "model", "name": "linearsvc", "featuresCol": "selected", "maxIter": 20},
    }}
    return _report(M.pipeline_from_config(config), _texts(spark, folder), "doc_id")


@BOOK.query("gbt_report", _support_sql(_QUALITY_ROWS))
def gbt_report(spark, folder):
    config = {"steps": {
        "1_tfidf": {"kind": "fe", "name": "tfidf", "inputCol": "text", "max_features": 500},
        "2_chi2": {"kind": "selector", "name": "chi2", "k": 200},
        "3_model": {"kind": "model", "name": "xgb", "featuresCol": "selected", "n_estimators": 8, "max_depth": 3, "learning_rate": 0.3},
    }}
    return _report(M.pipeline_from_config(config), _texts(spark, folder), "doc_id")


def _texts_as_vectors(spark, folder) -> DataFrame:
    embedded = V.embed(_texts(spark, folder), "text")
    return embedded.select("doc_id", "label", V.as_vector(F.col("embedding")).alias("features"))


def _searched(summary: DataFrame) -> DataFrame:
    """Every setting tried, whether its rank is one more than how many settings score higher, and whether its scores can be."""
    other = summary.select(F.col("mean").alias("other"))
    higher = summary.join(other, F.col("other") > F.col("mean"), "left").groupBy("params", "rank", "mean", "std").agg(F.count("other").alias("higher"))
    return higher.select("params", (F.col("rank") == F.col("higher") + 1).alias("ranked"), (F.col("mean").between(0, 1) & (F.col("std") >= 0)).alias("shares"))


@BOOK.query("grid_search", """
  select concat('{''C'': ', c, '}') as params, true as ranked, count(*) > 0 as shares from documents join labels using (doc_id), (values ('0.1'), ('1.0')) v(c)
  group by c""")
def grid_search(spark, folder):
    found = M.grid_search(M.Logistic(maxIter=5), {"C": [0.1, 1.0]}, _texts_as_vectors(spark, folder), key="doc_id", folds=3)
    return _searched(M.search_summary(spark, found))


@BOOK.query("random_search", """
  select concat('{''C'': ', c, ', ''maxIter'': ', m, '}') as params, true as ranked, count(*) > 0 as shares
  from documents join labels using (doc_id), (values ('0.1'), ('1.0'), ('10.0')) v(c), (values (2), (4)) w(m) group by c, m""")
def random_search(spark, folder):
    found = M.random_search(M.Logistic(), {"C": [0.1, 1.0, 10.0], "maxIter": [2, 4]}, _texts_as_vectors(spark, folder),
                            draws=6, key="doc_id", folds=2)
    return _searched(M.search_summary(spark, found))


def _fits(scored: DataFrame, key: str) -> DataFrame:
    """Whether every row has a known category and a confidence that is a share."""
    known = F.col("category_encode").between(0, 7) & F.col("category").isNotNull() & F.col("confidence").between(0, 1)
    return scored.select(key, F.coalesce(known, F.lit(False)).alias("fits"))


def _reached(scored: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """Whether the scored rows with a label agree with it as often as always saying the largest class would."""
    met = scored.join(labels, key).groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("category_encode") == F.col("label")).alias("right"))
    return met.agg((F.sum("right") >= F.max("n")).alias("reached"))


@BOOK.query("train_on_vectors", "select doc_id as sf_id, true as fits from documents")
def train_on_vectors(spark, folder):
    """The embedding classifier from gold rows, trained, logged, saved, chosen and used on all rows."""
    rows = training.vectors_from_gold(_gold(spark, folder))
    done = training.train_on_vectors(rows, "sf_id", space={"max_depth": [2], "n_estimators": [2]}, folds=2)
    runs, models = scratch_path(spark, "runs"), scratch_path(spark, "models")
    training.record(done, runs, models, "run-1", 1)
    best = R.load_best_model(spark, runs, models)
    return _fits(score_vectors(best, rows), "sf_id")


def _gold(spark, folder) -> DataFrame:
    a = articles(spark, folder).select(
        F.col("ord").alias("sf_id"), "url", F.lit("currentsapi").alias("source_system"), "category", "title",
        "description", F.lit(None).cast("timestamp").alias("published_at"))
    return gold.build(a)


@BOOK.query("train_on_texts", _support_sql(_QUALITY_ROWS))
def train_on_texts(spark, folder):
    done = training.train_on_texts(_texts(spark, folder), "doc_id", space={"C": [1.0], "maxIter": [5]}, folds=2,
                                   max_features=200)
    return _supports(done["report"])


@BOOK.query("batch_score", f"select doc_id, true as fits, true as reached from documents where {S.strip('text')} <> ''")
def batch_score(spark, folder):
    texts = _documents(spark, folder)
    rows = _texts_as_vectors(spark, folder)
    scored = stage(score_texts(M.Logistic(maxIter=30).fit(rows), texts), "scored")
    return _fits(scored, "doc_id").join(F.broadcast(_reached(scored, rows.select("doc_id", "label"), "doc_id")))

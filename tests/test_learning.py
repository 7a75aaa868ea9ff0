import math
import random

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from newsloom.ml import evaluate as E
from newsloom.ml import features as V
from newsloom.ml import models as M
from newsloom.ml import runs as R
from newsloom.ml import select as C
from newsloom.ml.score import score_one, score_texts, split_blank
from newsloom.plans import training


@pytest.fixture(scope="module")
def headlines(spark):
    """Separable headlines: sport words against market words."""
    draw = random.Random(3)
    topics = [["goal", "match", "team", "coach", "league"], ["stock", "market", "bank", "price", "trade"]]
    rows = [(i, " ".join(draw.choices(topics[i % 2], k=5) + draw.choices(["the", "today", "new"], k=2)), i % 2) for i in range(120)]
    return spark.createDataFrame(rows, "id long, text string, label int").cache()


@pytest.fixture(scope="module")
def vectors(headlines):
    e = V.embed(headlines, "text")
    return e.select("id", "label", V.as_vector(F.col("embedding")).alias("features")).cache()


def test_tfidf_vector_equals_long_form(spark, headlines):
    long = V.tfidf(headlines, "id", "text")
    total = {r["id"]: sorted(round(x, 9) for x in r["w"]) for r in long.groupBy("id").agg(F.collect_list("weight").alias("w")).collect()}
    model = V.Tfidf(inputCol="text", max_features=1000).fit(headlines)
    for r in model.transform(headlines).select("id", vector_to_array("features").alias("f")).collect():
        assert sorted(round(x, 9) for x in r["f"] if x) == total[r["id"]]


def test_tfidf_with_a_shuffled_lookup(headlines):
    small = {(r["id"], r["word"]): r["weight"] for r in V.tfidf(headlines, "id", "text").collect()}
    large = {(r["id"], r["word"]): r["weight"] for r in V.tfidf(headlines, "id", "text", max_bytes=0).collect()}
    assert small.keys() == large.keys() and all(math.isclose(small[k], large[k]) for k in small)


def test_chi2_and_mutual_info_select_the_same_words(headlines):
    classes = headlines.select("id", "label")
    bag = V.bag_of_words(headlines, "id", "text").join(classes, "id")
    for scores, name in ((C.chi2_scores(bag, classes), "chi2"), (C.mutual_information(bag, classes), "mi")):
        best = {r["word"] for r in C.top_features(scores, 10, name).collect()}
        assert best == {"goal", "match", "team", "coach", "league", "stock", "market", "bank", "price", "trade"}


def test_vector_selectors(headlines):
    counted = V.WordCounts(inputCol="text", max_features=100)
    model = counted.fit(headlines)
    df = model.transform(headlines)
    words = model.stages[-1].vocabulary
    for selector in (C.SelectChi2(k=10), C.SelectMutualInfo(k=10, bins=4)):
        picked = {words[i] for i in selector.fit(df).getIndices()}
        assert not picked & {"the", "today", "new"}
    kept = C.SelectL1(C=1.0, threshold="median").fit(df).getIndices()
    assert 0 < len(kept) <= len(words)


def test_projections(spark):
    x = np.random.default_rng(0).normal(size=(60, 4)) @ np.diag([5.0, 2.0, 1.0, 0.1]) + 3.0
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "i int, v array<double>")
    df = df.select("i", V.as_vector(F.col("v")).alias("features")).repartition(5)
    svd = V.Svd(k=2).fit(df)
    got = np.array([r["p"] for r in svd.transform(df).orderBy("i").select(vector_to_array("svd").alias("p")).collect()])
    _, s, vt = np.linalg.svd(x, full_matrices=False)
    assert np.allclose(np.abs(got), np.abs(x @ vt[:2].T)) and np.allclose(svd.getOrDefault(svd.scales), s[:2])
    pca = V.Pca(k=2).fit(df).transform(df).orderBy("i").select(vector_to_array("pca").alias("p")).collect()
    centred = x - x.mean(axis=0)
    _, _, vt = np.linalg.svd(centred, full_matrices=False)
    assert np.allclose(np.abs(np.array([r["p"] for r in pca])), np.abs(centred @ vt[:2].T))


def test_plugged_in_encoder(spark):
    def make():
        def encode(texts):
            return np.array([[len(t), 1.0] for t in texts], dtype="float32")
        return encode

    df = spark.createDataFrame([("ab",), ("abcd",)], "text string")
    assert sorted(r["embedding"] for r in V.embed(df, "text", make_encoder=make).collect()) == [[2.0, 1.0], [4.0, 1.0]]


def test_split_is_exact_repeatable_and_safe_for_hot_classes(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") < 700, 0).otherwise(1 + F.col("id") % 3).alias("label"))
    plain = {r["id"] for r in M.stratified_split(df, "label", "id").filter("is_test").collect()}
    cut = M.stratified_split(df.repartition(7), "label", "id", ranges=5)
    assert {r["id"] for r in cut.filter("is_test").collect()} == plain
    assert [tuple(r) for r in cut.groupBy("label").agg(F.count_if("is_test")).orderBy("label").collect()] == [
        (0, 280), (1, 40), (2, 40), (3, 40)]
    folds = M.stratified_folds(df, "label", "id").groupBy("label", "fold").count().filter("label = 0").collect()
    assert sorted(r["count"] for r in folds) == [140] * 5


def test_pipeline_rules():
    steps = {"10_model": M.make_stage("MODEL", "LogReg"), "2_fe": M.make_stage("fe", "count")}
    with pytest.raises(ValueError, match="2_fe"):  # text order puts 10 before 2
        M.pipeline_from_steps(steps)
    assert len(M.pipeline_from_steps({"1_fe": steps["2_fe"], "2_model": steps["10_model"]}).getStages()) == 2
    for bad in (lambda: M.pipeline_from_steps({}), lambda: M.make_stage("x", "y"), lambda: M.make_stage("fe", "y")):
        with pytest.raises(ValueError):
            bad()


@pytest.mark.parametrize("model", [
    {"kind": "model", "name": "logreg", "maxIter": 10}, {"kind": "model", "name": "linearsvc", "maxIter": 10},
    {"kind": "model", "name": "xgb", "n_estimators": 5, "max_depth": 2}])
def test_models_learn(headlines, model):
    pipe = M.pipeline_from_config({"steps": {"1": {"kind": "fe", "name": "bow", "inputCol": "text", "max_features": 50}, "2": model}})
    split = M.stratified_split(headlines, "label", "id")
    scored = pipe.fit(split.filter("not is_test")).transform(split.filter("is_test"))
    report = E.classification_report(scored.select("label", F.col("prediction").cast("int").alias("prediction")))
    assert report.filter("class = 'accuracy'").first()["f1"] > 0.9


def test_report_arithmetic(spark):
    pairs = [(0, 0)] * 3 + [(0, 1)] + [(1, 1)] * 2 + [(2, 0)]
    df = spark.createDataFrame(pairs, "label int, prediction int")
    got = {r["class"]: r for r in E.classification_report(df).collect()}
    assert got["0"]["precision"] == 0.75 and got["0"]["recall"] == 0.75 and got["2"]["f1"] == 0.0
    assert got["accuracy"]["f1"] == pytest.approx(5 / 7) and got["macro avg"]["recall"] == pytest.approx((0.75 + 1 + 0) / 3)
    assert got["weighted avg"]["support"] == 7
    keys = {r["key"] for r in E.report_metrics(E.classification_report(df), "val_").collect()}
    assert {"val_accuracy", "val_f1_macro_avg", "val_f1_class_2"} <= keys
    matrix = [tuple(r) for r in E.confusion_matrix(df, [0, 1, 3]).collect()]
    assert matrix == [(0, 3, 1, 0), (1, 0, 2, 0), (3, 0, 0, 0)]


def test_best_version(spark):
    rows = [("1", 1, 0.5), ("2", 2, None), ("3", 3, 0.9), ("4", 4, 0.9)]
    df = spark.createDataFrame(rows, "version string, ordinal long, val_accuracy double")
    assert R.best_version(df).first()["version"] == "3"
    assert R.best_version(df.filter("version = '2'")).first()["version"] is None


def test_search(vectors):
    found = M.random_search(M.Logistic(maxIter=5), {"C": [0.001, 1.0, 10.0]}, vectors, draws=2, key="id", folds=2)
    assert len(found.avgMetrics) == 2
    summary = M.search_summary(vectors.sparkSession, found).collect()
    assert summary[0]["rank"] == 1 and summary[0]["mean"] == max(found.avgMetrics)
    model = M.train_with_params(M.Logistic(), {"C": 1.0, "maxIter": 3}, vectors)
    assert model.numClasses == 2
    with pytest.raises(ValueError):
        M.parameter_grid(M.Logistic(), {"depth": [1]})


def test_train_record_choose_score(spark, vectors, headlines, tmp_path):
    runs, models = str(tmp_path / "runs"), str(tmp_path / "models")
    for version, trees in ((1, 1), (2, 4)):
        done = training.train_on_vectors(vectors, "id", space={"max_depth": [2], "n_estimators": [trees]}, folds=2, parallelism=1)
        training.record(done, runs, models, f"run-{version}", version)
    versions = R.versions_from_runs(R.read_runs(spark, runs))
    assert versions.count() == 2
    best = R.load_best_model(spark, runs, models)
    scored = score_texts(best, headlines)
    assert scored.count() == 120 and scored.filter("confidence <= 0 or confidence > 1").count() == 0
    hits = scored.filter("category_encode = label").count()
    assert hits > 90
    assert set(score_one(best, spark, "goal match team")) == {"category_encode", "category", "confidence"}
    with pytest.raises(ValueError):
        score_one(best, spark, "  ")
    usable, rejected = split_blank(spark.createDataFrame([("a",), (" ",), (None,)], "text string"), "text")
    assert (usable.count(), rejected.count()) == (1, 2)


def test_train_on_texts(headlines):
    done = training.train_on_texts(headlines, "id", space={"C": [1.0], "maxIter": [5]}, folds=2, max_features=50)
    assert done["report"].filter("class = 'accuracy'").first()["f1"] > 0.9 and done["best_params"] == {"C": 1.0, "maxIter": 5}


def test_tasks_of_the_bag_follow_the_texts(spark):
    big = spark.range(12).select("id", F.repeat(F.lit("x"), 9 << 20).alias("text"))
    assert V.text_tasks(big, "text") == 14 and V.text_tasks(big.limit(0), "text") == 8
    assert V.bag_of_words(big, "id", "text").rdd.getNumPartitions() == 14  # was 8 at most, however long the texts
    small = spark.createDataFrame([(1, "ab cd ab"), (1, "ab"), (None, "cd"), (2, None)], "id long, text string")
    found = V.bag_of_words(small, "id", "text", tasks=3).collect()
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, [(1, "ab", 3), (1, "cd", 1), (None, "cd", 1)]))

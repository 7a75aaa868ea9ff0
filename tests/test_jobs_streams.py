import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.catalog.book import articles
from newsloom.functions.ids import IdLayout
from newsloom.operators.ids import run_summary
from newsloom.operators.quality import bronze_suite, enforce, run_suite, silver_suite
from newsloom.plans import bronze, corpus, gold, silver
from newsloom.sources.snapshots import write_snapshot
from newsloom.streaming import incremental as Z

LAYOUT = IdLayout()
NOW = 1759730400123


def test_payload_to_gold(spark):
    rows = [("1", "A &amp; <b>b</b>", "d", "https://www.bbc.co.uk/1", "N/A", "EN", "science", "2025-10-06 06:00:00"),
            ("2", "t", "-", " https://x.example.com/2 ", "me", "en", "poiltics", "2025-10-06T06:00:00Z"),
            ("3", "dup", "d", "https://www.bbc.co.uk/1", "me", "en", "science", "2025-10-06T06:00:00Z"),
            ("4", "no category", "d", "https://a/4", "me", "en", None, "2025-10-06T06:00:00Z"),
            ("5", "bad url", "d", "ftp://a/5", "me", "en", "health", "2025-10-06T06:00:00Z")]
    raw = spark.createDataFrame(rows, "id string, title string, description string, url string, author string, "
                                      "language string, category string, published string")
    landed = bronze.currentsapi(raw, batch_id="b", now_ms=NOW, layout=LAYOUT, order_by=["id"])
    enforce(run_suite(landed, bronze_suite()[:8]))
    assert landed.count() == 4 and landed.select("sf_id").distinct().count() == 4
    clean = silver.clean(landed, "currentsapi", "id")
    enforce(run_suite(clean, silver_suite()))
    got = {r["id"]: r for r in clean.collect()}
    assert set(got) == {"1", "2"}
    assert (got["1"]["title"], got["1"]["author"], got["1"]["source_news"], got["1"]["language"]) == ("A b", None, "co", "en")
    assert got["2"]["description"] is None and got["2"]["url"] == "https://x.example.com/2"
    assert str(got["1"]["published_at"]) == "2025-10-05 23:00:00" and got["1"]["layer"] == "silver"
    combined = silver.finish_combined(silver.combine({"currentsapi": clean.withColumn("image_url", F.lit(None).cast("string"))}), LAYOUT, ["url"])
    silver.check_combined(combined)
    made = gold.build(combined).collect()
    assert made[0].asDict().keys() == set(gold.build(combined).columns) and all(len(r["embedding"]) == 64 for r in made)
    assert {r["category"] for r in made} == {"general"}  # fewer than five of each
    log = run_summary(combined, source_col="source_system", job_name="j").collect()
    assert len(log) == 1 and log[0]["id_start"] <= log[0]["id_end"]


def test_source_differences(spark):
    raw = spark.createDataFrame([("https://a/1", " CNN ", "TH", "us", "http://i", "2025-10-06T06:00:00Z", "t")],
                                "url string, source string, language string, country string, image string, published_at string, title string")
    row = silver.clean(bronze.mediastack(raw, batch_id="b", now_ms=NOW, layout=LAYOUT, order_by=["url"]), "mediastack", "url").first()
    assert (row["source_news"], row["language"], row["region"], row["image_url"]) == ("CNN", "th", "us", "http://i")
    nested = spark.createDataFrame([(("i", "n"), "https://www.bbc.co.uk/1", "ftp://i", "2025-10-06T06:00:00Z", "c <b>d</b>", "health")],
                                   "source struct<id: string, name: string>, url string, urlToImage string, publishedAt string, content string, category string")
    row = silver.clean(bronze.newsapi(bronze.flat_newsapi(nested), batch_id="b", now_ms=NOW, layout=LAYOUT, order_by=["url"]), "newsapi", "url").first()
    assert (row["source_news"], row["image_url"], row["content"], row["region"], row["source_id"]) == ("co", None, "c d", "us", "i")


def test_category_arrays_become_lists(spark):
    raw = spark.createDataFrame([("1", "https://a/1", ["technology", "science"], "2025-10-06T06:00:00Z")],
                                "id string, url string, category array<string>, published string")
    assert silver.clean(raw, "currentsapi", "id").first()["category"] == "technology,science"


def test_incremental_run_twice(spark, folder):
    a = articles(spark, folder)
    base = silver.clean(bronze.currentsapi(a, batch_id="b", now_ms=NOW, layout=LAYOUT, order_by=["ord"]), "currentsapi", "ord")
    base = base.withColumn("region", F.lit(None).cast("string"))
    source = {"currentsapi": base}
    full = silver.refresh_combined(source, silver.empty_combined(spark))
    assert full.count() == base.count()
    again = silver.refresh_combined(source, full)
    assert again.count() == full.count() and again.select("url").distinct().count() == full.count()


def test_stream_in_several_batches_equals_batch(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    for i in range(4):
        news = [{"n": i * 10 + j, "url": f"https://a/{(i * 10 + j) % 25}", "title": f"t{i * 10 + j}", "published": "2025-10-06T06:00:00Z"} for j in range(10)]
        (landing / f"{i}.json").write_text(json.dumps({"news": news}))
    schema = T.StructType.fromDDL("news array<struct<n: int, url: string, title: string, published: string>>")
    target = T.StructType.fromDDL("n int, url string, title string, published_at timestamp, source_news string, region string, layer string")
    path = str(tmp_path / "silver")

    def run():
        rows = Z.read_landing(spark, str(landing), schema, max_files=1)
        Z.stream_to_silver(rows, "currentsapi", path, str(tmp_path / "cp"), order_by="n", target_schema=target, now_ms=NOW).awaitTermination()
        return spark.read.schema(target).parquet(path)

    first = run()
    assert first.count() == 25 and first.select("url").distinct().count() == 25
    assert run().count() == 25  # nothing new, nothing changes


def test_first_seen_stream(spark, tmp_path):
    spark.createDataFrame([("u", "2025-01-01 00:00:00"), ("u", "2025-01-01 01:00:00"), ("v", "2025-01-01 02:00:00")],
                          "url string, published_at string").withColumn("published_at", F.to_timestamp("published_at")).write.parquet(str(tmp_path / "in"))
    rows = spark.readStream.schema("url string, published_at timestamp").parquet(str(tmp_path / "in"))
    Z.append_stream(Z.first_seen(rows), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert sorted(r["url"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["u", "v"]


def test_corpus(spark, tmp_path):
    db = spark.createDataFrame([(0, " T ", "D", "Sports", "x"), (1, " T ", "D", "Sports", "x"), (2, "", "D", "a", "x"), (3, "u", None, "a", "x")],
                               "n int, titlenews string, description string, category string, url string")
    tree = spark.createDataFrame([(0, "f", "t", "d", "sport"), (1, "f", "Tech", "d", "technology")], "n int, filename string, `News Articles` string, Summaries string, category string")
    made = corpus.training_set({"warehouse": db, "labelled_tree": tree}, "n")
    assert sorted(map(tuple, made.collect())) == [("t", "d", "sport"), ("t", "d", "sport"), ("tech", "d", "tech")]
    loose = corpus.clean_corpus(db, "warehouse", "n", need_both=False)
    assert loose.count() == 2
    corpus.write_training_set({"warehouse": db}, "n", str(tmp_path / "set"), "20250101_000000")
    stats = corpus.title_statistics_of(spark, str(tmp_path / "set"), "title")
    assert stats["encoded"].count() == 1


def test_extract_report(spark, tmp_path):
    write_snapshot(spark.range(20), str(tmp_path / "t"))
    done = corpus.extract_report(spark, {"type": "dvc", "path": str(tmp_path / "t")}, "id")
    assert done["rows"] == 20 and [r["id"] for r in done["head"]] == [0, 1, 2, 3, 4] and done["seconds"] >= 0

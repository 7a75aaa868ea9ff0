"""Run the headline queries and print one JSON line.

Folder from ``BENCH_SF_DIR``, cores from ``BENCH_CPUS``. Each query runs once to
warm up and then ``BENCH_RUNS`` times (default 1); the median is reported. All
rows and columns are computed: results go to Spark's no-op sink.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINES = [
    "normalize_text", "normalize_text_pages", "clean_keep_meaning", "feature_text", "normalize_timestamp", "root_domain",
    "dedup_keep_first", "dedup_successive", "rare_to_general", "label_encode",
    "snowflake_assign", "snowflake_bulk", "snowflake_rank", "snowflake_decode",
    "concat_by_name", "join_frames_left", "upsert_changed", "upsert_report", "incremental_merge", "incremental_filter",
    "value_counts", "describe", "histogram", "dq_suite_pages", "dq_duplicate_count", "word_top30",
    "bag_of_words", "tfidf", "chi2_topk", "class_report", "stratified_split_sizes",
    "bronze_job", "silver_job", "combined_job", "gold_job", "corpus_training_set",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = sys.argv[1:] or HEADLINES
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.dataFrameQueryContext.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g")).getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from newsloom import catalog

    queries, _ = catalog.load()
    seconds: dict[str, float] = {}
    for name in names:
        took = []
        for i in range(runs + 1):
            started = time.perf_counter()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            if i:
                took.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(took), 3)
    scale = re.search(r"sf([\d.]+)", folder)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": float(scale.group(1)) if scale else None, "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()

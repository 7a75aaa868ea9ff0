"""The jobs from landed payload to stored table: make, check, stop on failed rules, load, log.

Every job skips an input that has nothing to load and writes what it made once.
Its suite's row-level rules, the row count and the run log's first and last ids
are counted while that is written. A failed rule stops the job before anything is
stored; with ``rejects``, the rows that break a rule go to a table there, with
the rules they break, and the suite has to hold for the others. Then the job
loads by key and returns the load report with the rows of the run log.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.functions.ids import IdLayout
from newsloom.operators.dedup import assert_unique
from newsloom.operators.frames import is_loadable
from newsloom.operators.ids import run_summary
from newsloom.operators.quality import (
    MODEL_TESTS, Rule, bronze_suite, combined_suite, enforce, failed_rules, run_suite, silver_suite, stage_checked,
)
from newsloom.plans import bronze, gold, silver
from newsloom.session import stage
from newsloom.sinks.upsert import upsert_buckets

SKIPPED = {"status": "skipped"}
# fixed values: the keys by which each source's articles are stored
KEYS = {"currentsapi": ["id", "url"], "mediastack": ["url"], "newsapi": ["url"]}
_BRONZE = {"currentsapi": bronze.currentsapi, "mediastack": bronze.mediastack, "newsapi": bronze.newsapi}


def _split(made: DataFrame, rules: Sequence[Rule], rejects: str | None, label: str) -> DataFrame:
    """Rows that break no rule; the others are stored at ``rejects``. Without that path all rows."""
    if rejects is None:
        return made
    marked = stage(made.withColumn("failed_rules", failed_rules(made.columns, rules)), f"{label}-marked")
    marked.filter(F.size("failed_rules") > 0).write.mode("overwrite").parquet(rejects)
    return marked.filter(F.size("failed_rules") == 0).drop("failed_rules")


def _load(made: DataFrame, path: str, keys: Sequence[str], suites: Sequence[Sequence[Rule]], now_ms: int, job: str, sources: Sequence[str],
          rejects: str | None = None, unique_id: bool = False, written: bool = False) -> dict:
    """Write, check and store. The suites are enforced in turn; the sources are those the run log expects.

    Rows that come straight from a ``written`` table, as those left by the split
    do, are counted there and not written again.
    """
    rules = [r for suite in suites for r in suite]
    made = _split(made, rules, rejects, job)
    of = lambda s: F.when(F.col("source_system") == s, F.col("sf_id"))
    ends = {f"{end}_{i}": how(of(s)) for i, s in enumerate(sources) for end, how in (("first", F.min), ("last", F.max))}
    other = F.count_if(~F.coalesce(F.col("source_system").isin(*sources), F.lit(False)))
    if written or rejects is not None:
        results, seen = run_suite(made, rules), made.agg(other.alias("other"), *[c.alias(k) for k, c in ends.items()]).first().asDict()
    else:
        made, results, seen = stage_checked(made, job, rules, other=other, **ends)
    if unique_id:
        assert_unique(made, "sf_id")
    at = 0
    for suite in suites:
        enforce(results.filter(F.col("index").between(at + 1, at + len(suite))))
        at += len(suite)
    report = upsert_buckets(path, made, keys, now=F.timestamp_millis(F.lit(now_ms)), target_schema=made.schema, written=True)
    if seen["other"]:  # a source that nobody named
        log = run_summary(made, source_col="source_system", job_name=job)
    else:
        met = [(s, job, str(seen[f"first_{i}"]), str(seen[f"last_{i}"])) for i, s in enumerate(sources) if seen[f"first_{i}"] is not None]
        log = made.sparkSession.createDataFrame(met, "source_name string, job_name string, id_start string, id_end string")
    return {**report, "log": log}


def bronze_job(articles: DataFrame, source: str, path: str, *, batch_id: str, now_ms: int, layout: IdLayout,
               order_by: Sequence[str], rules: Sequence[Rule] | None = None, rejects: str | None = None) -> dict:
    """Payload rows of one source, stamped, numbered and stored."""
    if not is_loadable(articles):
        return SKIPPED
    made = _BRONZE[source](articles, batch_id=batch_id, now_ms=now_ms, layout=layout, order_by=order_by)
    suite = rules if rules is not None else bronze_suite() if source == "currentsapi" else [r for r in MODEL_TESTS[source] if r.name == "NotNull"]
    return _load(made, path, KEYS[source], [suite], now_ms, f"bronze_{source}", [source], rejects, unique_id=True, written=True)


def silver_job(stored: DataFrame, source: str, path: str, *, now_ms: int, order_by: Sequence[str] | str,
               rules: Sequence[Rule] | None = None, rejects: str | None = None) -> dict:
    """Stored bronze rows cleaned, first per URL, and stored."""
    if not is_loadable(stored):
        return SKIPPED
    made = silver.clean(stored, source, order_by)
    return _load(made, path, KEYS[source], [silver_suite(source) if rules is None else rules], now_ms, f"silver_{source}", [source], rejects)


def combined_job(sources: Mapping[str, DataFrame], path: str, *, now_ms: int, layout: IdLayout,
                 target: DataFrame | None = None, rules: Sequence[Rule] | None = None, rejects: str | None = None) -> dict:
    """New rows of all sources with ids, checked and stored by URL."""
    rows = silver.combine(sources, target)
    if not is_loadable(rows):
        return SKIPPED
    made = silver.finish_combined(rows, layout, ["url"])
    suites = [MODEL_TESTS["combined"], combined_suite()] if rules is None else [rules]
    return _load(made, path, ["url"], suites, now_ms, "silver_combined", list(sources), rejects, unique_id=True)


def gold_job(combined: DataFrame, path: str, *, now_ms: int, **options) -> dict:
    """Features of the combined table, with their embedding, stored by id."""
    if not is_loadable(combined):
        return SKIPPED
    return _load(gold.build(combined, **options), path, ["sf_id"], [], now_ms, "gold_features", [])

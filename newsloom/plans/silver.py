"""Cleaning of each source and their union into one layer."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.functions import text as X
from newsloom.functions.ids import IdLayout
from newsloom.functions.times import normalize_timestamp
from newsloom.operators.dedup import keep_first
from newsloom.operators.frames import (
    ensure_column, newer_than, rename_columns, require, sentinels_to_null, stamp, union_sources,
)
from newsloom.operators.ids import assign_ids
from newsloom.operators.quality import MODEL_TESTS, combined_suite, enforce, run_suite
from newsloom.sinks.upsert import delete_insert

DEFAULT_ZONE = "+0700"

# Per source: renames, columns to clean as text, URL columns, and whether the
# source's name is taken from the article's URL.
RULES: dict[str, dict] = {
    "currentsapi": {
        "names": {"image": "image_url", "source": "source_news", "published": "published_at"},
        "text": ["author", "title", "description", "category", "language", "source_news"],
        "urls": ["url"],
        "name_from_url": True,
    },
    "mediastack": {
        "names": {"image": "image_url", "country": "region", "source": "source_news"},
        "text": ["author", "title", "description", "category", "language", "source_news"],
        "urls": ["url", "image_url"],
        "name_from_url": False,
    },
    "newsapi": {
        "names": {"url_to_image": "image_url", "source": "source_news", "publishedAt": "published_at"},
        "text": ["author", "title", "description", "source_news", "content"],
        "urls": ["url", "image_url"],
        "name_from_url": True,
    },
}


def usable_rows(bronze: DataFrame, source: str) -> DataFrame:
    """Uniform names, sentinels as null, the URL cleaned and required: all that
    deduplication needs. One projection and one filter."""
    rules = RULES[source]
    df = rename_columns(sentinels_to_null(bronze), rules["names"])
    if rules["name_from_url"]:
        df = df.withColumn("source_news", X.root_domain(F.col("url")))  # from the raw URL
    return require(df.withColumn("url", X.normalize_url(F.col("url"))), "url")


def clean_values(usable: DataFrame, source: str, *, entities: bool = True) -> DataFrame:
    """Texts, other URLs, language and timestamp cleaned: one projection, no shuffle."""
    rules = RULES[source]
    df = ensure_column(usable, "region")
    kinds = dict(df.dtypes)
    changes = {}
    for c in rules["text"]:
        if kinds.get(c) == "string":
            changes[c] = X.normalize_text(F.col(c), entities=entities)
        elif c in kinds and kinds[c].startswith("array"):
            changes[c] = F.array_join(c, ",")
    for c in rules["urls"]:
        if c in kinds and c != "url":
            changes[c] = X.normalize_url(F.col(c))
    if "language" in kinds:
        changes["language"] = F.lower(changes.get("language", F.col("language")))
    if kinds.get("published_at") == "string":
        changes["published_at"] = normalize_timestamp(F.col("published_at"), DEFAULT_ZONE)
    return df.withColumns(changes)


def clean(bronze: DataFrame, source: str, order_by: Sequence[str] | str, *, entities: bool = True) -> DataFrame:
    """Cleaned rows, the first per URL by ``order_by``, stamped as silver.

    Repeated URLs go before the costly text cleaning, so a text is cleaned once
    however many copies of its article there are.
    """
    first = keep_first(usable_rows(bronze, source), "url", order_by)
    return stamp(clean_values(first, source, entities=entities), layer="silver")


def combine(sources: Mapping[str, DataFrame], target: DataFrame | None = None) -> DataFrame:
    """The new rows of all sources in the combined layout.

    With a target only rows after its latest publication time are taken; the
    filter is written once, above the union, and the optimizer moves it down
    into the sources.
    """
    rows = union_sources(sources)
    return rows if target is None else newer_than(rows, target, "published_at")


def refresh_combined(sources: Mapping[str, DataFrame], target: DataFrame | None) -> DataFrame:
    """The combined table after an incremental run: new rows replace rows of the same URL."""
    batch = combine(sources, target)
    return batch if target is None else delete_insert(target, batch, ["url"])


def finish_combined(rows: DataFrame, layout: IdLayout, order_by: Sequence[str], *, on_overflow: str = "carry",
                    **index_options) -> DataFrame:
    """Missing ids filled from the creation time, category lists made uniform.

    The rows are written once before they are numbered, so no pass repeats the
    cleaning. Rows beyond a millisecond's ids move
    on to the next free ones, as a batch shares its creation time.
    """
    filled = assign_ids(rows, layout, order_by, on_overflow=on_overflow, **index_options)
    return filled.withColumns({
        "sf_id": F.col("sf_id").cast("string"), "category": X.canonical_category_list(F.col("category"))})


def check_combined(rows: DataFrame) -> None:
    """Model tests and the suite of the combined layer; raises on the first set that fails."""
    known = len(MODEL_TESTS["combined"])
    results = run_suite(rows, [*MODEL_TESTS["combined"], *combined_suite()])
    enforce(results.filter(F.col("index") <= known))
    enforce(results.filter(F.col("index") > known))


def empty_combined(spark) -> DataFrame:
    from newsloom.constants import COMBINED_COLUMNS

    return spark.createDataFrame([], T.StructType.fromDDL(", ".join(f"{c} {t}" for c, t in COMBINED_COLUMNS)))

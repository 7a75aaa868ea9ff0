"""Training corpora: cleaning, merging, profiling and word statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from time import perf_counter

from pyspark.sql import DataFrame, SparkSession

from newsloom.constants import CORPUS_LABELS
from newsloom.ml.features import tfidf
from newsloom.operators.dedup import keep_first_successive
from newsloom.operators.frames import (
    cast_columns, concat_frames, drop_columns, drop_nulls, lower_columns, rename_columns, replace_in_columns,
    replace_values, strip_columns,
)
from newsloom.operators.profile import bar_counts, encode_labels, head, shape, top_words, value_counts
from newsloom.sources.readers import read_source
from newsloom.sources.snapshots import read_snapshot, write_snapshot

# Per corpus: columns to drop, the two text columns, columns to lower, renames.
CORPORA: dict[str, dict] = {
    "warehouse": {
        "drop": ["id", "source", "author", "imageurl", "publishedtime", "url", "language", "createdate",
                 "usercreate", "updatedate", "userupdate", "activedata"],
        "texts": ["titlenews", "description"],
        "lower": ["titlenews", "description", "category", "source", "author"],
        "names": {"titlenews": "title", "category": "categories"},
    },
    "sentiment": {
        "drop": ["Source", "Author", "Sentiment", "URL", "Published At"],
        "texts": ["Title", "Description"],
        "lower": ["Title", "Description", "Type", "Source", "Author"],
        "names": {"Title": "title", "Description": "description", "Type": "categories"},
    },
    "labelled_tree": {
        "drop": ["filename"],
        "texts": ["News Articles", "Summaries"],
        "lower": ["News Articles", "Summaries"],
        "names": {"News Articles": "title", "Summaries": "description", "category": "categories"},
    },
}


def clean_corpus(df: DataFrame, corpus: str, order_by: str, *, need_both: bool = True) -> DataFrame:
    """Drop, deduplicate, trim, blank to null, drop nulls, lower, rename.

    ``need_both=False`` only asks for the first text column.
    """
    rules = CORPORA[corpus]
    df = drop_columns(df, [c for c in rules["drop"] if c != order_by])
    df = keep_first_successive(df, None, order_by)
    df = replace_in_columns(strip_columns(df, rules["texts"]), rules["texts"], ["", " "], None)
    df = drop_nulls(df, rules["texts"] if need_both else rules["texts"][:1])
    return rename_columns(lower_columns(df, rules["lower"]), rules["names"])


def training_set(corpora: Mapping[str, DataFrame], order_by: str, *, need_both: bool = True) -> DataFrame:
    """All corpora as distinct (title, description, categories) rows with uniform labels."""
    cleaned = [
        clean_corpus(df, name, order_by, need_both=need_both).select(order_by, "title", "description", "categories")
        for name, df in corpora.items()
    ]
    stacked = concat_frames(cleaned, ordinal="__corpus")
    merged = keep_first_successive(stacked, None, ["__corpus", order_by])
    return replace_values(merged, "categories", CORPUS_LABELS).select("title", "description", "categories")


def write_training_set(corpora: Mapping[str, DataFrame], order_by: str, path: str, version: str, **options) -> str:
    return write_snapshot(training_set(corpora, order_by, **options), path, version)


def profile(df: DataFrame, *, counts_of: Sequence[str], casts: Mapping[str, str], names: Mapping[str, str],
            label: str) -> dict[str, DataFrame]:
    """Value counts, the cast and renamed frame with an encoded label, and its bar counts."""
    shaped = rename_columns(cast_columns(df, casts), names)
    coded = encode_labels(shaped, label)
    return {"value_counts": value_counts(df, counts_of), "encoded": coded, "bars": bar_counts(coded, label)}


def title_statistics(df: DataFrame, key: str, *, text: str = "title", label: str = "categories", top: int = 30,
                     max_features: int | None = None) -> dict[str, DataFrame]:
    """Encoded labels, most frequent words and word weights of the titles."""
    titles = cast_columns(df, {text: "string"})
    return {
        "encoded": encode_labels(titles, label),
        "top_words": top_words(titles, text, top),
        "weights": tfidf(titles, key, text, max_features=max_features),
    }


def title_statistics_of(spark: SparkSession, path: str, key: str, version: str | None = None, **options):
    return title_statistics(read_snapshot(spark, path, version), key, **options)


def extract_report(spark: SparkSession, source: Mapping, order_by: str, n: int = 5) -> dict:
    """Read a configured source, with its row count, first rows and seconds."""
    started = perf_counter()
    df = read_source(spark, source)
    rows = shape(df).first()["rows"]
    return {"rows": rows, "head": head(df, order_by, n).collect(), "seconds": round(perf_counter() - started, 3)}

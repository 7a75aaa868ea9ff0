"""Raw payload rows with housekeeping columns and ids."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.constants import SYSTEM_USER
from newsloom.functions.ids import IdLayout
from newsloom.operators.frames import append_metadata, rename_columns, require
from newsloom.operators.ids import bulk_ids

# fixed values: names that the flattened payload gives and the layer uses
NEWSAPI_NAMES = {
    "source.id": "source_id",
    "source.name": "source_name",
    "urlToImage": "url_to_image",
    "publishedAt": "published_at",
}


def housekeeping(df: DataFrame, source_system: str, batch_id: str, now_ms: int, **constants: str) -> DataFrame:
    """Creation, update, batch and layer columns; constants fill nulls of present columns."""
    now = datetime.fromtimestamp(now_ms / 1000, timezone.utc)
    values = {
        "createdate": now, "usercreate": SYSTEM_USER, "updatedate": None, "userupdate": None, "activedata": True,
        "batch_id": batch_id, "source_system": source_system, "layer": "bronze", **constants,
    }
    return append_metadata(df, values, {"createdate": "timestamp", "updatedate": "timestamp"})


def currentsapi(articles: DataFrame, *, batch_id: str, now_ms: int, layout: IdLayout, order_by: Sequence[str],
                language: str = "en") -> DataFrame:
    """Rows with a category, stamped and numbered."""
    kept = require(articles, "category")
    stamped = housekeeping(kept, "currentsapi", batch_id, now_ms, language=language)
    return bulk_ids(stamped, now_ms, layout, order_by)


def mediastack(articles: DataFrame, *, batch_id: str, now_ms: int, layout: IdLayout,
               order_by: Sequence[str]) -> DataFrame:
    return bulk_ids(housekeeping(articles, "mediastack", batch_id, now_ms), now_ms, layout, order_by)


def newsapi(articles: DataFrame, *, batch_id: str, now_ms: int, layout: IdLayout, order_by: Sequence[str],
            region: str = "us", language: str = "en") -> DataFrame:
    """Flattened payload rows; the category is a column of the landing folders."""
    stamped = housekeeping(articles, "newsapi", batch_id, now_ms, region=region, language=language)
    return bulk_ids(rename_columns(stamped, NEWSAPI_NAMES), now_ms, layout, order_by)


def flat_newsapi(payload_rows: DataFrame) -> DataFrame:
    """Payload rows with a nested ``source`` as flat, renamed columns."""
    from newsloom.operators.frames import flatten_structs

    return rename_columns(flatten_structs(payload_rows), NEWSAPI_NAMES)


def now_column(now_ms: int):
    return F.timestamp_millis(F.lit(now_ms))

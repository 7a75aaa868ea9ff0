"""Feature table for the classifiers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.constants import DEFAULT_CATEGORY, GOLD_COLUMNS
from newsloom.functions import text as X
from newsloom.ml.features import embed
from newsloom.operators.frames import rare_to_default


def gold_category(df: DataFrame, column: str = "category", **lookup_options) -> DataFrame:
    """Rare raw values to the default, then lower-case, typo fix, first of list, allow-list.

    Only values that end up in the allow-list as something else than the default
    can be changed by the rarity rule, so only those are looked up.
    """
    outcome = X.allowed_or_default(X.first_category(F.col(column)))
    common = rare_to_default(df, column, relevant=outcome != DEFAULT_CATEGORY, **lookup_options)
    return common.withColumn(column, outcome)


def features(df: DataFrame, **lookup_options) -> DataFrame:
    """Clean texts, the text to embed, the category and its code."""
    texts = df.withColumns({
        "title_clean": X.feature_text(F.col("title")), "description_clean": X.feature_text(F.col("description"))})
    coded = gold_category(texts, **lookup_options)
    return coded.withColumns({
        "text_for_embed": F.concat_ws(" ", "title_clean", "description_clean"),
        "category_encode": X.category_code(F.col("category"))})


def build(combined: DataFrame, *, make_encoder: Callable | None = None, **lookup_options) -> DataFrame:
    """The gold table: nine columns, one row per combined row."""
    made = embed(features(combined, **lookup_options), "text_for_embed", make_encoder=make_encoder)
    return made.select(*GOLD_COLUMNS)

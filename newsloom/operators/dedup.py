"""Keep-first deduplication as a narrow aggregation and a join back.

A window would bring every copy of a key into one task. The aggregation keeps
one order value per key already before the shuffle, and adaptive execution
splits a key with very many copies in the join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.session import stage


def _identity(columns: Sequence[str]) -> list[Column]:
    """128 bits that tell the values of some columns, nulls included, as two numbers."""
    flags = [F.col(c).isNull() for c in columns]
    values = [F.col(c) for c in columns]
    return [F.xxhash64(*values, *flags), F.xxhash64(*flags, F.lit(1), *reversed(values))]


def keep_first(df: DataFrame, keys: Sequence[str] | str, order_by: Sequence[str] | str) -> DataFrame:
    """First row per key by ``order_by``; null keys count as equal.

    ``order_by`` identifies a row among those of its key. Only a hash of the key
    and the order go through the aggregation; the rows themselves are shuffled
    once at most, in the join that picks the winners, and never sorted by text.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    if len(keys) == len(df.columns):
        return df.dropDuplicates(keys)
    a, b = _identity(keys)
    named = df.withColumns({"__a": a, "__b": b})
    place = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    first = named.select("__a", "__b", place.alias("__place")).groupBy("__a", "__b").agg(F.min("__place").alias("__first"))
    # the least order may be null, where all of a key's rows have none
    won = (F.col("__first") == place) | (F.col("__first").isNull() & place.isNull())
    return named.join(first, ["__a", "__b"]).filter(won).select(*df.columns)


def keep_first_successive(df: DataFrame, columns: Sequence[str] | None, order_by: Sequence[str] | str) -> DataFrame:
    """Keep-first on each column in turn. Without columns, whole rows.

    Columns the frame lacks are skipped. ``order_by`` columns are positions,
    not data, and do not take part in the whole-row comparison.
    """
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    if not columns:
        return keep_first(df, [c for c in df.columns if c not in order], order)
    present = [c for c in columns if c in df.columns]
    for i, c in enumerate(present):
        df = keep_first(df, c, order)
        if i < len(present) - 1:
            df = stage(df, "dedup")  # the next step reads it twice
    return df


def duplicate_keys(df: DataFrame, key: str, kind: str = "string") -> DataFrame:
    """Values that occur more than once, compared as one type."""
    return (
        df.select(F.col(key).cast(kind).alias(key))
        .filter(F.col(key).isNotNull())
        .groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
    )


def assert_unique(df: DataFrame, key: str) -> DataFrame:
    """The same frame, or an error that names one repeated value."""
    found = duplicate_keys(df, key).limit(1).collect()
    if found:
        raise ValueError(f"duplicate {key}: {found[0][key]}")
    return df

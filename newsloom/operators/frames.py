"""Column layout, filters, unions and joins over whole frames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.constants import (
    COMBINED_COLUMNS,
    COMBINED_MAPPING,
    DEFAULT_CATEGORY,
    RARE_BELOW,
    SENTINELS,
)
from newsloom.functions import text as X
from newsloom.operators.ordering import LOOKUP_BYTES, lookup_join

BOM = "﻿"


def apply_steps(df: DataFrame, steps: Sequence) -> DataFrame:
    """Apply frame operators from left to right."""
    return reduce(DataFrame.transform, steps, df)


# --- layout -------------------------------------------------------------------

def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop columns; names the frame does not have are ignored."""
    return df.drop(*columns)


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename by map; names the frame does not have are ignored."""
    return df.withColumnsRenamed(dict(names))


def cast_columns(df: DataFrame, types: Mapping[str, str], *, lenient: bool = False) -> DataFrame:
    """Cast by map; missing names are skipped. Lenient casts give null."""
    present = {c: t for c, t in types.items() if c in df.columns}
    if not present:
        return df
    return df.withColumns(
        {c: F.col(c).try_cast(t) if lenient else F.col(c).cast(t) for c, t in present.items()}
    )


def _literal(value: Any, kind: str | None) -> Column:
    made = value if isinstance(value, Column) else F.lit(value)
    if kind:
        return made.cast(kind)
    return made.cast("string") if value is None else made


def append_metadata(df: DataFrame, metadata: Mapping[str, Any], types: Mapping[str, str] | None = None) -> DataFrame:
    """Add constants for absent columns and fill the nulls of present ones."""
    types = types or {}
    added = {}
    for name, value in metadata.items():
        const = _literal(value, types.get(name))
        if name not in df.columns:
            added[name] = const
        elif value is not None:
            added[name] = F.coalesce(F.col(name), const.cast(df.schema[name].dataType))
    return df.withColumns(added) if added else df


def ensure_column(df: DataFrame, name: str, kind: str = "string") -> DataFrame:
    """Add a typed null column if the frame lacks it."""
    return df if name in df.columns else df.withColumn(name, F.lit(None).cast(kind))


def stamp(df: DataFrame, **constants: Any) -> DataFrame:
    """Set constant columns, replacing what is there."""
    return df.withColumns({k: F.lit(v) for k, v in constants.items()})


def flatten_structs(df: DataFrame) -> DataFrame:
    """Nested objects become columns named by their dotted path; arrays stay."""

    def walk(schema: T.StructType, path: tuple[str, ...]):
        for field in schema.fields:
            here = (*path, field.name)
            if isinstance(field.dataType, T.StructType):
                yield from walk(field.dataType, here)
            else:
                quoted = ".".join(f"`{p}`" for p in here)
                yield F.col(quoted).alias(".".join(here))

    return df.select(*walk(df.schema, ()))


def check_header(names: Sequence[str]) -> list[str]:
    """Trimmed header without byte-order mark; empty or repeated names are an error."""
    cleaned = [n.strip() for n in names]
    if cleaned:
        cleaned[0] = cleaned[0].lstrip(BOM).strip()
    lowered = [n.lower() for n in cleaned]
    if not cleaned or "" in lowered or len(set(lowered)) != len(lowered):
        raise ValueError(f"invalid header: {list(names)}")
    return cleaned


def align_to_schema(df: DataFrame, target: T.StructType, keys: Sequence[str] = ()) -> DataFrame:
    """Keep the columns the target knows, under the target's spelling and type.

    Names match in any case and the first match wins. No match at all, or a
    key column that is missing on either side, is an error.
    """
    known = {f.name.lower(): f for f in target.fields}
    picked: dict[str, Column] = {}
    for i, name in enumerate(df.columns):
        field = known.get(name.lower())
        if field is not None and field.name not in picked:
            column = df[name] if df.columns.count(name) == 1 else F.col(df.columns[i])
            picked[field.name] = column.cast(field.dataType).alias(field.name)
    if not picked:
        raise ValueError("no column matches the target")
    for k in keys:
        if k not in target.names:
            raise ValueError(f"key column '{k}' is not in the target")
        if k not in picked:
            raise ValueError(f"key column '{k}' is missing in the input")
    return df.select(*picked.values())


def to_combined(df: DataFrame, source: str) -> DataFrame:
    """Project one source onto the combined layout."""
    mapping = COMBINED_MAPPING[source]
    out = []
    for name, kind in COMBINED_COLUMNS:
        origin = mapping.get(name, name)
        if origin is None:
            column = F.lit(None)
        elif origin.startswith("='"):
            column = F.lit(origin[2:-1])
        else:
            column = F.col(origin)
        out.append(column.cast(kind).alias(name))
    return df.select(*out)


# --- filters and value rules ---------------------------------------------------

def drop_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows with a null in any of the columns; no columns, no change."""
    return df.dropna(how="any", subset=list(columns)) if columns else df


def require(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull())


def is_missing_id(c: Column) -> Column:
    """Null or empty text."""
    return c.isNull() | (c.cast("string") == "")


def is_loadable(df: DataFrame, column: str = "url") -> bool:
    """Whether a job has something to do: the needed column is there, and a row."""
    return column in df.columns and not df.isEmpty()


def _text_columns(df: DataFrame, columns: Sequence[str] | None) -> list[str]:
    names = df.columns if columns is None else columns
    return [c for c in names if c in df.columns and isinstance(df.schema[c].dataType, T.StringType)]


def _each(df: DataFrame, columns: Sequence[str] | None, fn) -> DataFrame:
    names = _text_columns(df, columns)
    return df.withColumns({c: fn(F.col(c)) for c in names}) if names else df


def sentinels_to_null(df: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Texts that mean "no value" become null in every text column."""
    names = _text_columns(df, None)
    return df.replace([*SENTINELS, *extra], None, names) if names else df


def strip_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _each(df, columns, X.strip)


def lower_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _each(df, columns, F.lower)


def replace_in_columns(df: DataFrame, columns: Sequence[str], targets: Sequence[str] = ("", " "),
                       value=None) -> DataFrame:
    return _each(df, columns, lambda c: X.replace_in(c, targets, value))


def replace_values(df: DataFrame, column: str, mapping: Mapping) -> DataFrame:
    return df.withColumn(column, X.replace_whole(F.col(column), mapping))


def clean_text_columns(df: DataFrame, columns: Sequence[str], cleaner=X.clean_keep_meaning) -> DataFrame:
    """Apply a text cleaner to the named columns; missing names are skipped."""
    return _each(df, columns, cleaner)


def newer_than(df: DataFrame, target: DataFrame, column: str) -> DataFrame:
    """Rows after the target's highest value; everything if the target has none.

    The highest value is one number, read first. As a constant it reaches the
    scan, where whole files and row groups are skipped.
    """
    kind = target.schema[column].dataType
    highest = F.max(column)
    if isinstance(kind, T.TimestampType):
        us = target.agg(F.unix_micros(highest)).first()[0]
        mark = None if us is None else F.timestamp_micros(F.lit(us))
    else:
        value = target.agg(highest).first()[0]
        mark = None if value is None else F.lit(value).cast(kind)
    return df if mark is None else df.filter(F.col(column) > mark)


def rare_to_default(df: DataFrame, column: str = "category", *, below: int = RARE_BELOW,
                    default: str = DEFAULT_CATEGORY, relevant: Column | None = None,
                    max_bytes: int = LOOKUP_BYTES) -> DataFrame:
    """Values seen fewer than ``below`` times become the default; null stays.

    The frequent values are looked up, not the rare ones: their number shrinks
    with ``below``. ``relevant`` limits the lookup to values whose outcome
    matters; any other value is treated as rare.
    """
    counts = df.filter(F.col(column).isNotNull())
    if relevant is not None:
        counts = counts.filter(relevant)
    frequent = (
        counts.groupBy(column).agg(F.count(F.lit(1)).alias("__n"))
        .filter(F.col("__n") >= below).select(column, F.lit(True).alias("__often"))
    )
    joined = lookup_join(df, frequent, column, max_bytes=max_bytes)
    kept = F.col("__often") | F.col(column).isNull()
    return joined.withColumn(column, F.when(kept, F.col(column)).otherwise(F.lit(default))).drop("__often")


# --- unions and joins -----------------------------------------------------------

def concat_frames(frames: Sequence[DataFrame], ordinal: str | None = None) -> DataFrame:
    """Stack frames by column name, missing columns as null.

    ``ordinal`` adds the position of the frame a row came from, so that
    keep-first operators have an order to follow.
    """
    if not frames:
        raise ValueError("nothing to concatenate")
    if ordinal:
        frames = [f.withColumn(ordinal, F.lit(i)) for i, f in enumerate(frames)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_sources(sources: Mapping[str, DataFrame]) -> DataFrame:
    """Union of sources after projecting each onto the combined layout."""
    return reduce(DataFrame.unionAll, [to_combined(df, name) for name, df in sources.items()])


def join_frames(left: DataFrame, right: DataFrame, on: Sequence[str] | str | None = None, how: str = "inner",
                lsuffix: str = "", rsuffix: str = "") -> DataFrame:
    """Equi join with suffixes for columns both sides have.

    The physical strategy is left to the planner, which knows the sizes and
    splits skewed partitions at run time.
    """
    keys = [on] if isinstance(on, str) else list(on or [])
    if how != "cross" and not keys:
        raise ValueError("join keys are required")
    shared = [c for c in left.columns if c in right.columns and c not in keys]
    if shared and not (lsuffix or rsuffix):
        raise ValueError(f"columns overlap and no suffix was given: {shared}")
    left = left.withColumnsRenamed({c: c + lsuffix for c in shared})
    right = right.withColumnsRenamed({c: c + rsuffix for c in shared})
    if how == "cross":
        return left.crossJoin(right)
    return left.join(right, keys, how)


def decode_by_table(df: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Look codes up in a table; broadcast or shuffled, as the planner's sizes say."""
    return df.join(table, key, "left")


def missing_columns(df: DataFrame, expected: Sequence[str]) -> set[str]:
    return set(expected) - set(df.columns)

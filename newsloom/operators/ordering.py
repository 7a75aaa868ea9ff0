"""Positions, running values and ranks that no single task has to compute.

A plain window puts each group into one task. Here rows are range-partitioned by
all order columns together, sorted inside their range and written once; a row's
place is its place in the written range plus the rows of the ranges before it.
Only values that are equal in every order column share a range for sure, so
neither a hot group nor a constant first column nor texts with one long head
land in one task. The places are read back and never computed again, so a lost
task cannot change them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.session import stage

LOOKUP_BYTES = 32 << 20  # measured size up to which a lookup is broadcast
_RANGE_BITS = 33  # of the row number inside a range, as Spark's increasing ids have it


def ranged_rows(df: DataFrame, order_by: Sequence[str], ranges: int | None) -> DataFrame:
    """``df`` written in order, with ``__range`` and ``__in``, the place in it."""
    spark = df.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_ = df.repartitionByRange(ranges, *order_by).sortWithinPartitions(*order_by)
    written = stage(sorted_.withColumn("__at", F.monotonically_increasing_id()), "ordered")
    at = F.col("__at")
    return written.select(
        *df.columns, F.shiftright(at, _RANGE_BITS).alias("__range"),
        at.bitwiseAND(F.lit((1 << _RANGE_BITS) - 1).cast("long")).alias("__in"))


_ranged = ranged_rows  # the name its test has


def _carry_in(ranged: DataFrame, value: Column, how) -> DataFrame:
    """Per range, the combined value of all earlier ranges; one row per range."""
    per_range = ranged.groupBy("__range").agg(how(value).alias("__total"))
    earlier = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    return per_range.select("__range", how("__total").over(earlier).alias("__carry"))


def _positioned(df: DataFrame, order_by: Sequence[str], out: str, ranges: int | None) -> DataFrame:
    ranged = ranged_rows(df, order_by, ranges)
    carry = F.broadcast(_carry_in(ranged, F.lit(1), F.sum))  # one row per range
    return ranged.join(carry, "__range", "left").withColumn(
        out, F.col("__in") + F.coalesce("__carry", F.lit(0))).drop("__range", "__in", "__carry")


def running(df: DataFrame, order_by: Sequence[str] | str, value: Column, out: str, *, how=F.sum,
            inclusive: bool = True, ranges: int | None = None) -> DataFrame:
    """Running ``how`` (sum or max) of ``value`` over the whole frame by a
    unique order; exclusive running values start as null."""
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    ranged = ranged_rows(df.withColumn("__v", value), order, ranges)
    carry = F.broadcast(_carry_in(ranged, F.col("__v"), how))
    own = Window.partitionBy("__range").orderBy("__in").rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    joined = ranged.withColumn("__own", how("__v").over(own)).join(carry, "__range", "left")
    if how is F.max:
        total = F.greatest("__own", "__carry")
    else:
        total = F.when(F.col("__own").isNull(), F.col("__carry")).otherwise(F.col("__own") + F.coalesce("__carry", F.lit(0)))
    return joined.withColumn(out, total).drop("__v", "__own", "__carry", "__range", "__in")


def running_index(df: DataFrame, order_by: Sequence[str], *, within: Sequence[str] = (), out: str = "idx",
                  ranges: int | None = None) -> DataFrame:
    """0-based position of every row by ``order_by``, inside ``within`` groups.

    ``order_by`` must identify a row inside its group. A position inside a group
    is the position in the whole, ordered by group first, less that of the
    group's first row. Null group values are equal.
    """
    order_by, keys = list(order_by), list(within)
    if not keys:
        return _positioned(df, order_by, out, ranges)
    grouped = _positioned(df.withColumn("__group", F.struct(*keys)), [*keys, *order_by], "__place", ranges)
    first = grouped.groupBy("__group").agg(F.min("__place").alias("__first"))
    placed = lookup_join(grouped, first, "__group")
    return placed.withColumn(out, F.col("__place") - F.col("__first")).select(*df.columns, out)


def lookup_bytes(staged: DataFrame) -> int:
    """Measured size of a written table: its rows, and the bytes of its texts."""
    sizes = F.lit(8 * len(staged.columns))
    for f in staged.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            sizes = sizes + F.coalesce(F.octet_length(f.name), F.lit(0))
        elif isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)):
            sizes = sizes + F.coalesce(F.octet_length(F.to_json(F.struct(f.name))), F.lit(0))
    return staged.agg(F.coalesce(F.sum(sizes.cast("long")), F.lit(0))).first()[0]


def lookup_join(df: DataFrame, lookup: DataFrame, on: str, *, how: str = "left",
                max_bytes: int = LOOKUP_BYTES) -> DataFrame:
    """Join a one-row-per-key lookup that was derived from ``df`` itself.

    The lookup is written once and measured. Up to ``max_bytes`` it is broadcast.
    A larger one meets ``df`` in a sort-merge join, whose hot keys (and rows
    without a key) adaptive execution splits over several tasks.
    """
    staged = stage(lookup, "lookup")
    if lookup_bytes(staged) <= max_bytes:
        return df.join(F.broadcast(staged), on, how)
    return df.join(staged.hint("merge"), on, how)


def dense_index(df: DataFrame, key: str, *, out: str = "rank", max_bytes: int = LOOKUP_BYTES,
                ranges: int | None = None) -> DataFrame:
    """0-based dense rank of ``key`` over the whole frame; null keys get null."""
    distinct = df.filter(F.col(key).isNotNull()).select(key).distinct()
    ranked = _positioned(distinct, [key], out, ranges)
    return lookup_join(df, ranked, key, max_bytes=max_bytes).select(*df.columns, out)

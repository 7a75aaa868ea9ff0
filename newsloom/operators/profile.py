"""Profiling: counts, statistics, histograms, pivots and word frequencies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.functions import text as X
from newsloom.operators.ordering import LOOKUP_BYTES, dense_index, running
from newsloom.session import stage

QUARTILES = (0.25, 0.5, 0.75)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def _one_row_per_column(row: DataFrame, columns: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Turn columns ``<field>__<column>`` of a one-row frame into one row per column."""
    lines = [
        F.struct(F.lit(c).alias("column"), *[F.col(f"`{f}__{c}`").alias(f) for f in fields]) for c in columns
    ]
    return row.select(F.inline(F.array(*lines)))


def value_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows (column, value, count) with nulls counted, rarest first; one job for all columns."""
    columns = list(columns or df.columns)
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    return (
        df.select(F.explode(pairs).alias("p")).groupBy("p.column", "p.value")
        .agg(F.count(F.lit(1)).alias("count")).orderBy("column", "count", "value")
    )


def null_counts(df: DataFrame) -> DataFrame:
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"nulls__{c}") for c in df.columns])
    return _one_row_per_column(row, df.columns, ["nulls"])


def info(df: DataFrame) -> DataFrame:
    """Non-null count and type per column."""
    row = df.agg(*[F.count(c).alias(f"non_null__{c}") for c in df.columns])
    kinds = F.create_map(*[F.lit(x) for pair in df.dtypes for x in pair])
    return _one_row_per_column(row, df.columns, ["non_null"]).withColumn("dtype", kinds[F.col("column")])


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def column_bytes(df: DataFrame) -> DataFrame:
    """Bytes of each column's values written as text."""
    row = df.agg(*[
        F.coalesce(F.sum(F.octet_length(F.col(c).cast("string"))), F.lit(0)).cast("long").alias(f"bytes__{c}")
        for c in df.columns])
    return _one_row_per_column(row, df.columns, ["bytes"])


def column_means(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Mean per column: all numeric ones, or those named, with null for others."""
    numbers = set(numeric_columns(df))
    columns = [c for c in (columns or df.columns) if c in df.columns and (columns or c in numbers)]
    row = df.agg(*[
        (F.avg(c) if c in numbers else F.lit(None).cast("double")).alias(f"mean__{c}") for c in columns])
    return _one_row_per_column(row, columns, ["mean"])


def duplicate_rows(df: DataFrame) -> DataFrame:
    from newsloom.operators.quality import duplicate_count

    return duplicate_count(df, df.columns)


# --- exact quantiles ---------------------------------------------------------------

def _ranks(n: int, p: float) -> tuple[int, int, float]:
    """Neighbouring 0-based ranks and the weight of the upper one."""
    at = p * (n - 1)
    low = int(at)
    return low, min(low + 1, n - 1), at - low


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float] = QUARTILES, *,
                    also: dict[str, Column] | None = None, accuracy: int = 10_000) -> DataFrame:
    """Linearly interpolated quantiles as one row of numbers, ``q<i>__<column>``.

    A sketch brackets each rank in a first pass, which also takes the plain
    aggregates of ``also``. A second pass counts the values inside the brackets
    and the rows below them, so every result is checked: a rank outside its
    bracket is looked for again in a wider one, in the end in all values.
    """
    also, slack = dict(also or {}), 3.0 / accuracy
    reach = [q for p in probs for q in (max(0.0, p - slack), min(1.0, p + slack))]
    summary = df.agg(
        *[v.alias(k) for k, v in also.items()], *[F.count(c).alias(f"n__{c}") for c in columns],
        *[F.min(F.col(c).cast("double")).alias(f"lo__{c}") for c in columns],
        *[F.max(F.col(c).cast("double")).alias(f"hi__{c}") for c in columns],
        *[F.percentile_approx(F.col(c).cast("double"), reach, accuracy).alias(f"e__{c}") for c in columns])
    kinds = {f.name: f.dataType for f in summary.schema.fields}
    first = summary.first()  # one row
    row = {k: first[k] for k in also}
    row.update({f"q{i}__{c}": None for c in columns for i in range(len(probs))})
    brackets = {(c, i): (first[f"e__{c}"][2 * i], first[f"e__{c}"][2 * i + 1])
                for c in columns if first[f"n__{c}"] for i in range(len(probs))}
    while brackets:
        upto = _ranked_inside(df, brackets)
        picks = []
        for (c, i), _ in brackets.items():
            own = (F.col("c") == c) & (F.col("i") == i)
            for rank in _ranks(first[f"n__{c}"], probs[i])[:2]:
                picks += [F.min(F.when(own & (F.col("upto") > rank), F.col("v"))),
                          F.max(F.when(own & F.col("v").isNull(), F.col("upto")))]
        ends = upto.agg(*picks).first()
        missed = {}
        for at, (c, i) in enumerate(brackets):
            low, below, high, _ = ends[4 * at:4 * at + 4]
            rank, _, weight = _ranks(first[f"n__{c}"], probs[i])
            if low is None or high is None or (below or 0) > rank:
                missed[(c, i)] = (first[f"lo__{c}"], first[f"hi__{c}"])
            else:
                row[f"q{i}__{c}"] = low + (high - low) * weight
        brackets = missed
    schema = T.StructType([T.StructField(k, kinds.get(k, T.DoubleType())) for k in row])
    return df.sparkSession.createDataFrame([tuple(row.values())], schema)


def _ranked_inside(df: DataFrame, brackets: dict[tuple[str, int], tuple[float, float]]) -> DataFrame:
    """Rows (c, i, v, upto): every distinct value inside bracket ``i`` of column ``c``, and null for all
    below it, with the number of rows up to it."""
    hits = []
    for (c, i), (low, high) in brackets.items():
        v = F.col(c).cast("double")
        here = F.struct(F.lit(c).alias("c"), F.lit(i).alias("i"), F.when(v >= low, v).alias("v"))
        hits.append(F.when(v <= high, here))
    counted = df.select(F.explode(F.array_compact(F.array(*hits))).alias("h")).groupBy("h.c", "h.i", "h.v").agg(
        F.count(F.lit(1)).alias("n"))
    summed = running(counted, ["c", "i", "v"], F.col("n"), "sum")
    starts = summed.groupBy("c", "i").agg(F.min(F.col("sum") - F.col("n")).alias("start"))  # one row per bracket
    return summed.join(F.broadcast(starts), ["c", "i"]).withColumn("upto", F.col("sum") - F.col("start"))


def describe(df: DataFrame, columns: Sequence[str] | None = None, **quantile_options) -> DataFrame:
    """count, mean, std, min, quartiles and max per numeric column."""
    columns = list(columns or numeric_columns(df))
    fields = ["count", "mean", "std", "min", "q25", "q50", "q75", "max"]
    others = {}
    for c in columns:
        others.update({
            f"count__{c}": F.count(c), f"mean__{c}": F.avg(c), f"std__{c}": F.stddev_samp(c),
            f"min__{c}": F.min(F.col(c).cast("double")), f"max__{c}": F.max(F.col(c).cast("double"))})
    row = exact_quantiles(df, columns, QUARTILES, also=others, **quantile_options).withColumnsRenamed(
        {f"q{i}__{c}": f"{name}__{c}" for c in columns for i, name in enumerate(["q25", "q50", "q75"])})
    return _one_row_per_column(row, columns, fields)


# --- distributions ------------------------------------------------------------------

def bar_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("count")).orderBy(column)


def histogram(df: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """Rows (bin, low, high, count) of equal-width bins; the last bin is closed.

    Bins without values are listed too.
    """
    v = df.select(F.col(column).cast("double").alias("v")).filter("v is not null")
    low, high = v.agg(F.min("v"), F.max("v")).first()
    if low is None:
        return df.sparkSession.createDataFrame([], "bin int, low double, high double, count bigint")
    width = (high - low) / bins
    at = F.least(F.floor((F.col("v") - F.lit(low)) / F.lit(width)), F.lit(bins - 1)) if width > 0 else F.lit(0)
    counts = v.groupBy(at.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    edges = df.sparkSession.createDataFrame(
        [(i, low + i * width, low + (i + 1) * width) for i in range(bins)], "bin int, low double, high double")
    return edges.join(counts, "bin", "left").withColumn(
        "count", F.coalesce("count", F.lit(0)).cast("long")).orderBy("bin")


def pivot_first(df: DataFrame, index: Sequence[str], column: str, value: str, order_by: str,
                names: Sequence[str]) -> DataFrame:
    """First non-null value by ``order_by`` per index and pivot name; names
    without rows give null columns."""
    return df.groupBy(*index).agg(*[
        F.min_by(value, F.when((F.col(column) == n) & F.col(value).isNotNull(), F.col(order_by))).alias(n)
        for n in names])


def word_counts(df: DataFrame, column: str) -> DataFrame:
    """Corpus-wide count of every word."""
    return df.select(F.explode(X.words(F.col(column))).alias("word")).groupBy("word").agg(
        F.count(F.lit(1)).alias("n"))


def top_words(df: DataFrame, column: str, n: int = 30) -> DataFrame:
    """The ``n`` most frequent words; ties in word order."""
    return word_counts(df, column).orderBy(F.desc("n"), "word").limit(n)


# --- first and last rows, codes ---------------------------------------------------------

def head(df: DataFrame, order_by: str, n: int = 5) -> DataFrame:
    return df.orderBy(order_by).limit(n)


def tail(df: DataFrame, order_by: str, n: int = 5) -> DataFrame:
    """Last rows, in their order."""
    return df.orderBy(F.desc(order_by)).limit(n).orderBy(order_by)


def encode_labels(df: DataFrame, column: str, *, out: str | None = None, max_bytes: int = LOOKUP_BYTES) -> DataFrame:
    """Code of each value in sorted order, 0 for the smallest; null stays null."""
    return dense_index(df, column, out=out or f"encoded_{column}", max_bytes=max_bytes)


def map_column(df: DataFrame, column: str, mapping: dict, out_type: str = "string") -> DataFrame:
    return df.withColumn(f"mapped_{column}", X.map_values(F.col(column), mapping, out_type))

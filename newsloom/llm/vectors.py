"""Vector tables: cleaning, numpy views of Arrow batches, and blocks of a stated query set."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.session import stage

QUERY_BLOCK = 2_048  # queries that travel to the tasks at a time
ROWS_AT_ONCE = 1_024  # rows a task multiplies with a block of queries at a time


def usable(vector: str) -> Column:
    """Vectors with at least one component, all of them finite."""
    c = F.col(vector)
    fine = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return c.isNotNull() & (F.size(c) > 0) & fine


def lengths(staged: DataFrame) -> list[int]:
    """The lengths that occur; vectors of one length are searched among themselves."""
    return sorted(r["n"] for r in staged.select(F.size("v").alias("n")).distinct().collect())


def matrix(batch: pa.RecordBatch, column: str, length: int) -> np.ndarray:
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, length)


def query_blocks(staged: DataFrame, divisor: int, length: int, block: int = QUERY_BLOCK) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ids and vectors of the rows whose id is divisible by ``divisor``, and how many such rows are equal, block by block.

    The set is written once and read one range of (id, vector) at a time, so that
    a block is all the driver ever holds.
    """
    asked = staged.filter((F.col("id") % divisor == 0) & (F.size("v") == length))
    asked = stage(asked.groupBy("id", "v").agg(F.count(F.lit(1)).alias("n")), "queries")
    kind, last = asked.schema["v"].dataType, None
    while True:
        rest = asked
        if last is not None:
            rest = asked.filter((F.col("id") > last["id"]) | ((F.col("id") == last["id"]) & (F.col("v") > F.lit(last["v"]).cast(kind))))
        rows = rest.orderBy("id", "v").limit(block).collect()
        if not rows:
            return
        yield np.array([r["id"] for r in rows], dtype=np.int64), np.array([r["v"] for r in rows]), np.array([r["n"] for r in rows], dtype=np.int64)
        last = rows[-1]
        if len(rows) < block:
            return


def best_of_each(query: np.ndarray, row: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best rows of each query: highest score first, then the smaller id."""
    order = np.lexsort((ids[row], -score, query))
    sorted_query = query[order]
    firsts = np.flatnonzero(np.r_[True, sorted_query[1:] != sorted_query[:-1]]) if len(order) else np.empty(0, np.int64)
    rank = np.arange(len(order)) - np.repeat(firsts, np.diff(np.r_[firsts, len(order)]))
    return order[rank < k]

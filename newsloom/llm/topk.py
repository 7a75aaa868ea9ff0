"""Exact top-k inner products by distributed histogram selection.

Every query of a stated set is scored against every row, block by block. No
score list is kept: a first pass counts scores in a histogram per query, whose
range holds every possible score; the bin with the k-th highest is spread over
the next histogram, until it is one value wide or few rows are above it. A last
pass keeps rows at or above each cut, the k best of a batch at most, and ranks
them: highest score, then smaller id.

Components are turned into whole numbers, floor(scale * x), so scores are exact.

Defined cases: null, empty or non-finite vectors and rows without an id take no
part; vectors meet those of their own length; of a repeated id each row is
asked for and each is a candidate, and the id's list is the best of all its rows'
scores, so a row found by two of them is there twice; a zero vector scores 0; an empty table
gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsloom.session import stage

from .vectors import QUERY_BLOCK, ROWS_AT_ONCE, best_of_each, lengths, matrix, query_blocks, usable

BINS = 512
FARTHEST = (1 << 62) - BINS  # a histogram's range, doubled, is a 64-bit number
FEW = 8  # times k: with so many rows above the cut, the last pass may begin


def _products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Whole-number inner products; floating point serves while it is exact."""
    top = float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0)) * queries.shape[1]
    if top < 2**53:
        return (queries.astype(np.float64) @ rows.astype(np.float64).T).astype(np.int64)
    return queries @ rows.T


def _scored(batches: Iterator[pa.RecordBatch], ids: np.ndarray, queries: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids of rows and scores (query x row); a query's own row scores least."""
    for batch in batches:
        all_ids = batch.column("id").to_numpy()
        all_rows = matrix(batch, "v", queries.shape[1])
        for at in range(0, len(all_ids), ROWS_AT_ONCE):
            row_ids, rows = all_ids[at:at + ROWS_AT_ONCE], all_rows[at:at + ROWS_AT_ONCE]
            yield row_ids, _products(queries, rows)


def _histogram(rows: DataFrame, ids: np.ndarray, queries: np.ndarray, low: np.ndarray, high: np.ndarray, width: np.ndarray) -> DataFrame:
    """Per query and bin, the rows whose score is in the bin and below ``high``; counted in each task first.

    Scores beyond FARTHEST count as that one.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(ids), BINS), dtype=np.int64)
        for row_ids, scores in _scored(batches, ids, queries):
            scores = np.clip(scores, -FARTHEST, FARTHEST)
            bins = (scores - low[:, None]) // width[:, None]
            inside = (bins >= 0) & (scores < high[:, None]) & (ids[:, None] != row_ids[None, :])
            flat = (np.arange(len(ids))[:, None] * BINS + bins)[inside]
            sums += np.bincount(flat, minlength=sums.size).reshape(sums.shape)
        q, b = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(b), pa.array(sums[q, b])], names=["q", "bin", "n"])

    return rows.mapInArrow(count, "q long, bin long, n long").groupBy("q", "bin").agg(F.sum("n").alias("n"))


def _cuts(rows: DataFrame, ids: np.ndarray, queries: np.ndarray, k: int, longest: float) -> np.ndarray:
    """For each query a score with at least ``k`` rows at or above it (all, if there are fewer), and few more."""
    reach = np.sqrt((queries.astype(np.float64) ** 2).sum(axis=1)) * longest * (1 + 1e-9)  # for rounding
    reach = np.where(reach < 2.0**61, np.ceil(np.minimum(reach, 2.0**61)).astype(np.int64) + 1, FARTHEST)
    low, high, width = -reach, reach + 1, -(-(2 * reach + 1) // BINS)
    above = np.zeros(len(ids), dtype=np.int64)  # rows above the range looked at
    open_ = np.ones(len(ids), dtype=bool)
    while open_.any():
        part = np.flatnonzero(open_)
        found = _histogram(rows, ids[part], queries[part], low[part], high[part], width[part])
        down = Window.partitionBy("q").orderBy(F.desc("bin"))
        need = F.get(F.lit((k - above[part]).tolist()), F.col("q").cast("int"))
        walked = found.withColumn("sum", F.sum("n").over(down)).withColumn("last", F.min("bin").over(Window.partitionBy("q")))
        hit = walked.filter(((F.col("sum") >= need) & (F.col("sum") - F.col("n") < need)) | (
            (F.col("bin") == F.col("last")) & (F.col("sum") < need)))
        seen = np.zeros(len(part), dtype=bool)
        for r in hit.select("q", "bin", "n", "sum").collect():  # one row per query of the block
            i = part[r["q"]]
            seen[r["q"]] = True
            low[i] += r["bin"] * width[i]
            total = above[i] + r["sum"]
            if width[i] == 1 or total <= FEW * k:
                open_[i] = False
            else:
                above[i] = total - r["n"]
                high[i] = min(high[i], low[i] + width[i])  # the next bins may reach over the end of this one
                width[i] = -(-width[i] // BINS)
        open_[part[~seen]] = False  # a query without candidates
    return low


def top_k(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 100, k: int = 10,
          scale: int = 1024, block: int = QUERY_BLOCK) -> DataFrame:
    """The ``k`` rows of highest score for each row whose id is divisible by ``every``: query_id, rank, vec_id, score."""
    whole = F.transform(F.col(vector_col), lambda x: F.floor(x.cast("double") * scale).cast("long"))
    rows = vectors.filter(F.col(id_col).isNotNull() & usable(vector_col)).select(F.col(id_col).cast("long").alias("id"), whole.alias("v"))
    rows = stage(rows, "topk-rows")
    result = None
    for length in lengths(rows):
        own = rows.filter(F.size("v") == length)
        square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
        longest = own.agg(F.max(F.sqrt(square)).alias("m")).first()["m"]
        for ids, queries, times in query_blocks(rows, every, length, block):
            cut = _cuts(own, ids, queries, k, longest)

            def keep(batches: Iterator[pa.RecordBatch], ids=ids, queries=queries, times=times, cut=cut) -> Iterator[pa.RecordBatch]:
                for row_ids, scores in _scored(batches, ids, queries):
                    q, r = np.nonzero((scores >= cut[:, None]) & (ids[:, None] != row_ids[None, :]))
                    best = best_of_each(q, r, scores[q, r], row_ids, k)
                    q, r = q[best], r[best]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[q]), pa.array(row_ids[r]), pa.array(scores[q, r]), pa.array(times[q])], names=["query_id", "vec_id", "score", "n"])

            found = stage(own.mapInArrow(keep, "query_id long, vec_id long, score long, n long"), "topk-found")
            result = found if result is None else result.unionByName(found)
    if result is None:
        result = vectors.sparkSession.createDataFrame([], "query_id long, vec_id long, score long, n long")
    # a query of n equal rows has every score n times
    result = result.withColumn("n", F.explode(F.sequence(F.lit(1), F.least("n", F.lit(k)).cast("int"))))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return result.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")

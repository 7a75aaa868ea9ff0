"""Approximate nearest neighbours along several shifted Hilbert curves, with an exact check of what they leave open.

Vectors are turned so that the largest inner product is the nearest point (one
more component fills every vector up to the longest), projected by seeded
random directions, shifted and put on a grid. A Hilbert curve orders the grid's
cells; Spark range-partitions the rows of all curves by (curve, key). A query's
neighbours along each curve, ``window`` rows to either side, are scored on the
original vectors, and the windows of all curves are merged.

Points without any structure have no near neighbours that a curve could keep
together. So a check follows (``complete``): rows lie in runs along the first
curve, and a run is scored again for the queries whose k-th score it can still
beat, by its centre and radius. Runs that cannot are left out unread.

Defined cases: null, empty, zero or non-finite vectors and rows without an id
take no part; vectors meet those of their own length; a repeated id is asked for
once, and its rows are one candidate with the highest score; equal scores go to
the smaller id; fewer candidates than k are all returned; an empty table gives
no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsloom.session import stage

from .vectors import QUERY_BLOCK, best_of_each, lengths, matrix, query_blocks, usable

AXES, BITS = 8, 7  # 56 bits of key
RUN = 512  # rows along the first curve that share a centre and a radius
SLACK = 1e-9


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places along the Hilbert curve of points of a grid with 2**bits cells on each axis.

    The usual transposed form: inverse undo of the excess work from the highest
    bit down, then a Gray code, then the bits of all axes interleaved.
    """
    x = cells.astype(np.int64).T.copy()
    axes = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(axes):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] ^= swap
        q >>= 1
    for i in range(1, axes):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        turn = np.where((x[axes - 1] & q) != 0, turn ^ (q - 1), turn)
        q >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(axes):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def _grid(rows: np.ndarray, longest: float, curve: int, seed: int) -> np.ndarray:
    """Cells of a curve's own grid: random directions, spread evenly by the normal law, shifted by part of a cell range."""
    spare = np.sqrt(np.maximum(longest**2 - (rows**2).sum(axis=1), 0.0))
    full = np.column_stack([rows, spare]) / longest
    rng = np.random.default_rng([seed, curve])
    turned, _ = np.linalg.qr(rng.standard_normal((full.shape[1], min(AXES, full.shape[1]))))
    projected = full @ turned * np.sqrt(full.shape[1])
    even = 0.5 * (1 + np.tanh(0.7978845608 * (projected + 0.044715 * projected**3)))
    shifted = (even + rng.random(turned.shape[1])) / 2  # a shift of up to the whole range, so curves break elsewhere
    return np.minimum((shifted * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)


def _exact(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products added up component by component, whatever else is scored with them."""
    total = np.zeros(len(queries))
    for i in range(queries.shape[1]):
        total += queries[:, i] * rows[:, i]
    return total


def _batch(query: np.ndarray, vec: np.ndarray, score: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(query), pa.array(vec), pa.array(score)], names=["query_id", "vec_id", "score"])


def _curve_rows(rows: DataFrame, length: int, longest: float, curves: int, seed: int) -> DataFrame:
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = matrix(batch, "v", length)
            for curve in range(curves):
                key = hilbert_keys(_grid(points, longest, curve, seed), BITS)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(key), curve, np.int32)), pa.array(key), batch.column("id"), batch.column("v")],
                    names=["curve", "key", "id", "v"])

    return rows.mapInArrow(keys, "curve int, key long, id long, v array<double>")


def _windows(placed: DataFrame, length: int, every: int, k: int, window: int) -> DataFrame:
    """Best rows of each query's windows. Windows end at partition borders; other curves have theirs elsewhere."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last rows, as neighbours of the next and as queries not yet answered
        done = 0  # rows of ``held`` that were asked for
        for batch in _and_end(batches):
            if batch is not None:
                new = (batch.column("curve").to_numpy(), batch.column("id").to_numpy(), matrix(batch, "v", length))
                held = new if held is None else tuple(np.concatenate([a, b]) for a, b in zip(held, new))
            if held is None:
                return
            curve, ids, points = held
            ready = len(ids) if batch is None else max(done, len(ids) - window)
            asked = np.flatnonzero(ids[done:ready] % every == 0) + done
            for at in range(0, len(asked), 128):
                mine = asked[at:at + 128]
                near = mine[:, None] + np.arange(-window, window + 1)[None, :]
                fine = (near >= 0) & (near < len(ids))
                near = np.clip(near, 0, len(ids) - 1)
                fine &= (curve[near] == curve[mine][:, None]) & (ids[near] != ids[mine][:, None])
                q, c = np.nonzero(fine)
                score = _exact(points[mine[q]], points[near[q, c]])
                best = best_of_each(q, near[q, c], score, ids, k)
                yield _batch(ids[mine[q[best]]], ids[near[q, c][best]], score[best])
            cut = max(0, ready - window)
            held, done = tuple(a[cut:] for a in held), ready - cut

    return placed.mapInArrow(search, "query_id long, vec_id long, score double")


def _and_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def _ranked(found: DataFrame, k: int) -> DataFrame:
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return once.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _check(runs: DataFrame, ids: np.ndarray, queries: np.ndarray, least: np.ndarray, k: int) -> DataFrame:
    """Rows that reach a query's k-th score so far, from the runs that can hold any."""
    norms = np.sqrt((queries**2).sum(axis=1))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_ids, all_rows = batch.column("id").to_numpy(), matrix(batch, "v", queries.shape[1])
            for at in range(0, len(all_ids), RUN):
                row_ids, rows = all_ids[at:at + RUN], all_rows[at:at + RUN]
                centre = rows.mean(axis=0)
                radius = np.sqrt(((rows - centre) ** 2).sum(axis=1).max())
                mine = np.flatnonzero(queries @ centre + norms * radius + SLACK >= least)
                scores = queries[mine] @ rows.T
                q, r = np.nonzero((scores + SLACK >= least[mine][:, None]) & (ids[mine][:, None] != row_ids[None, :]))
                score = _exact(queries[mine[q]], rows[r])
                best = best_of_each(q, r, score, row_ids, k)
                yield _batch(ids[mine[q[best]]], row_ids[r[best]], score[best])

    return runs.mapInArrow(look, "query_id long, vec_id long, score double")


def nearest(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 20, k: int = 20,
            curves: int = 4, window: int = 100, seed: int = 5, complete: bool = True, block: int = QUERY_BLOCK) -> DataFrame:
    """The ``k`` rows of largest inner product found for each row whose id is divisible by ``every``."""
    spark = vectors.sparkSession
    point = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    rows = vectors.filter(F.col(id_col).isNotNull() & usable(vector_col) & F.exists(vector_col, lambda x: x != 0)).select(
        F.col(id_col).cast("long").alias("id"), point.alias("v"))
    rows = stage(rows, "ann-rows")
    result = None
    for length in lengths(rows):
        own = rows.filter(F.size("v") == length)
        longest = own.agg(F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))).alias("m")).first()["m"]
        placed = _curve_rows(own, length, longest, curves, seed)
        ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
        placed = stage(placed.repartitionByRange(ranges, "curve", "key", "id").sortWithinPartitions("curve", "key", "id"), "ann-curves")
        found = stage(_ranked(_windows(placed, length, every, k, window), k), "ann-windows")
        parts = [found.select("query_id", "vec_id", "score")]
        if complete:
            runs = placed.filter("curve = 0").select("id", "v")
            for ids, queries, _ in query_blocks(rows, every, length, block):
                reach = found.filter(F.col("query_id").between(int(ids[0]), int(ids[-1])) & (F.col("rank") == k))
                known = {r["query_id"]: r["score"] for r in reach.select("query_id", "score").collect()}  # one row a query
                least = np.array([known.get(int(i), -np.inf) for i in ids])
                parts.append(stage(_check(runs, ids, queries, least, k), "ann-check"))
        for part in parts:
            result = part if result is None else result.unionByName(part)
    if result is None:
        result = spark.createDataFrame([], "query_id long, vec_id long, score double")
    return _ranked(result, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


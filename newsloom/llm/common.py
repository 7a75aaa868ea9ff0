"""What the operators of this subpackage share: joins of checked size and slices of Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"  # a word; fixed by the contracts
BROADCAST_BYTES = 32 << 20  # a measured table up to this size is broadcast, a larger one joins by shuffle
SLICE_BYTES = 1 << 20  # text that one vectorised step works on


def bytes_of(staged: DataFrame, row_bytes: Column | int) -> int:
    """Bytes of a written table: the sum of ``row_bytes`` over its rows, at least 8 a row."""
    size = row_bytes if isinstance(row_bytes, Column) else F.lit(row_bytes)
    return staged.agg(F.coalesce(F.sum(F.greatest(size.cast("long"), F.lit(8))), F.lit(0)).alias("b")).first()["b"]


def sized_join(df: DataFrame, staged: DataFrame, on, how: str, row_bytes: Column | int,
               limit: int = BROADCAST_BYTES) -> DataFrame:
    """Join a written table by broadcast if it measures up to ``limit`` bytes, else by shuffle.

    The rows are the same either way. In the shuffle form adaptive execution
    splits hot keys.
    """
    if bytes_of(staged, row_bytes) <= limit:
        return df.join(F.broadcast(staged), on, how)
    return df.join(staged.hint("merge"), on, how)


def text_slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of a batch with about ``limit`` bytes of text; a longer text stands alone.

    Null texts become empty ones.
    """
    texts = batch.column(column)
    if pa.types.is_large_string(texts.type) or not pa.types.is_string(texts.type):
        texts = texts.cast(pa.string())
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    batch = batch.set_column(batch.schema.get_field_index(column), column, texts)
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if i > start and held + size > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(size)
    if start < batch.num_rows:
        yield batch.slice(start, batch.num_rows - start)

"""Landing files to tables as streams that process what is new and stop."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from newsloom.plans.silver import clean
from newsloom.sinks.upsert import upsert_buckets
from newsloom.sources.readers import PAYLOAD_KEYS, explode_payload


def read_landing(spark: SparkSession, path: str, schema: T.StructType, array_keys: Sequence[str] = PAYLOAD_KEYS,
                 *, max_files: int | None = None, multiline: bool = True) -> DataFrame:
    """Stream of article rows from payload files as they land."""
    reader = spark.readStream.schema(schema).option("multiLine", multiline)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return explode_payload(reader.json(path), array_keys)


def each_batch(rows: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Process everything available in batches, then stop."""
    return (
        rows.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def stream_to_silver(rows: DataFrame, source: str, path: str, checkpoint: str, *, order_by: str,
                     target_schema: T.StructType, now_ms: int, entities: bool = True,
                     buckets: int | None = None) -> StreamingQuery:
    """Clean a stream of bronze rows and load it by URL into a bucketed table.

    Inside a batch the first row per URL is kept; earlier batches are met in the
    keyed load, which rewrites only the buckets a batch hits. A batch that is
    repeated after a failure changes nothing, and neither does an empty one.
    """
    def load(batch: DataFrame, _: int) -> None:
        cleaned = clean(batch, source, order_by, entities=entities)
        upsert_buckets(path, cleaned, ["url"], buckets=buckets, now=F.timestamp_millis(F.lit(now_ms)),
                       target_schema=target_schema)

    return each_batch(rows, load, checkpoint)


def first_seen(rows: DataFrame, key: str = "url", event_time: str = "published_at",
               remember: str = "7 days") -> DataFrame:
    """First row per key; a key is forgotten once the watermark has passed it."""
    return rows.withWatermark(event_time, remember).dropDuplicatesWithinWatermark([key])


def append_stream(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append a stream to Parquet files, exactly once, and stop when nothing is left."""
    return (
        rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )

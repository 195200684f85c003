"""Running a builder's result as a stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def start(df: DataFrame, checkpoint: str, each_batch: Callable[[DataFrame, int], None], every: str = "10 seconds", mode: str = "append", once: bool = False) -> StreamingQuery:
    """Start a query that hands each micro-batch to ``each_batch(rows, batch_id)``.

    ``once`` drains what is there and stops; otherwise a batch starts every ``every``. Sinks
    get the batch id and so can skip a batch that is run again.
    """
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(each_batch)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)).start()


def append_stream(df: DataFrame, path: str, checkpoint: str, every: str = "10 seconds", once: bool = False) -> StreamingQuery:
    """Append a stream to Parquet files, exactly once through the file sink's log."""
    writer = df.writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)).start()


def drop_repeats(df: DataFrame, *keys: str) -> DataFrame:
    """Within the watermark, the first of messages with equal keys (at-least-once sources repeat)."""
    return df.dropDuplicatesWithinWatermark(list(keys)) if df.isStreaming else df.dropDuplicates(list(keys))

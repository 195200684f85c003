"""Event time and windows, alike for batch and streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import VEHICLE_TIME


def event_time(df: DataFrame, text: str, name: str = "event_time", fmt: str = VEHICLE_TIME, lateness: str = "0 seconds") -> DataFrame:
    """Assign event time from a text column, always read as UTC; on a stream also the watermark.

    Rows whose text does not match are dropped: without a time they belong to no window.
    """
    timed = df.withColumn(name, F.try_to_timestamp(F.col(text), F.lit(fmt))).where(F.col(name).isNotNull())
    return watermark(timed, name, lateness)


def watermark(df: DataFrame, time: str, lateness: str = "0 seconds") -> DataFrame:
    """The watermark of a stream; a batch has none. Times without zone become UTC times on streams."""
    if not df.isStreaming:
        return df
    return df.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, lateness)


def tumbling(time: str, size: str = "60 seconds") -> Column:
    """The epoch-aligned window of ``size`` that holds ``time``."""
    return F.window(F.col(time), size)


def sliding(time: str, size: str, step: str) -> Column:
    return F.window(F.col(time), size, step)


def sessions(df: DataFrame, key: str, time: str, gap: str, *aggregates: Column) -> DataFrame:
    """One row for each key's session; events at most ``gap`` apart are one session, which ends a gap after its last."""
    aggs = aggregates or (F.count(F.lit(1)).alias("events"),)
    grouped = df.groupBy(F.session_window(F.col(time), gap).alias("w"), F.col(key)).agg(*aggs)
    return grouped.select(key, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), *[c for c in grouped.columns if c not in ("w", key)])

"""Grouped aggregates: window metrics, the latest row of a key, versions, change data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import guarded_divide
from .windows import tumbling


def vehicle_metrics(events: DataFrame, key: str = "vehicle_id", time: str = "event_time", temperature: str = "temperature", vibration: str = "vibration", mileage: str = "mileage", size: str = "60 seconds") -> DataFrame:
    """Per key and window: latest time, highest temperature and vibration, and the mean mileage
    cut to an integer. One partial and one final hash aggregate; append mode emits a window once
    the watermark has passed its end."""
    grouped = events.groupBy(tumbling(time, size).alias("window"), F.col(key)).agg(
        F.max(time).alias("max_timestamp"),
        F.max(F.col(temperature).cast("double")).alias("max_temperature"),
        F.max(F.col(vibration).cast("double")).alias("max_vibration"),
        F.sum(F.col(mileage).cast("double")).alias("__sum"),
        F.count(F.lit(1)).alias("__n"),
    )
    mean = guarded_divide(F.coalesce("__sum", F.lit(0.0)), F.col("__n")).cast("bigint")
    return grouped.select(F.col(key), "window", "max_timestamp", "max_temperature", "max_vibration", mean.alias("avg_mileage"))


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of each key that is last in ``order``; of a key, one row a task crosses the exchange."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("__r")).select(*[F.col(c) if c in keys else F.col(f"__r.`{c}`").alias(c) for c in df.columns])


def replica(changes: DataFrame, keys: Sequence[str], order: Sequence[str], mod_type: str = "mod_type") -> DataFrame:
    """The state that a change log leaves: each key's last change by ``order``, whenever it came, without deleted keys."""
    return latest_per_key(changes, keys, order).where(F.col(mod_type) != "DELETE").drop(mod_type)


def versions(df: DataFrame, keys: Sequence[str], order: Sequence[str], most: int = 2) -> DataFrame:
    """The ``most`` last rows of each key with their number, newest first. The rank limit is pushed
    below the exchange, so a key of many rows ships ``most`` rows a task."""
    newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("version", F.row_number().over(newest)).where(F.col("version") <= most)


def offset_days(day: Column, first: Column | str) -> Column:
    """Days since ``first`` (a stored minimum, so that serving and training agree)."""
    return F.datediff(day.cast("date"), F.lit(first).cast("date") if isinstance(first, str) else first.cast("date"))


def frame_minimum(df: DataFrame, column: str):
    """The least value of a column, one row to the driver."""
    return df.agg(F.min(column)).first()[0]


def least(df: DataFrame, column: str) -> Column:
    """The least value of a column as a scalar subquery, for plans that need no value on the driver."""
    return df.agg(F.min(column)).scalar()

"""Joins of event streams and lookups in keyed tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .windows import tumbling, watermark


def windowed_left_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_time: str, right_time: str, size: str = "60 seconds", lateness: str = "0 seconds") -> DataFrame:
    """Left outer join of rows with equal keys in the same tumbling window.

    All m x n combinations of a key and window come out; left rows without a match have
    nulls; right rows without one give nothing. On streams both sides need the watermark
    that is set here, and unmatched rows come out when it has passed their window.
    """
    a = watermark(left, left_time, lateness).withColumn("window", tumbling(left_time, size))
    b = watermark(right, right_time, lateness).withColumn("window", tumbling(right_time, size)).drop(right_time)
    if not left.isStreaming:
        return a.join(b, [*keys, "window"], "left")
    names = {c: f"__r_{c}" for c in [*keys, "window"]}
    other = b.withColumnsRenamed(names)
    same = F.lit(True)
    for c, n in names.items():
        same = same & (F.col(c) == F.col(n))
    return a.join(other, same, "left").drop(*names.values())


def enrich(events: DataFrame, dimension: DataFrame, key: str, dimension_key: str | None = None, keep_misses: bool = True, columns: Sequence[str] | None = None, project: Callable[..., list[Column]] | None = None) -> DataFrame:
    """Events with the dimension's columns and enrichment_miss, by point lookup on ``key``.

    ``project(event, row)`` may build the result instead: both arguments give a column of
    their side by name, and it returns the columns of the enriched record.

    The dimension has one row a key. No hint is given: Catalyst broadcasts it if its size
    is below the session's threshold and shuffles both sides otherwise. Without
    ``keep_misses`` events without a row go, and so does the flag.
    """
    other = dimension_key or key
    if project is not None:
        struct = dimension.select(F.col(other).alias("__key"), F.struct(*dimension.columns).alias("__row"))
        joined = events.join(struct, F.col(key) == F.col("__key"), "left" if keep_misses else "inner")
        miss = [F.col("__key").isNull().alias("enrichment_miss")] if keep_misses else []
        return joined.select(*project(lambda n: F.col(f"`{n}`"), lambda n: F.col(f"__row.`{n}`").alias(n)), *miss)
    names = [c for c in (columns or dimension.columns) if c != other]
    side = dimension.select(F.col(other).alias("__key"), *names, F.lit(False).alias("enrichment_miss"))
    joined = events.join(side, F.col(key) == F.col("__key"), "left" if keep_misses else "inner").drop("__key")
    return joined.withColumn("enrichment_miss", F.coalesce("enrichment_miss", F.lit(True))) if keep_misses else joined.drop("enrichment_miss")


def cogroup(left: DataFrame, right: DataFrame, keys: Sequence[str], left_value: Column, right_value: Column, names: tuple[str, str] = ("left", "right")) -> DataFrame:
    """For each key the sorted lists of both sides' values; a side without rows has an empty list.

    A key's lists are one row, so it is meant for keys of bounded size (a window's).
    """
    a = left.groupBy(*keys).agg(F.sort_array(F.collect_list(left_value)).alias(names[0]))
    b = right.groupBy(*keys).agg(F.sort_array(F.collect_list(right_value)).alias(names[1]))
    out = a.join(b, list(keys), "full")
    return out.select(*keys, *[F.coalesce(n, F.array()).alias(n) for n in names])


def not_null(df: DataFrame, *columns: str) -> DataFrame:
    """Rows that have a value in each of the columns."""
    return df.dropna(subset=list(columns))


def in_ids(df: DataFrame, column: str, ids: Sequence) -> DataFrame:
    """Rows whose value is in a short literal list."""
    return df.where(F.col(column).isin(list(ids)))


def in_table(df: DataFrame, ids: DataFrame, column: str, other: str | None = None) -> DataFrame:
    """Rows whose value is in a column of a table (each row once)."""
    return df.join(ids.select(F.col(other or column).alias(column)), column, "left_semi")

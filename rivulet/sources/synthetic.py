"""Reproducible synthetic inputs: vehicles, maintenance records and labelled model samples.

Numbers come from a linear congruential step on the row number, so any engine can
make the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def draw(n: Column, salt: int, below: int) -> Column:
    """A number of 0 to ``below`` - 1 made from ``n``."""
    return F.floor(F.pmod((n + salt) * 1103515245 + 12345, F.lit(2147483648)) / 65536).cast("bigint") % below


def vehicles(spark: SparkSession, rows: int, start: str = "2025-01-18 15:56:41") -> DataFrame:
    n = F.col("id")
    return spark.range(rows).select(
        (n + 1000).cast("string").alias("vehicle_id"),
        F.date_format(F.lit(start).cast("timestamp_ntz"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"),
        (60 + draw(n, 1, 40)).cast("int").alias("temperature"),
        (1000 + draw(n, 2, 2000)).cast("int").alias("rpm"),
        (draw(n, 3, 100) / 100).alias("vibration"),
        draw(n, 4, 101).cast("int").alias("fuel_level"),
        (10000 + draw(n, 5, 40000)).cast("int").alias("mileage"),
    )


def maintenance(spark: SparkSession, rows: int, as_of: str = "2025-01-18") -> DataFrame:
    n = F.col("id")
    kinds = F.array(*[F.lit(k) for k in ("coolant_refill", "belt_exchange", "lamp_check", "chain_greasing", "filter_swap")])
    return spark.range(rows).select(
        (n + 1000).cast("string").alias("vehicle_id"),
        F.date_format(F.date_sub(F.lit(as_of).cast("date"), draw(n, 6, 365).cast("int")), "yyyy-MM-dd").alias("last_service_date"),
        F.element_at(kinds, (draw(n, 7, 5) + 1).cast("int")).alias("maintenance_type"),
        F.lit("Velora").alias("make"),
        F.lit("Cargo 9").alias("model"),
    )


def model_samples(spark: SparkSession, rows: int, as_of: str = "2025-01-18") -> DataFrame:
    return labelled(spark.range(rows), as_of)


def labelled(numbers: DataFrame, as_of: str = "2025-01-18") -> DataFrame:
    """A labelled sample for each number in ``id``."""
    from ..operators.inference import needs_maintenance

    n = F.col("id")
    base = numbers.select(
        (n + 1000).cast("string").alias("vehicle_id"),
        (50 + draw(n, 8, 50)).cast("int").alias("max_temperature"),
        (draw(n, 9, 1000) / 1000).alias("max_vibration"),
        F.date_format(F.date_sub(F.lit(as_of).cast("date"), draw(n, 10, 365).cast("int")), "yyyy-MM-dd").alias("last_service_date"),
    )
    return base.withColumn("needs_maintenance", needs_maintenance(as_of=as_of))

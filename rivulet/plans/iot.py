"""Vehicle telemetry: windowed metrics, enrichment, prediction."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import VEHICLE_TIME
from ..functions.schemas import MAINTENANCE_ANALYTICS, VEHICLE_EVENT, ParseOutput, from_warehouse_string
from ..operators.aggregates import vehicle_metrics
from ..operators.inference import needs_maintenance
from ..operators.joins import enrich
from ..operators.jsonio import sanitize
from ..operators.lookups import HIT, Client, lookup
from ..operators.windows import event_time


@dataclass(frozen=True)
class Config:
    window: str = "60 seconds"
    lateness: str = "0 seconds"
    row_key: str = "vehicle_id"
    as_of: str = "2025-01-18"
    timeout: float = 10.0
    age: float = 60.0


def parse(messages: DataFrame, cfg: Config = Config()) -> ParseOutput:
    """Typed events with event time; what is no object, or has no vehicle or readable time, is an error."""
    text = F.col("value").cast("string")
    rows = messages.select(text.alias("input_data"), F.col("publish_time").cast("timestamp").alias("publish_time"), F.explode(F.array(sanitize(text, VEHICLE_EVENT))).alias("e"))
    timed = F.try_to_timestamp(F.col("e.timestamp"), F.lit(VEHICLE_TIME))
    error = F.when(F.col("e").isNull(), "not a JSON object").when(F.col("e.vehicle_id").isNull(), "missing: vehicle_id").when(timed.isNull(), "missing or malformed: timestamp")
    checked = rows.withColumn("error_message", error)
    errors = checked.where("error_message is not null").select("input_data", "error_message", F.col("publish_time").alias("timestamp"))
    return ParseOutput(event_time(checked.where("error_message is null").select("e.*"), "timestamp", lateness=cfg.lateness), errors)


def enriched(metrics: DataFrame, dimension: DataFrame, cfg: Config = Config(), keep_misses: bool = False) -> DataFrame:
    return enrich(metrics, dimension, cfg.row_key, keep_misses=keep_misses, project=_projection)


def enriched_live(metrics: DataFrame, connect: Callable[[], Client], cfg: Config = Config(), keep_misses: bool = False) -> DataFrame:
    """``enriched`` by live lookups of each vehicle's maintenance row, as it is when its window closes."""
    found = lookup(metrics.select(*[c for c in metrics.columns if c != "window"]), connect, cfg.row_key, "last_service_date string, maintenance_type string, model string", cfg.timeout, age=cfg.age, misses="keep" if keep_misses else "drop")
    miss = [(F.col("lookup") != HIT).alias("enrichment_miss")] if keep_misses else []
    return found.select(*_projection(F.col, F.col), *miss)


def _projection(event, row) -> list[Column]:
    """The enriched record's fields, of the metrics and of the vehicle's maintenance row."""
    return [event(n) for n in ("vehicle_id", "max_temperature", "max_vibration")] + [event("max_timestamp").alias("latest_timestamp"), event("avg_mileage")] + [row(n) for n in ("last_service_date", "maintenance_type", "model")]


def to_sink(scored: DataFrame) -> DataFrame:
    """The sink's columns and types; avg_mileage is not among them."""
    return scored.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in from_warehouse_string(MAINTENANCE_ANALYTICS).fields])


def build(messages: DataFrame, dimension: DataFrame | Callable[[], Client], cfg: Config = Config(), predict: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """From messages to sink rows. ``dimension`` is a table, read when the query starts, or makes a client for live lookups.
    ``predict`` adds needs_maintenance; by default the rule does."""
    metrics = vehicle_metrics(parse(messages, cfg).good, size=cfg.window)
    rows = enriched(metrics, dimension, cfg) if isinstance(dimension, DataFrame) else enriched_live(metrics, dimension, cfg)
    by_rule = lambda df: df.withColumn("needs_maintenance", needs_maintenance(as_of=cfg.as_of).cast("bigint"))
    return to_sink((predict or by_rule)(rows))

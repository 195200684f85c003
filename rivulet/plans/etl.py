"""Taxi events: sanitise, type, upsert; bad messages become error rows. And its change replica."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import rfc3339
from ..functions.schemas import TAXI_EVENT, TAXI_KEY, ParseOutput
from ..operators.jsonio import parse_typed
from ..operators import sinks


@dataclass(frozen=True)
class Config:
    table: str = "taxi_events"
    order: tuple[str, ...] = ("timestamp", "passenger_count")


def build(messages: DataFrame) -> ParseOutput:
    """Typed taxi events, and the errors that would otherwise be lost."""
    return parse_typed(messages, TAXI_EVENT)


def to_table(events: DataFrame) -> DataFrame:
    """Events as table rows: the time as a timestamp (null if unreadable), integers as 64 bits."""
    return events.withColumn("timestamp", rfc3339(F.col("timestamp"))).withColumns({c: F.col(c).cast("bigint") for c in ("point_idx", "passenger_count")})


def upsert(events: DataFrame, path: str, cfg: Config = Config()) -> None:
    """Upsert typed events into the table at ``path``; a batch that is run again changes nothing."""
    sinks.upsert(to_table(events), path, TAXI_KEY, list(cfg.order))


def change_rows(records: DataFrame, schema: T.StructType) -> DataFrame:
    """Change records (mod_type, commit_time, keys, old_values, new_values: JSON objects) as rows to apply:
    the key fields, the new values (a delete has the old ones), and changed, the columns whose value differs."""
    names = [f.name for f in schema.fields]
    part = lambda c: F.from_json(c, schema)
    parsed = records.withColumns({"__k": part("keys"), "__o": part("old_values"), "__n": part("new_values")})
    value = lambda n: F.coalesce(F.when(F.col("mod_type") == "DELETE", F.col(f"__o.{n}")).otherwise(F.col(f"__n.{n}")), F.col(f"__k.{n}"))
    differs = F.array_compact(F.array(*[F.when(~F.col(f"__o.{n}").eqNullSafe(F.col(f"__n.{n}")), F.lit(n)) for n in names]))
    return parsed.select(*[value(n).alias(n) for n in names], "commit_time", "mod_type", F.when(F.col("mod_type") == "UPDATE", differs).alias("changed"))

"""Clickstream: JSON rows below a size limit into an existing table, all failures as dead letters."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.schemas import CLICKSTREAM
from ..operators.joins import enrich
from ..operators.jsonio import MOST_BYTES, parse_objects, split_tagged
from ..operators.sinks import append, conform, dead_letters
from ..operators.windows import sessions, watermark


@dataclass(frozen=True)
class Config:
    most_bytes: int = MOST_BYTES
    session_gap: str = "1 minute"


def parse(messages: DataFrame, schema: T.StructType = CLICKSTREAM, cfg: Config = Config()) -> tuple[DataFrame, DataFrame]:
    """(rows that fit the table, dead letters of every kind)."""
    tagged = parse_objects(messages.select(F.col("value").cast("string").alias("value"), "publish_time"), most=cfg.most_bytes)
    good, bad = split_tagged(tagged)
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    rows, rejected = conform(good.select(F.from_json("value", text).alias("j")).select("j.*"), schema)
    letters = dead_letters(bad.select("value", F.col("error_tag").alias("error")))
    return rows, letters.unionByName(dead_letters(rejected))


def require_table(spark: SparkSession, path: str) -> None:
    """Rows go to an existing table only; raises if there is none."""
    spark.read.parquet(path).schema  # noqa: B018


def enriched(rows: DataFrame, dimension: DataFrame, key: str = "curr", dimension_key: str | None = None, keep_misses: bool = True) -> DataFrame:
    """Click rows with the columns of a keyed table; misses are flagged."""
    return enrich(rows, dimension, key, dimension_key, keep_misses)


def write_batch(messages: DataFrame, table: str, dead: str, schema: T.StructType = CLICKSTREAM, cfg: Config = Config()) -> None:
    """Append a batch; the table must exist."""
    rows, letters = parse(messages, schema, cfg)
    require_table(messages.sparkSession, table)
    append(rows, table)
    append(letters, dead)


def user_sessions(clicks: DataFrame, user: str, time: str, cfg: Config = Config()) -> DataFrame:
    return sessions(watermark(clicks, time), user, time, cfg.session_gap)

"""Messages in, model outputs out: anomaly detection, text generation, marketing."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import utf8
from ..operators.inference import ModelHandler, formatted, run_inference, split_inference, tagged_inference
from ..operators.joins import enrich
from ..operators.sinks import publish


@dataclass(frozen=True)
class Config:
    batch: int = 64
    strict_utf8: bool = True


def examples(messages: DataFrame, cfg: Config = Config(), features: DataFrame | None = None, key: str | None = None) -> DataFrame:
    """What the model sees of each message: its text or, with ``features``, the message, a JSON object, enriched by its ``key`` field."""
    texts = messages.select(utf8(F.col("value"), cfg.strict_utf8).alias("value"))
    if features is None or key is None:
        return texts
    keyed = texts.withColumn("__k", F.get_json_object("value", f"$.{key}"))
    other = features.withColumn(key, F.col(key).cast("string"))
    joined = enrich(keyed, other, "__k", key)
    extra = [c for c in other.columns if c != key]
    return joined.select(F.to_json(F.struct(F.col("value").alias("message"), *extra), {"ignoreNullFields": "false"}).alias("value"))


def build(messages: DataFrame, handler: ModelHandler, cfg: Config = Config(), features: DataFrame | None = None, key: str | None = None) -> DataFrame:
    """Answer messages for each message; an example that fails fails the query (``tagged`` keeps it apart)."""
    return formatted(run_inference(examples(messages, cfg, features, key), handler, batch=cfg.batch))


def tagged(messages: DataFrame, handler: ModelHandler, cfg: Config = Config(), features: DataFrame | None = None, key: str | None = None) -> DataFrame:
    """(example, inference, model_id, error) of each message."""
    return tagged_inference(examples(messages, cfg, features, key), handler, batch=cfg.batch)


def write_batch(rows: DataFrame, responses: str, letters: str, number: int) -> None:
    """Publish the answers of a micro-batch of ``tagged`` messages; those that failed go to its folder in ``letters``.

    The model is asked once: its outputs are kept for both.
    """
    kept = rows.persist()
    try:
        good, bad = split_inference(kept)
        bad.write.mode("overwrite").parquet(f"{letters}/batch_id={number}")
        publish(formatted(good), responses)
    finally:
        kept.unpersist()

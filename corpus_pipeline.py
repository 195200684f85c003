"""Corpus pipeline over ``documents``: stages of the llm operators, each written and read again."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from rivulet.llm._common import shared_folder, small_batches
from rivulet.llm import decontaminate, near_dedup, quality, sentencepieces, substring_dedup


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    small_batches(spark)
    return quality.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (5-word shingles, 0.8)."""
    small_batches(spark)
    return near_dedup.deduplicate(docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document holds."""
    small_batches(spark)
    return substring_dedup.cut(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of ten words with a benchmark item."""
    small_batches(spark)
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the ids of their pieces."""
    small_batches(spark)
    return sentencepieces.encode(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("near dedup", near_dedup_stage),
    ("substring dedup", substring_stage),
    ("decontamination", decontaminate_stage),
    ("sentencepiece encoding", encode_stage),
]

#: Model fitting, sketching and chaining have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def _folder(spark: SparkSession) -> str:
    return os.path.join(shared_folder(spark), f"pipeline-{uuid.uuid4().hex}")


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each stage is written as Parquet and reread."""
    folder = _folder(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name.replace(' ', '-')}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

"""Model inference in batches, the maintenance model, and its rule.

``ModelHandler`` has three hooks; ``run_inference`` applies it in ``mapInPandas``, where
the model is loaded once in each Python worker and kept for its life. Workers share no objects:
large weights are shared by mapping them (``mapped.MappedHandler``).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from typing import Any, Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import prediction_text
from .aggregates import frame_minimum, offset_days

PREDICTION = "example string, inference string, model_id string"
_models: dict[str, Any] = {}
MOST_MODELS = 4  # that a worker keeps


class ModelHandler(Protocol):
    model_id: str

    def load_model(self) -> Any:
        """The model, made on the worker."""

    def run_inference(self, batch: Sequence[str], model: Any) -> Iterable[str]:
        """One output for each example, in order."""


class TemplateHandler:
    """A local text model: calls ``generate(text, max_length)`` of what ``load`` returns, one text at a time."""

    def __init__(self, load: Callable[[], Any], model_id: str, max_length: int = 64):
        self.load, self.model_id, self.max_length = load, model_id, max_length

    def load_model(self):
        return self.load()

    def run_inference(self, batch, model):
        return [model.generate(text, max_length=self.max_length) for text in batch]


class EndpointHandler:
    """A remote model: ``connect`` makes a client whose ``predict(instances)`` takes a list.

    With ``json_instances`` each example is a JSON object and goes as such, not as its text;
    one that is no JSON is an example that fails.
    """

    def __init__(self, connect: Callable[[], Any], endpoint: str, json_instances: bool = False):
        self.connect, self.model_id, self.json_instances = connect, endpoint, json_instances

    def load_model(self):
        return self.connect()

    def run_inference(self, batch, model):
        return [str(x) for x in model.predict([json.loads(x) for x in batch] if self.json_instances else list(batch))]


def answers(handler: ModelHandler, texts: Sequence[str], model: Any) -> list[tuple[str | None, str | None]]:
    """(output, error) of each text. A batch that fails, or has another number of outputs, is halved until the
    texts that fail stand alone: one of n costs about 2 log2(n) calls more."""
    try:
        out = [str(x) if x is not None else None for x in handler.run_inference(texts, model)]
        if len(out) != len(texts):
            raise ValueError(f"{len(out)} outputs for {len(texts)} examples")
        return [(x, None) for x in out]
    except Exception as e:  # noqa: BLE001  whatever a model raises is the example's error
        if len(texts) == 1:
            return [(None, f"{type(e).__name__}: {e}")]
    half = len(texts) // 2
    return answers(handler, texts[:half], model) + answers(handler, texts[half:], model)


def tagged_inference(df: DataFrame, handler: ModelHandler, example: str = "value", batch: int = 64) -> DataFrame:
    """(example, inference, model_id, error) of each row; a null example is an empty text. Examples that fail have a null
    inference and the error's text; the others of their batch are answered."""
    own = uuid.uuid4().hex  # models are kept by handler: two handlers may share a model_id

    def predict(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = _models.get(own)
        if model is None:
            while len(_models) >= MOST_MODELS:
                _models.pop(next(iter(_models)))
            model = _models[own] = handler.load_model()
        for frame in frames:
            texts = frame["example"].fillna("").tolist()
            out = [x for i in range(0, len(texts), batch) for x in answers(handler, texts[i : i + batch], model)]
            rows = [(text, found, handler.model_id, error) for text, (found, error) in zip(texts, out, strict=True)]
            yield pd.DataFrame(rows, columns=["example", "inference", "model_id", "error"])

    return df.select(F.col(example).cast("string").alias("example")).mapInPandas(predict, f"{PREDICTION}, error string")


def run_inference(df: DataFrame, handler: ModelHandler, example: str = "value", batch: int = 64) -> DataFrame:
    """(example, inference, model_id) of each row; an example that fails fails the query, and names itself.
    ``tagged_inference`` keeps such examples apart instead."""
    found = tagged_inference(df, handler, example, batch)
    checked = F.when(F.col("error").isNotNull(), F.raise_error(F.concat(F.lit("inference failed for "), F.substring("example", 1, 200), F.lit(": "), F.col("error")))).otherwise(F.col("inference"))
    return found.select("example", checked.cast("string").alias("inference"), "model_id")


def split_inference(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(answers, errors: input_data, error_message, timestamp) of tagged inferences, which should be persisted first."""
    bad = tagged.where("error is not null").select(F.col("example").alias("input_data"), F.col("error").alias("error_message"), F.current_timestamp().alias("timestamp"))
    return tagged.where("error is null").drop("error"), bad


def formatted(predictions: DataFrame) -> DataFrame:
    """Predictions as the text messages that go back to a queue."""
    return predictions.select(prediction_text(F.col("example"), F.col("inference")).alias("value"))


def needs_maintenance(temperature: str = "max_temperature", vibration: str = "max_vibration", serviced: str = "last_service_date", as_of: Column | str = "2025-01-18", hot: float = 75, shaking: float = 0.5, days: int = 180) -> Column:
    """The labelling rule: too hot, shaking too much, or last serviced more than ``days`` before ``as_of``."""
    day = F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of
    old = F.coalesce(F.col(serviced).try_cast("date") < F.date_sub(day, days), F.lit(False))
    return F.coalesce(F.col(temperature) > hot, F.lit(False)) | F.coalesce(F.col(vibration) > shaking, F.lit(False)) | old


class MaintenanceModel:
    """Logistic regression on highest temperature, highest vibration and days since the first
    service date seen in training, which is kept with the model."""

    FEATURES = ("max_temperature", "max_vibration", "service_day")

    def __init__(self, fitted, first_day):
        self.fitted, self.first_day = fitted, first_day

    @classmethod
    def train(cls, samples: DataFrame, share: float = 0.8, key: str = "vehicle_id", held: Column | None = None) -> tuple[MaintenanceModel, DataFrame]:
        """(model, the held-out rows). A row's key decides its side (or ``held`` does), whatever the order or number of rows."""
        from pyspark.ml.classification import LogisticRegression

        out = held if held is not None else F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(1000)) >= int(1000 * share)
        fit_on, left = samples.where(~out), samples.where(out)
        first = frame_minimum(fit_on, "last_service_date")
        rows = cls._vectors(fit_on, first).withColumn("label", F.col("needs_maintenance").cast("double"))
        return cls(LogisticRegression(featuresCol="features", labelCol="label", maxIter=100).fit(rows), first), left

    @classmethod
    def _vectors(cls, df: DataFrame, first_day) -> DataFrame:
        from pyspark.ml.feature import VectorAssembler

        day = offset_days(F.col("last_service_date"), first_day)
        numbered = df.withColumn("service_day", F.coalesce(day, F.lit(0)).cast("double")).withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cls.FEATURES[:2]})
        return VectorAssembler(inputCols=list(cls.FEATURES), outputCol="features").transform(numbered)

    def predict(self, df: DataFrame) -> DataFrame:
        """``df`` with needs_maintenance (0 or 1)."""
        scored = self.fitted.transform(self._vectors(df, self.first_day))
        return scored.withColumn("needs_maintenance", F.col("prediction").cast("bigint")).select(*[c for c in df.columns if c != "needs_maintenance"], "needs_maintenance")

    def save(self, path: str) -> None:
        self.fitted.write().overwrite().save(f"{path}/model")
        spark = self.fitted._sparkSession if hasattr(self.fitted, "_sparkSession") else None
        from pyspark.sql import SparkSession

        (spark or SparkSession.active()).createDataFrame([(str(self.first_day),)], "first_day string").coalesce(1).write.mode("overwrite").json(f"{path}/first_day")

    @classmethod
    def load(cls, path: str) -> MaintenanceModel:
        from pyspark.ml.classification import LogisticRegressionModel
        from pyspark.sql import SparkSession

        first = SparkSession.active().read.schema("first_day string").json(f"{path}/first_day").first()[0]
        return cls(LogisticRegressionModel.load(f"{path}/model"), first)

"""Log replication: entries posted to a collector in batches, undeliverable ones to a queue."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import delivery
from ..operators.sinks import envelope


@dataclass(frozen=True)
class Config:
    """``tries`` posts of a micro-batch and ``attempts`` micro-batches, ``seconds`` and more apart, before an event is dead."""

    batch: int = 100
    tries: int = 3
    compress: bool = True
    attempts: int = 1
    seconds: float = 60.0
    backoff: delivery.Backoff = delivery.Backoff()


def deliver(messages: DataFrame, send: Callable[[bytes], int | None], dead: str, report: str, cfg: Config = Config(), batch_id: int = 0, queue: str | None = None) -> None:
    """Post the messages of a batch and what is due of the retry queue, keep the report, and put dead events into the dead-letter folder.

    Report, queue and dead letters lie in folders of the batch's own. A batch that is run again after its report was
    finished is not posted again, and writes the same queue and dead letters over the old ones.
    """
    rows = messages.where(F.col("value").isNotNull()).select(envelope(F.col("value")).alias("value"))
    delivery.deliver(rows, send, report, queue or f"{report.rstrip('/')}_queue", dead, batch_id, cfg.backoff, cfg.batch, cfg.tries, cfg.attempts, cfg.compress, cfg.seconds)

"""Delivery to a collector that can fail: back-off within a task, a retry queue over micro-batches, a paced rate.

A micro-batch posts its new events and those of the queue that are due, and writes a report of all
of them; what is left to try (the new queue) and what never can be delivered (dead letters) follow from the
report alone. The report's success mark is the commit: a batch that runs again with it posts
nothing and writes the same queue and letters over the old ones; without it everything in the batch
is posted again, with the same keys. A key is the digest of a body, so a collector that remembers keys
takes each body once; one that does not may see the bodies of one interrupted batch twice.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import inspect
import random
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

OK, RETRY, DEAD, WAIT = "ok", "retry", "dead", "wait"


@dataclass(frozen=True)
class Backoff:
    """Waits of ``first`` seconds, each ``factor`` times the last, ``most`` at most; up to ``jitter`` of a wait is left out by lot."""

    first: float = 0.5
    factor: float = 2.0
    most: float = 60.0
    jitter: float = 0.5
    sleep: Callable[[float], None] = field(default=time.sleep, compare=False)

    def seconds(self, failures: int, lot: float) -> float:
        """The wait after so many failures; ``lot`` is a number of [0, 1)."""
        return min(self.most, self.first * self.factor ** (failures - 1)) * (1 - self.jitter * lot)


def outcome_of(status: int | None) -> str:
    """Delivered, worth another try (no reply, 408, 429, 5xx), or never deliverable."""
    if status is not None and 200 <= status < 300:
        return OK
    return RETRY if status is None or status in (408, 429) or status >= 500 else DEAD


def attempt(raw: bytes, send: Callable, backoff: Backoff, tries: int, compress: bool = True) -> tuple[str, int, str, int | None, str]:
    """(body in base64, its bytes, key, status, outcome) after up to ``tries`` posts. An error that ``send`` raises is no reply."""
    body = gzip.compress(raw, mtime=0) if compress else raw
    key = hashlib.sha256(body).hexdigest()
    keyed = len(inspect.signature(send).parameters) > 1
    status: int | None = None
    for n in range(1, tries + 1):
        try:
            status = send(body, key) if keyed else send(body)
        except Exception:  # noqa: BLE001  whatever a client raises, there is no reply
            status = None
        if outcome_of(status) != RETRY or n == tries:
            break
        backoff.sleep(backoff.seconds(n, random.random()))
    return base64.b64encode(body).decode(), len(body), key, status, outcome_of(status)


# ------------------------------------------------------------------ the queue

QUEUE = "value string, failures int, due timestamp"
REPORT = "events array<struct<value: string, failures: int>>, due timestamp, body string, bytes int, key string, status int, outcome string"


def finished(spark: SparkSession, path: str) -> bool:
    """Whether a job has written ``path`` to its end."""
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark)


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    """The numbers of the batches below ``folder``, ascending. Old ones are pruned, so there are few."""
    top = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = top.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(top)] if fs.exists(top) else []
    return sorted(int(n.removeprefix("batch_id=")) for n in names if n.startswith("batch_id="))


def _remove(spark: SparkSession, path: str) -> None:
    gone = spark._jvm.org.apache.hadoop.fs.Path(path)
    gone.getFileSystem(spark._jsc.hadoopConfiguration()).delete(gone, True)


def waiting(spark: SparkSession, queue: str, before: int | None = None) -> DataFrame:
    """The events that are still to be delivered: the queue of the last finished batch (before number ``before``)."""
    done = [n for n in _numbers(spark, queue) if (before is None or n < before) and finished(spark, f"{queue}/batch_id={n}")]
    if not done:
        return spark.createDataFrame([], QUEUE)
    return spark.read.schema(QUEUE).parquet(f"{queue}/batch_id={done[-1]}")


def posted(rows: DataFrame, send: Callable, backoff: Backoff, batch: int, tries: int, compress: bool) -> DataFrame:
    """The report of events (value, failures, due), posted in batches of at most ``batch`` where they lie; those that are not due wait."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            ready = frame["ready"].to_numpy(dtype=bool)
            out = [([{"value": v, "failures": int(n)}], due, None, None, None, None, WAIT) for v, n, due in frame.loc[~ready, ["value", "failures", "due"]].itertuples(index=False)]
            events = [{"value": v, "failures": int(n)} for v, n in frame.loc[ready, ["value", "failures"]].itertuples(index=False)]
            for i in range(0, len(events), batch):
                part = events[i : i + batch]
                out.append((part, None, *attempt("".join(e["value"] for e in part).encode(), send, backoff, tries, compress)))
            made = pd.DataFrame(out, columns=["events", "due", "body", "bytes", "key", "status", "outcome"])
            yield made.astype({"due": "datetime64[us]"})

    now = F.coalesce(F.col("due") <= F.current_timestamp(), F.lit(True))
    return rows.select("value", "failures", "due", now.alias("ready")).mapInPandas(run, REPORT)


def left_over(report: DataFrame, backoff: Backoff, attempts: int, seconds: float = 60.0) -> DataFrame:
    """The queue after a report: events that wait, and those to be tried again with the time from when on.

    The wait is that of the back-off after so many micro-batches, in units of ``seconds``; its lot is drawn from
    the event, so the report gives one queue only.
    """
    again = report.where(F.col("outcome") == RETRY).select(F.explode("events").alias("e"), "written").select("e.value", (F.col("e.failures") + 1).alias("failures"), "written")
    again = again.where(F.col("failures") < attempts)
    lot = F.pmod(F.xxhash64("value", "failures"), F.lit(1 << 20)) / (1 << 20)
    wait = F.least(F.lit(backoff.most), F.lit(seconds) * F.pow(F.lit(backoff.factor), F.col("failures") - 1)) * (1 - backoff.jitter * lot)
    tried = again.select("value", F.col("failures").cast("int").alias("failures"), F.timestamp_micros((F.unix_micros("written") + wait * 1_000_000).cast("bigint")).alias("due"))
    held = report.where(F.col("outcome") == WAIT).select(F.explode("events").alias("e"), "due").select("e.value", "e.failures", "due")
    return tried.unionByName(held)


def undeliverable(report: DataFrame, attempts: int) -> DataFrame:
    """The events of a report that no further try can help, with the last status."""
    rows = report.where(F.col("outcome").isin(RETRY, DEAD)).select(F.explode("events").alias("e"), "status", "outcome")
    return rows.where((F.col("outcome") == DEAD) | (F.col("e.failures") + 1 >= attempts)).select(F.col("e.value").alias("value"), "status", (F.col("e.failures") + 1).alias("attempts"))


def deliver(messages: DataFrame, send: Callable, report: str, queue: str, dead: str, batch_id: int, backoff: Backoff = Backoff(), batch: int = 100, tries: int = 3, attempts: int = 5, compress: bool = True, seconds: float = 60.0, keep: int = 3) -> None:
    """Deliver the events (value: the collector's envelope) of micro-batch ``batch_id`` and what is due of the queue.

    An event is posted up to ``tries`` times a micro-batch, in ``attempts`` micro-batches at most. Report, queue
    and dead letters lie in folders of the batch's own; of the queue's the last ``keep`` stay.
    """
    spark, own = messages.sparkSession, f"{report}/batch_id={batch_id}"
    if not finished(spark, own):
        new = messages.select(F.col("value").cast("string").alias("value"), F.lit(0).alias("failures"), F.lit(None).cast("timestamp").alias("due"))
        rows = new.unionByName(waiting(spark, queue, batch_id)).where("value is not null")
        told = posted(rows, send, backoff, batch, tries, compress).withColumn("written", F.current_timestamp())
        told.write.mode("overwrite").parquet(own)
    said = spark.read.schema(f"{REPORT}, written timestamp").parquet(own)
    left_over(said, backoff, attempts, seconds).write.mode("overwrite").parquet(f"{queue}/batch_id={batch_id}")
    undeliverable(said, attempts).write.mode("overwrite").parquet(f"{dead}/batch_id={batch_id}")
    for old in [n for n in _numbers(spark, queue) if n < batch_id][: -keep or None]:
        _remove(spark, f"{queue}/batch_id={old}")


# --------------------------------------------------------------------- pacing


class TokenBucket:
    """Lets ``rate`` things a second pass, and ``burst`` at once."""

    def __init__(self, rate: float, burst: float = 1.0, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.rate, self.burst, self.clock, self.sleep = rate, burst, clock, sleep
        self.tokens, self.at = burst, clock()

    def take(self, n: int = 1) -> None:
        """Wait until ``n`` may pass."""
        now = self.clock()
        self.tokens = min(self.burst, self.tokens + (now - self.at) * self.rate) - n
        self.at = now
        if self.tokens < 0:
            self.sleep(-self.tokens / self.rate)


def paced(df: DataFrame, rate: float, lanes: int = 1, most: int = 100) -> DataFrame:
    """``df`` in at most ``lanes`` partitions that together let ``rate`` rows a second pass to the writer behind them.

    A lane has its share of the rate, as partitions that run one after another would not reach it otherwise:
    give as many lanes as tasks run at once. Rows pass in slices of a tenth of a second, ``most`` at most.
    """
    share = rate / lanes
    step = max(1, min(most, int(share / 10)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket = TokenBucket(share, float(step))
        for batch in batches:
            for i in range(0, batch.num_rows, step):
                part = batch.slice(i, step)
                bucket.take(part.num_rows)
                yield part

    return df.coalesce(lanes).mapInArrow(run, df.schema)


def admission(rate: float, every: float) -> dict[str, str]:
    """The queue reader's option that admits ``rate`` messages a second, if a micro-batch starts every ``every`` seconds."""
    return {"maxOffsetsPerTrigger": str(max(1, int(rate * every)))}

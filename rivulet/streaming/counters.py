"""Counters of a stream, added up over its micro-batches.

A micro-batch's observed metrics are kept by query and batch number, so a batch that runs again after a
failure replaces its own numbers; the totals are those of the messages, however often they were read.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener


class CounterLog(StreamingQueryListener):
    """Writes the metrics ``name`` of each finished micro-batch to a file of its own below ``path``."""

    def __init__(self, spark: SparkSession, path: str, name: str = "job_counters"):
        self.spark, self.path, self.name = spark, path.rstrip("/"), name

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        progress = event.progress
        found = progress.observedMetrics.get(self.name)
        if found is not None:
            self.put(str(progress.id), progress.batchId, found.asDict())

    def put(self, query: str, batch: int, metrics: dict) -> None:
        """Keep a batch's metrics, in place of earlier ones."""
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{query}/{batch}.json")
        out = place.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(place, True)
        try:
            out.write(bytearray(json.dumps({"query": query, "batch": batch, **metrics}).encode()))
        finally:
            out.close()


def totals(spark: SparkSession, path: str, *names: str) -> DataFrame:
    """One row for each query that wrote below ``path``: its batches and the sums of the named counters."""
    schema = "query string, batch bigint, " + ", ".join(f"`{n}` bigint" for n in names)
    rows = spark.read.schema(schema).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").json(path)
    return rows.groupBy("query").agg(F.count("*").alias("batches"), *[F.sum(n).alias(n) for n in names])

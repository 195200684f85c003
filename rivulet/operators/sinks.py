"""Sinks: appends, conformed appends with dead letters, upserts, replicas, log posts.

Each has a pure part (what to write, a DataFrame) and a thin writer that works for a
batch and inside ``foreachBatch``. Nothing here assumes a table format with MERGE.
"""

from __future__ import annotations

import base64
import gzip
import json
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import row_json, to_flag, to_integer, to_number
from .aggregates import latest_per_key
from .delivery import DEAD, OK, RETRY, Backoff, attempt, paced

# ------------------------------------------------------------ schema conformance


def _fits(source: T.DataType, column: Column, kind: T.DataType) -> Column:
    """The column as ``kind``, null where it does not fit."""
    if source == kind:
        return column
    if isinstance(source, T.StringType):
        if isinstance(kind, (T.ShortType, T.IntegerType, T.LongType)):
            return to_integer(column, kind.simpleString())
        if isinstance(kind, (T.FloatType, T.DoubleType)):
            return to_number(column, kind.simpleString())
        if isinstance(kind, T.BooleanType):
            return F.when(F.lower(column).isin("true", "false"), to_flag(column))
    return column.try_cast(kind)


def conform(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(rows with exactly the schema's columns, rejected rows with ``error``).

    Unknown columns are dropped, missing ones are null. A row is rejected if a value is
    there but does not fit, or a required one is null; the rest of the batch goes on.
    """
    columns, errors = [], []
    for f in schema.fields:
        if f.name not in df.columns:
            columns.append(F.lit(None).cast(f.dataType).alias(f.name))
            if not f.nullable:
                errors.append(F.lit(f"{f.name}: missing"))
            continue
        value = F.col(f"`{f.name}`")
        fitted = _fits(df.schema[f.name].dataType, value, f.dataType)
        columns.append(fitted.alias(f.name))
        errors.append(F.when(value.isNotNull() & fitted.isNull(), F.lit(f"{f.name}: not {f.dataType.simpleString()}")))
        if not f.nullable:
            errors.append(F.when(value.isNull(), F.lit(f"{f.name}: null")))
    error = F.concat_ws("; ", *errors) if errors else F.lit("")
    checked = df.withColumn("__error", error)
    return checked.where("__error = ''").select(*columns), checked.where("__error <> ''").withColumnRenamed("__error", "error")


def dead_letters(rejected: DataFrame, error: str = "error", when: Column | None = None, attributes: Column | None = None) -> DataFrame:
    """Rejected rows as dead-letter records: when, the payload as text and bytes, attributes, the error."""
    payload = row_json(rejected, *[c for c in rejected.columns if c != error])
    attrs = attributes if attributes is not None else F.expr("cast(array() as array<struct<key:string,value:string>>)")
    return rejected.select(
        (when if when is not None else F.current_timestamp()).cast("timestamp").alias("timestamp"),
        payload.alias("payloadString"),
        payload.cast("binary").alias("payloadBytes"),
        attrs.alias("attributes"),
        F.col(error).alias("errorMessage"),
        F.lit(None).cast("string").alias("stacktrace"),
    )


# ------------------------------------------------------------------ table writers


def append(df: DataFrame, path: str, schema: T.StructType | None = None, create: bool = True, partition_by: Sequence[str] = ()) -> None:
    """Append to a Parquet table; with ``schema`` exactly its columns. Without ``create`` the table must exist."""
    if not create:
        df.sparkSession.read.parquet(path).schema  # raises if there is no table
    out = df if schema is None else df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    out.write.mode("append").partitionBy(*partition_by).parquet(path)


def append_conformed(df: DataFrame, path: str, dead_path: str, schema: T.StructType, create: bool = False) -> None:
    """Append what fits ``schema`` (the table must exist unless ``create``); the rest are dead letters."""
    good, bad = conform(df, schema)
    append(good, path, create=create)
    append(dead_letters(bad), dead_path)


def destined(df: DataFrame, destination: Column) -> DataFrame:
    """``df`` with the name of each row's destination table."""
    return df.withColumn("destination", destination)


def route(df: DataFrame, destination: Column, root: str) -> None:
    """Append each row to the table that ``destination`` names, as partitions of ``root``."""
    destined(df, destination).write.mode("append").partitionBy("destination").parquet(root)


def append_json_lines(df: DataFrame, path: str) -> None:
    """Append each row as one JSON object a line; nulls are written."""
    df.select(row_json(df).alias("value")).write.mode("append").text(path)


def existing(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """The Parquet table at ``path``; None if there is none yet."""
    try:
        return (spark.read if schema is None else spark.read.schema(schema)).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def upserted(target: DataFrame | None, changes: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The target after an upsert: of each key the row that is last in ``order``, old or new.

    A change that is older than the stored row changes nothing, so batches may come late or twice.
    """
    return latest_per_key(changes if target is None else target.select(*changes.columns).unionByName(changes), keys, order)


#: Rows of the first batch for each bucket of a new table, and buckets that it has at least and at most.
ROWS_A_BUCKET, BUCKETS = 1_000_000, (64, 16_384)


def _layout(spark: SparkSession, path: str, keys: Sequence[str], buckets: int | None, rows: DataFrame) -> int:
    """The bucket count of the table at ``path``, which is fixed when the table is made and kept beside the table."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    table, place = (jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}{end}") for end in ("", "_layout.json"))
    fs = place.getFileSystem(conf)
    if fs.exists(place):
        kept = json.loads(spark.sparkContext.wholeTextFiles(place.toString()).values().first())
        if buckets not in (None, kept["buckets"]) or list(keys) != kept["keys"]:
            raise ValueError(f"{path} has {kept['buckets']} buckets of {kept['keys']}")
        return kept["buckets"]
    if buckets is None:
        # a table from before layouts were kept has the least number
        buckets = BUCKETS[0] if fs.exists(table) else min(max(rows.count() // ROWS_A_BUCKET, BUCKETS[0]), BUCKETS[1])
    out = fs.create(place, True)
    try:
        out.write(bytearray(json.dumps({"buckets": buckets, "keys": list(keys)}).encode()))
    finally:
        out.close()
    return buckets


def upsert(changes: DataFrame, path: str, keys: Sequence[str], order: Sequence[str], buckets: int | None = None) -> None:
    """Upsert into a Parquet table that is partitioned by a hash of the key.

    Only the buckets that the changes touch are read and, by dynamic partition overwrite,
    written anew. An upsert that is run again gives the same rows. One writer at a time; for
    isolation from readers a table format with MERGE takes its place. The number of buckets is that of the
    table, chosen by the first batch's rows if not given; another number or other keys are an error.
    """
    spark, names = changes.sparkSession, changes.columns
    buckets = _layout(spark, path, keys, buckets, changes)
    numbered = changes.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
    target = existing(spark, path)
    if target is not None:
        touched = [r.bucket for r in numbered.select("bucket").distinct().collect()]  # ``buckets`` numbers at most
        target = target.where(F.col("bucket").isin(touched)).select(*names)
    merged = upserted(target, changes, keys, order).withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
    # Written apart first: the table's own files are then replaced from whole new ones.
    staged = f"{path.rstrip('/')}_staged"
    merged.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(staged)
    fresh = spark.read.schema(merged.schema).parquet(staged).repartition("bucket")
    fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)


def apply_changes(changes: DataFrame, path: str, keys: Sequence[str], order: Sequence[str], buckets: int | None = None) -> None:
    """Change-data capture: upsert of change records with ``mod_type``.

    Deleted keys stay as tombstones, so that an older change that comes later does not bring them back
    (``forget_deleted`` ends that).
    """
    upsert(changes, path, keys, order, buckets)


def forget_deleted(spark: SparkSession, path: str, before: Column, mod_type: str = "mod_type") -> int:
    """Drop the tombstones for which ``before`` holds: those so old that no older change can still come. Only
    buckets that have such are written anew. Gives their number."""
    table = existing(spark, path)
    gone = F.coalesce((F.col(mod_type) == "DELETE") & before, F.lit(False))
    touched = [r.bucket for r in table.where(gone).select("bucket").distinct().collect()]  # buckets at most
    if touched:
        staged = f"{path.rstrip('/')}_staged"
        # a bucket of nothing but tombstones keeps one, as a partition without rows would not be overwritten
        rows = table.where(F.col("bucket").isin(touched)).withColumn("__gone", gone)
        stays = rows.groupBy("bucket").agg(F.min(F.col("__gone").cast("int")).alias("__all")).where("__all = 1").select("bucket", F.lit(True).alias("__empty"))
        first = F.row_number().over(Window.partitionBy("bucket").orderBy(F.col("__gone"), *[F.col(c) for c in table.columns if c != "bucket"]))
        kept = rows.join(F.broadcast(stays), "bucket", "left").withColumn("__n", first).where("not __gone or (__empty and __n = 1)").drop("__gone", "__empty", "__n")
        kept.select(table.columns).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(staged)
        fresh = spark.read.schema(table.schema).parquet(staged).repartition("bucket")
        fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)
    return len(touched)


def read_keyed(spark: SparkSession, path: str, mod_type: str = "mod_type") -> DataFrame:
    """The rows of a table of ``upsert`` or ``apply_changes``, without tombstones."""
    rows = spark.read.parquet(path).drop("bucket")
    return rows.where(F.col(mod_type) != "DELETE").drop(mod_type) if mod_type in rows.columns else rows


# -------------------------------------------------------------------- log posts

def classify(status: Column) -> Column:
    """What a reply means: delivered, worth another try (no reply, 408, 429, 5xx), or never deliverable."""
    return F.when(status.between(200, 299), OK).when(status.isNull() | status.isin(408, 429) | (status >= 500), RETRY).otherwise(DEAD)


def envelope(value: Column, time: Column | None = None) -> Column:
    """A log event as the collector's JSON: the raw payload alone, with its time in epoch seconds if given."""
    fields = [value.cast("string").alias("event")]
    if time is not None:
        fields.insert(0, F.unix_timestamp(time).alias("time"))
    return F.to_json(F.struct(*fields))


POSTED = "events array<string>, body string, bytes int, status int, outcome string"


def numbered_batches(df: DataFrame, value: str, number: Column, order: Column) -> DataFrame:
    """(batch, events): the envelopes of the events of each batch number, in order. Numbers are given so that batches are small."""
    rows = df.select(number.alias("batch"), order.alias("o"), envelope(F.col(value)).alias("event"))
    return rows.groupBy("batch").agg(F.array_sort(F.collect_list(F.struct("o", "event"))).alias("e")).select("batch", F.col("e.event").alias("events"))


def _sent(*attempted) -> tuple[str, int, int | None, str]:
    """(body, bytes, status, outcome) of an attempt that no later one follows."""
    body, size, _, status, outcome = attempt(*attempted)
    return body, size, status, DEAD if outcome == RETRY else outcome


def post_batches(batched: DataFrame, send: Callable[[bytes], int | None], tries: int = 3, compress: bool = True, backoff: Backoff = Backoff()) -> DataFrame:
    """Post the array ``events`` of each row as one (gzip) body; report its bytes, status and outcome.

    ``send`` takes a body and returns an HTTP status, or None without reply; it is made in the
    task. Batches to be tried again are, ``tries`` times in all with the waits of ``backoff``, before they
    count as dead (``delivery.deliver`` queues them instead).
    """
    kept = [f for f in batched.schema.fields if f.name != "events"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [(list(events), *_sent("".join(events).encode(), send, backoff, tries, compress)) for events in frame["events"]]
            out = pd.DataFrame(rows, columns=["events", "body", "bytes", "status", "outcome"])
            yield pd.concat([frame[[f.name for f in kept]].reset_index(drop=True), out], axis=1)

    fields = [*kept, *T.StructType.fromDDL(POSTED).fields]
    return batched.select(*[f.name for f in kept], "events").mapInPandas(run, T.StructType(fields))


def post(df: DataFrame, send: Callable[[bytes], int | None], value: str = "value", batch: int = 100, tries: int = 3, compress: bool = True, backoff: Backoff = Backoff()) -> DataFrame:
    """Post envelopes in batches of at most ``batch`` events, formed where the rows lie (no shuffle), as ``post_batches`` does."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            events = frame["event"].tolist()
            parts = [events[i : i + batch] for i in range(0, len(events), batch)]
            yield pd.DataFrame([(part, *_sent("".join(part).encode(), send, backoff, tries, compress)) for part in parts], columns=["events", "body", "bytes", "status", "outcome"])

    return df.select(envelope(F.col(value)).alias("event")).mapInPandas(run, POSTED)


def undelivered(posted: DataFrame) -> DataFrame:
    """The events of dead batches, one a row, for the dead-letter queue."""
    return posted.where(F.col("outcome") == DEAD).select(F.explode("events").alias("value"), "status")


def unpack(body: str) -> list[dict]:
    """The events of a gzip body, as the collector reads them."""
    text, out, at = gzip.decompress(base64.b64decode(body)).decode(), [], 0
    while at < len(text):
        event, at = json.JSONDecoder().raw_decode(text, at)
        out.append(event)
    return out


def publish_options(uri: str) -> dict[str, str]:
    """The connector's options for writing to ``kafka://hosts/topic``."""
    hosts, _, topic = uri.partition(":")[2].strip("/").partition("/")
    return {"kafka.bootstrap.servers": hosts, "topic": topic}


def publish(df: DataFrame, uri: str, value: str = "value", rate: float | None = None, lanes: int = 1) -> None:
    """Send text rows of a batch to a queue (``kafka://host/topic``) or folder (``text:/path``), ``rate`` a second if given, by ``lanes`` tasks."""
    scheme, _, rest = uri.partition(":")
    if rate is not None:
        df = paced(df.select(value), rate, lanes)
    if scheme == "kafka":
        df.select(F.col(value).cast("string").alias("value")).write.format("kafka").options(**publish_options(uri)).save()
    else:
        df.select(F.to_json(F.struct(F.col(value).cast("string").alias("value")))).write.mode("append").text(rest)

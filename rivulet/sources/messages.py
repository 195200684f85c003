"""Message sources: queues and files as rows of value, publish_time and attributes.

``read_messages`` takes a URI, so that a pipeline doesn't know what it reads:

* ``kafka://host:9092/topic``: the Kafka connector (its jar comes with the cluster),
* ``text:/path`` and ``parquet:/path``: files, one message a line or row.

With ``stream=True`` the same rows come from ``readStream``.
"""

from __future__ import annotations

from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MESSAGE = T.StructType(
    [T.StructField("value", T.BinaryType()), T.StructField("publish_time", T.TimestampType()), T.StructField("attributes", T.MapType(T.StringType(), T.StringType()))]
)
NO_ATTRIBUTES = "cast(map() as map<string,string>)"


def read_messages(spark: SparkSession, uri: str, stream: bool = False, **options: str) -> DataFrame:
    """Messages of a queue or folder as (value binary, publish_time, attributes)."""
    reader = (spark.readStream if stream else spark.read).options(**options)
    scheme, _, rest = uri.partition(":")
    if scheme == "kafka":
        return from_queue(reader.format("kafka").options(**queue_options(uri)).load())
    if scheme == "text":
        lines = reader.text(rest).select("value", "_metadata.file_modification_time")
        return lines.select(F.col("value").cast("binary").alias("value"), F.col("file_modification_time").alias("publish_time"), F.expr(NO_ATTRIBUTES).alias("attributes"))
    if scheme == "parquet":
        return reader.schema(MESSAGE).parquet(rest)
    raise ValueError(f"no reader for {uri!r}")


def queue_options(uri: str) -> dict[str, str]:
    """The connector's options for ``kafka://hosts/topic``; ``?group=g`` reads as a named subscription."""
    parts = urlparse(uri)
    group = dict(p.split("=", 1) for p in parts.query.split("&") if "=" in p).get("group")
    out = {"kafka.bootstrap.servers": parts.netloc, "subscribe": parts.path.strip("/"), "includeHeaders": "true"}
    return out | ({"kafka.group.id": group} if group else {})


def from_queue(raw: DataFrame) -> DataFrame:
    """Records of the queue's connector (value, timestamp, headers) as messages; of headers with one name the last counts."""
    headers = F.expr("aggregate(coalesce(headers, array()), cast(map() as map<string,string>), (m, h) -> map_concat(map_filter(m, (k, v) -> k <> h.key), map(h.key, cast(h.value as string))))")
    return raw.select("value", F.col("timestamp").cast("timestamp").alias("publish_time"), headers.alias("attributes"))


def read_text(spark: SparkSession, uri: str, stream: bool = False, **options: str) -> DataFrame:
    """Messages as UTF-8 text in ``value``."""
    return read_messages(spark, uri, stream, **options).withColumn("value", F.make_valid_utf8(F.col("value").cast("string")))


def as_messages(df: DataFrame, payload, publish_time=None) -> DataFrame:
    """Any DataFrame as messages: tests and replays feed pipelines with it."""
    when = publish_time if publish_time is not None else F.current_timestamp()
    return df.select(payload.cast("string").cast("binary").alias("value"), when.cast("timestamp").alias("publish_time"), F.expr(NO_ATTRIBUTES).alias("attributes"))


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A CSV file with header, every column text; the literal NaN of an empty cell is null."""
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    raw = spark.read.option("header", True).schema(text).csv(path)
    return raw.select(*[F.when(F.col(c) != "NaN", F.col(c)).alias(c) for c in raw.columns])


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(rows, bad lines) of a JSON-lines file; a bad line never fails the read."""
    return parse_json_lines(spark.read.text(path), schema)


def parse_json_lines(lines: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(rows, bad lines) of lines of JSON in ``value``; blank lines are neither."""
    kept = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    lines = lines.where(F.trim("value") != "")
    parsed = lines.select("value", F.from_json("value", kept, {"columnNameOfCorruptRecord": "_bad"}).alias("j"))
    return parsed.where("j._bad is null").select("j.*").drop("_bad"), parsed.where("j._bad is not null").select(F.col("value").alias("line"))


def read_dimension(spark: SparkSession, path: str, key: str, version: str | None = None) -> DataFrame:
    """A keyed lookup table; with ``version`` the row of largest version of each key."""
    rows = spark.read.parquet(path)
    if version is None:
        return rows
    rest = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.max_by(F.struct(*rest), F.col(version)).alias("r")).select(key, "r.*")

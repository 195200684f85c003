"""Customer data: transactions left-joined with coupon redemptions per key and window."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.schemas import COUPON_REDEMPTION, TRANSACTION, UNIFIED, ParseOutput
from ..operators.joins import windowed_left_join
from ..operators.jsonio import MOST_BYTES, parse_objects
from ..streaming.panes import EARLY, ON_TIME, early_left_join

KEYS = ("transaction_id", "household_key")


@dataclass(frozen=True)
class Config:
    window: str = "60 seconds"
    lateness: str = "0 seconds"


#: The literal NaN as a value: from there on, quotes are balanced, so it stands outside of texts.
NAN = r'(?<=[:\[,\s])-?NaN(?=\s*[,}\]](?:[^"\\]++|\\.|"(?:[^"\\]++|\\.)*+")*+\z)'


def parse(messages: DataFrame, schema: T.StructType) -> ParseOutput:
    """JSON objects as rows of text columns with their publish time, the literal NaN being null; the errors
    are what is no object and what has no transaction id, which the sink requires."""
    text = F.col("value").cast("string")
    # Each literal is looked for to the message's end, so only messages that have one, and are no larger than the limit, are searched.
    mended = F.when((F.octet_length(text) < MOST_BYTES) & F.contains(text, F.lit("NaN")), F.regexp_replace(text, NAN, "null")).otherwise(text)
    tagged = parse_objects(messages.select(text.alias("input_data"), mended.alias("value"), F.col("publish_time").cast("timestamp").alias("publish_time")))
    parsed = tagged.withColumn("j", F.explode(F.array(F.from_json("value", schema))))
    error = F.coalesce("error_tag", F.when(F.col("j.transaction_id").isNull(), F.lit("missing: transaction_id")))
    checked = parsed.withColumn("error_message", error)
    errors = checked.where("error_message is not null").select("input_data", "error_message", F.col("publish_time").alias("timestamp"))
    return ParseOutput(checked.where("error_message is null").select("j.*", "publish_time"), errors)


def unify(transactions: DataFrame, coupons: DataFrame, cfg: Config = Config(), time: str = "publish_time") -> DataFrame:
    """Unified rows of parsed transactions and coupons: all combinations of a key and window,
    coupon null where a transaction has none.

    The result is that of the whole window, on a stream when its window has closed; ``unify_early`` gives
    the same rows as they become known.
    """
    joined = windowed_left_join(*_sides(transactions, coupons, time), KEYS, time, time, cfg.window, cfg.lateness)
    return joined.select(*UNIFIED.names)


def _sides(transactions: DataFrame, coupons: DataFrame, time: str) -> tuple[DataFrame, DataFrame]:
    return transactions.select(*KEYS, "product_id", F.col("coupon_disc").alias("coupon_discount"), time), coupons.select(*KEYS, "coupon_upc", time)


def unify_early(transactions: DataFrame, coupons: DataFrame, cfg: Config = Config(), time: str = "publish_time") -> DataFrame:
    """The rows of ``unify`` of two streams in early, discarding panes, with their pane; rows whose window had closed come out as late ones."""
    joined = early_left_join(*_sides(transactions, coupons, time), KEYS, time, time, cfg.window, cfg.lateness)
    return joined.select(*UNIFIED.names, "pane")


def write_panes(rows: DataFrame, table: str, late: str, number: int) -> None:
    """Write a micro-batch of ``unify_early`` into its own folders of the table and of the late rows; one that is run again replaces itself."""
    kept = rows.persist()
    try:
        known = F.col("pane").isin(EARLY, ON_TIME)
        kept.where(known).drop("pane").write.mode("overwrite").parquet(f"{table}/batch_id={number}")
        kept.where(~known).write.mode("overwrite").parquet(f"{late}/batch_id={number}")
    finally:
        kept.unpersist()


def build(transactions: DataFrame, coupons: DataFrame, cfg: Config = Config()) -> DataFrame:
    """From messages to unified rows, batch or stream."""
    return unify(parse(transactions, TRANSACTION).good, parse(coupons, COUPON_REDEMPTION).good, cfg)

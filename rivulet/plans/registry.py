"""Every query of the library on the driver's tables, and its SQL.

Times leave as text in both, so that engines with and without zones compare equal.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import prediction_text, row_json, utf8
from ..functions.schemas import COUPON_REDEMPTION, MAINTENANCE, TAXI_EVENT
from ..operators import aggregates, delivery, inference, joins, jsonio, sinks, versions, windows
from ..sources import synthetic
from ..sources.messages import as_messages, from_queue, parse_json_lines, read_dimension
from ..streaming import panes
from . import cdp, clickstream, etl, iot, predictions

MICROS = "yyyy-MM-dd HH:mm:ss.SSSSSS"
AS_OF = "2024-06-30"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _time(name: str):
    return F.date_format(name, MICROS).alias(name)


# ----------------------------------------------------------------------- vehicles


def _vehicle_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table in the shape of vehicle events."""
    return _table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("vehicle_id"),
        F.col("ts").alias("event_time"),
        F.get_json_object("props", "$.k").try_cast("int").alias("temperature"),
        F.col("value").alias("vibration"),
        F.col("event_id").alias("mileage"),
    )


def _metrics(spark: SparkSession, sf_dir: str, size: str) -> DataFrame:
    return aggregates.vehicle_metrics(_vehicle_events(spark, sf_dir), size=size)


def iot_window_metrics(spark: SparkSession, sf_dir: str, size: str = "60 seconds") -> DataFrame:
    rows = _metrics(spark, sf_dir, size)
    return rows.select("vehicle_id", F.date_format("window.start", MICROS).alias("window_start"), _time("max_timestamp"), "max_temperature", "max_vibration", "avg_mileage")


def iot_window_metrics_1d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iot_window_metrics(spark, sf_dir, "1 day")


def _dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in the shape of maintenance records."""
    return _table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("vehicle_id"),
        F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), F.col("c_nationkey") * 7), "yyyy-MM-dd").alias("last_service_date"),
        F.col("c_mktsegment").alias("maintenance_type"),
        F.col("c_name").alias("model"),
    )


def iot_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iot.enriched(_metrics(spark, sf_dir, "1 day"), _dimension(spark, sf_dir)).withColumn("latest_timestamp", F.date_format("latest_timestamp", MICROS))


def maintenance_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = iot.enriched(_metrics(spark, sf_dir, "1 day"), _dimension(spark, sf_dir))
    flag = inference.needs_maintenance(as_of=AS_OF, hot=75, shaking=250, days=120).cast("bigint")
    return iot.to_sink(rows.withColumn("needs_maintenance", flag)).withColumn("latest_timestamp", F.date_format("latest_timestamp", MICROS))


def enrich_miss(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "lang")
    labels = _table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    return joins.enrich(docs, labels, "doc_id")


def frame_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days since the first service date of all vehicles, as the model's feature."""
    dimension = _dimension(spark, sf_dir)
    return dimension.select("vehicle_id", aggregates.offset_days(F.col("last_service_date"), aggregates.least(dimension, "last_service_date")).alias("service_day"))


def _vehicle_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as vehicle messages: some cut off, some without vehicle, some with an unreadable time."""
    n = F.col("event_id")
    text = F.format_string(
        '{"vehicle_id":%s,"timestamp":"%s","temperature":"%d","rpm":1,"vibration":%d.5,"fuel_level":null,"mileage":%d}',
        F.when(n % 71 == 0, "null").otherwise(F.format_string('"v%d"', F.col("user_id"))),
        F.when(n % 73 == 0, "yesterday").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        n % 90,
        n % 3,
        n,
    )
    return as_messages(_table(spark, sf_dir, "events").select(F.when(n % 79 == 0, F.concat(F.lit("\n{"), n.cast("string"))).otherwise(text).alias("v"), "ts"), F.col("v"), F.col("ts"))


def iot_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = iot.parse(_vehicle_messages(spark, sf_dir)).good
    return good.select("vehicle_id", "temperature", "vibration", "fuel_level", "mileage", _time("event_time"))


def iot_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iot.parse(_vehicle_messages(spark, sf_dir)).errors.withColumn("timestamp", F.date_format("timestamp", MICROS))


# ------------------------------------------------------------------ customer data


def _cdp_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    events = _table(spark, sf_dir, "events")
    key = [F.col("user_id").cast("string").alias("transaction_id"), (F.col("user_id") % 7).cast("string").alias("household_key")]
    left = events.where("event_type = 'purchase'").select(*key, F.col("event_id").cast("string").alias("product_id"), F.get_json_object("props", "$.k").alias("coupon_disc"), F.col("ts").alias("publish_time"))
    right = events.where("event_type = 'click'").select(*key, F.col("event_id").cast("string").alias("coupon_upc"), F.col("ts").alias("publish_time"))
    return left, right


def _coupon_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as coupon messages with line ends, literals NaN inside and outside of texts, and bad ones."""
    n = F.col("event_id")
    text = F.format_string('{"household_key": %s, "transaction_id": %s, "coupon_upc": "say: NaN, \\"%d\\", NaN", "day": NaN}\n', F.when(n % 3 == 0, "NaN").otherwise('"h"'), F.when(n % 29 == 0, "null").otherwise(F.col("user_id").cast("string")), n)
    value = F.when(n % 31 == 0, F.concat(F.lit("NaN "), n.cast("string"))).when(n % 37 == 0, F.concat(F.format_string('{"transaction_id": %d}', n), F.lit(" }"))).otherwise(text)
    return as_messages(_table(spark, sf_dir, "events").select(value.alias("v"), "ts"), F.col("v"), F.col("ts"))


_COUPON_SQL = """m AS (
  SELECT event_id, user_id, CASE WHEN event_id % 31 = 0 THEN 'NaN ' || event_id WHEN event_id % 37 = 0 THEN '{"transaction_id": ' || event_id || '} }' ELSE
    '{"household_key": ' || CASE WHEN event_id % 3 = 0 THEN 'NaN' ELSE '"h"' END || ', "transaction_id": ' || CASE WHEN event_id % 29 = 0 THEN 'null' ELSE CAST(user_id AS VARCHAR) END
    || ', "coupon_upc": "say: NaN, \\"' || event_id || '\\", NaN", "day": NaN}' || chr(10) END AS value FROM events)"""


def coupon_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdp.parse(_coupon_messages(spark, sf_dir), COUPON_REDEMPTION).good.select("transaction_id", "household_key", "coupon_upc", "day")


def coupon_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdp.parse(_coupon_messages(spark, sf_dir), COUPON_REDEMPTION).errors.select("input_data", "error_message")


def cdp_unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdp.unify(*_cdp_sides(spark, sf_dir), cdp.Config(window="1 day"))


def cdp_panes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The unified rows with the early pane that each comes out in, if events come in five micro-batches by their number."""
    left, right = (df.withColumn("pane", F.col(n).cast("bigint") % 5) for df, n in zip(_cdp_sides(spark, sf_dir), ("product_id", "coupon_upc"), strict=True))
    found = panes.paned_pairs(left, right, cdp.KEYS, "publish_time", "publish_time", "pane", "1 day")
    return found.select("transaction_id", "household_key", "product_id", "coupon_upc", "pane")


def pane_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each pane of a day's events of a type holds, discarding and accumulating; seven micro-batches by event number."""
    rows = _table(spark, sf_dir, "events").select(F.window("ts", "1 day")["start"].alias("day"), "event_type", (F.col("event_id") % 7).alias("pane"), "event_id")
    each = panes.discarded(rows, ["day", "event_type"], "pane", F.count(F.lit(1)).alias("n"), F.max("event_id").alias("last"))
    so_far = panes.accumulated(each, ["day", "event_type"], "pane", n=F.sum, last=F.max)
    both = each.join(so_far.withColumnsRenamed({"n": "n_so_far", "last": "last_so_far"}), ["day", "event_type", "pane"])
    return both.select(F.date_format("day", MICROS).alias("day"), "event_type", "pane", "n", "last", "n_so_far", "last_so_far")


def as_of_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each purchase with its user's last view at or before it."""
    events = _table(spark, sf_dir, "events")
    views = events.where("event_type = 'view'").select("user_id", "ts", F.col("event_id").alias("view_id"), F.col("value").alias("view_value"))
    found = versions.as_of(events.where("event_type = 'purchase'").select("event_id", "user_id", "ts"), views, "user_id", "ts", bucket="1 day")
    return found.select("event_id", "user_id", _time("ts"), "view_id", "view_value", F.date_format("version_time", MICROS).alias("viewed"))


def cogroup_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    left, right = (df.withColumn("day", F.date_format(F.window("publish_time", "1 day")["start"], "yyyy-MM-dd")) for df in _cdp_sides(spark, sf_dir))
    out = joins.cogroup(left, right, ["transaction_id", "day"], F.col("product_id"), F.col("coupon_upc"), ("products", "coupons"))
    return out.select("transaction_id", "day", F.array_join("products", ",").alias("products"), F.array_join("coupons", ",").alias("coupons"))


def orders_left_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, lines = _table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return joins.enrich(orders, lines, "o_orderkey", "l_orderkey").select("o_orderkey", "o_orderstatus", "l_linenumber", "l_quantity")


def with_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose properties have a key, by the predicate on nulls."""
    events = _table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"))
    return joins.not_null(events, "k")


IDS = [1, 5, 33, 64, 97, 130, 256]


def semi_filter_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = joins.in_ids(_table(spark, sf_dir, "lineitem"), "l_orderkey", IDS)
    orders = _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"))
    return joins.in_table(lines, orders, "l_orderkey").select("l_orderkey", "l_linenumber", "l_partkey")


# -------------------------------------------------------------------- clickstream


def click_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = windows.sessions(_table(spark, sf_dir, "events"), "user_id", "ts", "30 minutes")
    return out.select("user_id", _time("session_start"), _time("session_end"), "events")


def click_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks with their user's customer row, of which some have none."""
    clicks = _table(spark, sf_dir, "events").where("event_type = 'click'").select("event_id", "user_id")
    people = _table(spark, sf_dir, "customer").where("c_custkey % 3 <> 0").select("c_custkey", "c_mktsegment")
    return clickstream.enriched(clicks, people, "user_id", "c_custkey")


def sliding_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = _table(spark, sf_dir, "events").groupBy(windows.sliding("ts", "2 days", "1 day").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    return grouped.select(F.date_format("w.start", MICROS).alias("window_start"), "event_type", "n")


def _raw_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event properties as messages; some cut off, some no object, some too big (200 bytes)."""
    n = F.col("event_id")
    text = (
        F.when(n % 97 == 0, F.concat(F.lit("{bad "), n.cast("string")))
        .when(n % 79 == 0, F.concat(F.lit("\n\t"), F.col("props"), F.lit("\r\n")))
        .when(n % 73 == 0, F.concat(F.col("props"), F.lit(" {}")))
        .when(n % 89 == 0, F.concat(F.lit('{"k": 1, "pad": "'), F.repeat(F.lit("x"), 200), F.lit('"}')))
        .when(n % 83 == 0, F.lit("[1, 2]"))
        .otherwise(F.col("props"))
    )
    return jsonio.parse_objects(_table(spark, sf_dir, "events").select("event_id", text.alias("value")), most=200)


_RAW_SQL = r"""raw AS (
  SELECT event_id, CASE WHEN event_id % 97 = 0 THEN '{bad ' || event_id WHEN event_id % 79 = 0 THEN chr(10) || chr(9) || props || chr(13) || chr(10) WHEN event_id % 73 = 0 THEN props || ' {}' WHEN event_id % 89 = 0 THEN '{"k": 1, "pad": "' || repeat('x', 200) || '"}'
    WHEN event_id % 83 = 0 THEN '[1, 2]' ELSE props END AS value FROM events),
tagged AS (
  SELECT *, CASE WHEN strlen(value) >= 200 THEN 'TooBigRow' WHEN NOT json_valid(value) OR NOT regexp_matches(value, '^[ \t\r\n]*\{') THEN 'JsonParseError' END AS error_tag FROM raw)"""


def json_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = jsonio.split_tagged(_raw_clicks(spark, sf_dir))
    return good.select("event_id", F.from_json("value", "k bigint").getField("k").alias("k"))


def json_dead_letter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jsonio.split_tagged(_raw_clicks(spark, sf_dir))[1]


def job_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jsonio.counters(_raw_clicks(spark, sf_dir), F.col("event_id") % 50 == 0)


def oversize_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of 4 KiB or more, with their size in bytes."""
    tagged = jsonio.parse_objects(_table(spark, sf_dir, "documents").select("doc_id", "text"), "text", most=4096)
    return tagged.where(F.col("error_tag") == jsonio.TOO_BIG).select("doc_id", F.octet_length("text").cast("bigint").alias("bytes"))


def _wide_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as text rows for a table of (k int, kind string NOT NULL, value double), some of which don't fit."""
    n = F.col("event_id")
    return _table(spark, sf_dir, "events").select(
        n.cast("string").alias("id"),
        F.when(n % 11 == 0, "many").when(n % 13 == 0, "3.5").otherwise(F.get_json_object("props", "$.k")).alias("k"),
        F.when(n % 17 != 0, F.col("event_type")).alias("kind"),
        F.lit("ignored").alias("unknown"),
    )


_WIDE = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("k", T.IntegerType()), T.StructField("kind", T.StringType(), False), T.StructField("note", T.StringType())])


def conform_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.conform(_wide_rows(spark, sf_dir), _WIDE)[0]


def deadletter_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = sinks.conform(_wide_rows(spark, sf_dir), _WIDE)[1]
    attributes = F.array(F.struct(F.lit("source").alias("key"), F.lit("events").alias("value")))
    letters = sinks.dead_letters(rejected, when=F.lit("2024-01-01 00:00:00").cast("timestamp"), attributes=attributes)
    return letters.select(F.date_format("timestamp", MICROS).alias("timestamp"), "payloadString", F.hex("payloadBytes").alias("payloadBytes"), F.to_json("attributes").alias("attributes"), "errorMessage")


def route_destinations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many events each destination table gets, by their type."""
    routed = sinks.destined(_table(spark, sf_dir, "events").select("event_id", "event_type"), F.when(F.col("event_type").isin("click", "view"), F.concat(F.lit("web_"), "event_type")).otherwise("other"))
    return routed.groupBy("destination").agg(F.count(F.lit(1)).alias("n"), F.max("event_id").alias("last"))


# ------------------------------------------------------------------------- taxis


def _taxi_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as taxi messages: numbers quoted, unknown fields, and some bad ones."""
    n = F.col("event_id")
    text = F.format_string(
        '{"extra":{"a":1},"ride_id":"r%d","point_idx":"%s","latitude":%d.25,"longitude":"-%d.5","timestamp":"2024-01-%02dT00:00:00Z","meter_reading":%d,"meter_increment":"0.5","ride_status":"%s","passenger_count":%s}',
        F.col("user_id"),
        F.when(n % 101 == 0, "abc").when(n % 107 == 0, "3000000000").otherwise(n.cast("string")),
        n % 90,
        n % 180,
        n % 28 + 1,
        n % 60,
        F.col("event_type"),
        F.when(n % 103 == 0, "null").otherwise((n % 5).cast("string")),
    )
    text = F.when(n % 97 == 0, F.concat(F.lit("cut off {"), n.cast("string"))).otherwise(text)
    return _table(spark, sf_dir, "events").select(text.alias("value"), F.col("ts").alias("publish_time"))


_TAXI_SQL = """m AS (
  SELECT event_id, ts, CASE WHEN event_id % 97 = 0 THEN 'cut off {' || event_id ELSE
   printf('{"extra":{"a":1},"ride_id":"r%d","point_idx":"%s","latitude":%d.25,"longitude":"-%d.5","timestamp":"2024-01-%02dT00:00:00Z","meter_reading":%d,"meter_increment":"0.5","ride_status":"%s","passenger_count":%s}',
    user_id, CASE WHEN event_id % 101 = 0 THEN 'abc' WHEN event_id % 107 = 0 THEN '3000000000' ELSE CAST(event_id AS VARCHAR) END, event_id % 90, event_id % 180, event_id % 28 + 1, event_id % 60, event_type,
    CASE WHEN event_id % 103 = 0 THEN 'null' ELSE CAST(event_id % 5 AS VARCHAR) END) END AS value FROM events),
o AS (SELECT *, CASE WHEN json_valid(value) THEN value ELSE '{}' END AS j, json_valid(value) AS ok FROM m),
t AS (SELECT *, j->>'$.ride_id' AS ride_id, TRY_CAST(j->>'$.point_idx' AS INTEGER) AS point_idx, TRY_CAST(j->>'$.latitude' AS DOUBLE) AS latitude, TRY_CAST(j->>'$.longitude' AS DOUBLE) AS longitude,
  j->>'$.timestamp' AS "timestamp", TRY_CAST(j->>'$.meter_reading' AS DOUBLE) AS meter_reading, TRY_CAST(j->>'$.meter_increment' AS DOUBLE) AS meter_increment, j->>'$.ride_status' AS ride_status, TRY_CAST(j->>'$.passenger_count' AS INTEGER) AS passenger_count FROM o),
e AS (SELECT *, CASE WHEN NOT ok THEN 'not a JSON object' WHEN point_idx IS NULL AND passenger_count IS NULL THEN 'missing or malformed: point_idx,passenger_count'
  WHEN point_idx IS NULL THEN 'missing or malformed: point_idx' WHEN passenger_count IS NULL THEN 'missing or malformed: passenger_count' END AS err FROM t)"""


def taxi_sanitize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return etl.build(_taxi_messages(spark, sf_dir)).good


def taxi_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return etl.build(_taxi_messages(spark, sf_dir)).errors.withColumn("timestamp", F.date_format("timestamp", MICROS))


def taxi_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The taxi table after the upsert of all events, by key the last time."""
    rows = etl.to_table(etl.build(_taxi_messages(spark, sf_dir)).good)
    return sinks.upserted(None, rows, ["ride_id", "passenger_count"], ["timestamp", "point_idx"]).withColumn("timestamp", F.date_format("timestamp", MICROS))


def sanitized_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sanitised messages as JSON text; what is no object passes unchanged."""
    rows = _taxi_messages(spark, sf_dir)
    return rows.select(_time("publish_time"), jsonio.sanitize_json(F.col("value"), TAXI_EVENT).alias("value"))


NESTED = "user struct<id: bigint, known: boolean>, tags array<string>, counts array<int>, parts array<struct<w: double, on: boolean>>"


def sanitize_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages with arrays, records in arrays and spellings of flags, sanitised to a nested schema."""
    n = F.col("event_id")
    text = F.format_string(
        '{"user":{"id":"%d","known":"%s","drop":1},"tags":["%s","x"],"counts":["%d",2,"many"],"parts":[{"w":"%d.5","on":true,"drop":[]},{"w":1,"on":"%s"}],"drop":null}',
        F.col("user_id"), F.when(n % 2 == 0, "TRUE").otherwise("no"), F.col("event_type"), n, n % 9, F.when(n % 3 == 0, "True").otherwise("1"),
    )
    row = _table(spark, sf_dir, "events").select("event_id", jsonio.sanitize(text, T.StructType.fromDDL(NESTED)).alias("r"))
    return row.select("event_id", "r.user.id", "r.user.known", F.array_join("r.tags", ",").alias("tags"), F.col("r.counts")[0].alias("first"), F.size("r.counts").cast("bigint").alias("counted"), F.col("r.counts")[2].isNull().alias("odd_is_null"), F.col("r.parts")[0]["w"].alias("w"), F.col("r.parts")[0]["on"].alias("on_a"), F.col("r.parts")[1]["on"].alias("on_b"))


# ---------------------------------------------------------------- keyed tables


def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events").select("user_id", "event_type", "ts", "event_id", "value")
    old, new = events.where("ts < timestamp_ntz '2024-01-15 00:00:00'"), events.where("ts >= timestamp_ntz '2024-01-15 00:00:00'")
    keys, order = ["user_id", "event_type"], ["ts", "event_id"]
    return sinks.upserted(sinks.upserted(None, old, keys, order), new, keys, order).withColumn("ts", F.date_format("ts", MICROS))


def cdc_replica(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("event_type") == "error", "DELETE").when(F.col("event_type") == "signup", "INSERT").otherwise("UPDATE")
    changes = _table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "value", kind.alias("mod_type"))
    return aggregates.replica(changes, ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "value")


def cdc_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The replica after two batches of which the second holds the older half of the changes."""
    kind = F.when(F.col("event_type") == "error", "DELETE").otherwise("UPDATE")
    changes = _table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "value", kind.alias("mod_type"))
    late = changes.where("event_id % 2 = 0")
    keys, order = ["user_id"], ["ts", "event_id"]
    state = sinks.upserted(sinks.upserted(None, changes.where("event_id % 2 = 1"), keys, order), late, keys, order)
    return state.where("mod_type <> 'DELETE'").select("user_id", "event_id", "value")


def change_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change records with old and new values as rows to apply."""
    n, old, new = F.col("event_id"), F.format_string('{"amount":%d,"kind":"%s"}', F.col("event_id") % 5, F.col("event_type")), F.format_string('{"amount":%d,"kind":"click"}', F.col("event_id") % 4)
    mod = F.when(n % 3 == 0, "DELETE").when(n % 3 == 1, "UPDATE").otherwise("INSERT")
    records = _table(spark, sf_dir, "events").select(
        mod.alias("mod_type"), F.col("ts").alias("commit_time"), F.format_string('{"id":%d}', n).alias("keys"), F.when(mod != "INSERT", old).alias("old_values"), F.when(mod != "DELETE", new).alias("new_values")
    )
    rows = etl.change_rows(records, T.StructType.fromDDL("id bigint, amount int, kind string"))
    return rows.select("id", "amount", "kind", "mod_type", F.array_join("changed", ",").alias("changed"))


def dimension_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each customer the order of largest key, as the newest version of a keyed table."""
    return read_dimension(spark, f"{sf_dir}/orders.parquet", "o_custkey", "o_orderkey").select("o_custkey", "o_orderkey", "o_orderstatus")


def cell_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "value")
    return aggregates.versions(events, ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "value", "version")


# --------------------------------------------------------------------- inference


def format_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    talk = _table(spark, sf_dir, "conversations")
    return talk.select("conv_id", "turn", prediction_text(F.col("text"), F.when(F.col("turn") % 2 == 0, F.col("role"))).alias("value"))


def local_inference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts through a local handler; the model itself is one that SQL can state."""
    return inference.run_inference(_table(spark, sf_dir, "conversations"), inference.TemplateHandler(StatedModel, "stated"), "text")


def endpoint_inference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON instances through an endpoint's handler."""
    talk = _table(spark, sf_dir, "conversations")
    return inference.run_inference(talk.select(row_json(talk, "conv_id", "turn").alias("value")), inference.EndpointHandler(StatedModel, "endpoint", json_instances=True))


class StatedModel:
    """Stands where a model does in these queries: how many bytes a text has, which number an instance has."""

    def generate(self, text: str, max_length: int) -> str:
        return f"{len(text.encode())} bytes: {text}"

    def predict(self, instances: list[dict]) -> list[int]:
        return [1000 * i["conv_id"] + i["turn"] for i in instances]


def predicted_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event messages enriched by their user's row, through a model, as answer messages."""
    events = _table(spark, sf_dir, "events").where("event_type = 'purchase'")
    messages = as_messages(events.select(F.format_string('{"user_id":%d,"n":%d}', "user_id", "event_id").alias("v"), "ts"), F.col("v"), F.col("ts"))
    people = _table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), "c_mktsegment")
    return predictions.build(messages, inference.TemplateHandler(StatedModel, "stated"), features=people, key="user_id")


def queue_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records in the shape of the queue's connector as messages: UTF-8 text and attributes."""
    header = lambda k, v: F.struct(F.lit(k).alias("key"), v.cast("string").cast("binary").alias("value"))
    headers = F.when(F.col("conv_id") % 2 == 0, F.array(header("role", F.lit("old")), header("role", F.col("role")), header("turn", F.col("turn"))))
    raw = _table(spark, sf_dir, "conversations").select(F.col("text").cast("binary").alias("value"), F.lit("2024-01-01 00:00:00").cast("timestamp").alias("timestamp"), headers.alias("headers"), "conv_id", "turn")
    kept = from_queue(raw.withColumn("value", F.concat(F.format_string("%d/%d ", "conv_id", "turn").cast("binary"), F.coalesce("value", F.lit(b"")))))
    return kept.select(utf8(F.col("value"), strict=True).alias("text"), F.col("attributes")["role"].alias("role"), F.col("attributes")["turn"].alias("turn"), F.size("attributes").cast("bigint").alias("n"))


def _spread_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("event_id") % 300).cast("int"))
    base = _table(spark, sf_dir, "events").select(F.col("event_id").cast("string").alias("vehicle_id"), (50 + F.col("event_id") % 50).cast("int").alias("max_temperature"), ((F.col("event_id") % 100) / 100).alias("max_vibration"), F.date_format(day, "yyyy-MM-dd").alias("last_service_date"))
    return base.withColumn("needs_maintenance", inference.needs_maintenance(as_of=AS_OF))


def trained_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that the model did not learn from, with its features, the rule, and whether it says what the rule says
    wherever the rule is clear: all signs far off, or one of them far over the line."""
    model, held = inference.MaintenanceModel.train(_spread_events(spark, sf_dir), held=F.col("vehicle_id").cast("bigint") % 5 == 0)
    scored = model.predict(held.withColumn("rule", F.col("needs_maintenance").cast("bigint")))
    old = F.datediff(F.lit(AS_OF).cast("date"), F.col("last_service_date").cast("date"))
    calm = (F.col("max_temperature") < 55) & (F.col("max_vibration") < 0.1) & (old < 60)
    clear = (F.col("rule") == 0) & calm | (F.col("rule") == 1) & (F.col("max_temperature") > 90) & (F.col("max_vibration") > 0.9)
    said = F.when(clear, F.col("needs_maintenance").cast("bigint") == F.col("rule"))
    return scored.select("vehicle_id", F.col("max_temperature").cast("int").alias("max_temperature"), "max_vibration", "last_service_date", "rule", said.alias("agrees_where_clear"))


def inference_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts through a model that fails on some of them: the others of their batch are answered."""
    talk = _table(spark, sf_dir, "conversations").select(F.format_string("%d/%d", "conv_id", "turn").alias("value"))
    return inference.tagged_inference(talk, inference.TemplateHandler(PickyModel, "picky"))


class PickyModel:
    """A model that refuses every text that ends in 3."""

    def generate(self, text: str, max_length: int) -> str:
        if text.endswith("3"):
            raise ValueError(f"no answer to {text}")
        return text[::-1]


# -------------------------------------------------------------------- logs, inputs


def log_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events posted as logs, in batches of a hundred numbers, to a collector that refuses large bodies."""
    batched = sinks.numbered_batches(_table(spark, sf_dir, "events"), "props", F.floor(F.col("event_id") / 100).cast("bigint"), F.col("event_id"))
    posted = sinks.post_batches(batched, lambda body: 200 if len(body) <= 2790 else 413, compress=False)
    return posted.select("batch", F.size("events").cast("bigint").alias("events"), F.col("bytes").cast("bigint").alias("bytes"), "status", "outcome")


def undelivered_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events of the batches that the collector refused."""
    batched = sinks.numbered_batches(_table(spark, sf_dir, "events"), "event_type", F.floor(F.col("event_id") / 100).cast("bigint"), F.col("event_id"))
    posted = sinks.post_batches(batched, lambda body: 404 if b"signup" in body[:40] else 200, compress=False)
    return sinks.undelivered(posted).groupBy("value", "status").agg(F.count(F.lit(1)).alias("n"))


def json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as the lines of a JSON-lines file of maintenance records, some of them broken, read back from the text."""
    made = _dimension(spark, sf_dir).select("vehicle_id", "last_service_date", "maintenance_type", F.lit(None).cast("string").alias("make"), "model")
    line = F.when(F.col("vehicle_id").cast("bigint") % 10 == 7, F.concat(F.lit("{"), F.col("vehicle_id"))).otherwise(row_json(made))
    good, bad = parse_json_lines(made.select(line.alias("value")), MAINTENANCE)
    return good.select("vehicle_id", "last_service_date", "maintenance_type", "model", F.lit(None).cast("string").alias("bad")).unionByName(bad.select(F.col("line").alias("bad")), allowMissingColumns=True)


def _delivery_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report of events in batches of a hundred numbers: delivered, to be tried again, dead, and waiting."""
    events = _table(spark, sf_dir, "events").select(F.floor(F.col("event_id") / 100).alias("b"), F.struct(F.col("event_id").cast("string").alias("value"), (F.col("event_id") % 3).cast("int").alias("failures")).alias("e"))
    outcome = F.element_at(F.array(*[F.lit(x) for x in (delivery.OK, delivery.RETRY, delivery.DEAD, delivery.WAIT)]), (F.col("b") % 4 + 1).cast("int"))
    due = F.when(outcome == delivery.WAIT, F.lit("2024-01-01 00:05:00").cast("timestamp"))
    status = F.when(outcome == delivery.OK, 200).when(outcome == delivery.DEAD, 400).when(outcome == delivery.RETRY, 503)
    return events.groupBy("b").agg(F.collect_list("e").alias("events")).select("events", due.alias("due"), status.alias("status"), outcome.alias("outcome"), F.lit("2024-01-01 00:00:00").cast("timestamp").alias("written"))


def delivery_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The retry queue that a report leaves, waits doubling from a minute."""
    left = delivery.left_over(_delivery_report(spark, sf_dir), delivery.Backoff(jitter=0.0, most=3600.0), attempts=3)
    return left.select("value", "failures", _time("due"))


def delivery_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dead letters of the same report."""
    return delivery.undeliverable(_delivery_report(spark, sf_dir), attempts=3)


def log_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event as the collector's envelope."""
    return _table(spark, sf_dir, "events").select("event_id", sinks.envelope(F.col("event_type"), F.col("ts").cast("timestamp")).alias("event"))


def delivery_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("event_id") % 7 == 0, F.lit(None)).otherwise(F.element_at(F.array(*[F.lit(s) for s in (200, 201, 400, 404, 408, 429, 500, 503)]), (F.col("event_id") % 8 + 1).cast("int")))
    return _table(spark, sf_dir, "events").select(sinks.classify(status).alias("outcome")).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


def synthetic_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reproducible labelled sample for each customer: the draws are made from its key."""
    return synthetic.labelled(_table(spark, sf_dir, "customer").select((F.col("c_custkey") - 1000).alias("id")))


def row_to_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = _table(spark, sf_dir, "nation")
    return nation.select("n_nationkey", row_json(nation, "n_nationkey", "n_name").alias("value"))


QUERIES = {f.__name__: f for f in [
    iot_window_metrics, iot_window_metrics_1d, iot_enriched, maintenance_rule, enrich_miss, frame_offsets, cdp_unified, cogroup_lists, orders_left_lineitem, semi_filter_ids, click_sessions,
    sliding_counts, json_rows, json_dead_letter, job_counters, oversize_route, conform_sink, deadletter_records, taxi_sanitize, taxi_errors, taxi_table, sanitized_json, upsert_latest, cdc_replica,
    cell_versions, format_predictions, local_inference, endpoint_inference, trained_model, log_batches, log_events, delivery_outcomes, synthetic_samples, row_to_json,
    iot_events, iot_errors, coupon_rows, coupon_errors, with_values, click_enriched, route_destinations, sanitize_nested, cdc_late, change_records, dimension_versions, predicted_messages, queue_records,
    undelivered_events, json_lines, cdp_panes, pane_counts, as_of_views, inference_errors, delivery_queue, delivery_letters,
]}


def queries() -> dict:
    return dict(QUERIES)


_FMT = "'%Y-%m-%d %H:%M:%S.%f'"
_VEHICLES = "v AS (SELECT CAST(user_id AS VARCHAR) AS vehicle_id, ts, TRY_CAST(props->>'$.k' AS INTEGER) AS k, value, event_id FROM events)"


def _metrics_sql(size: str) -> str:
    return f"""{_VEHICLES}, w AS (
  SELECT vehicle_id, time_bucket(INTERVAL '{size}', ts, TIMESTAMP '1970-01-01') AS ws, max(ts) AS mt, max(CAST(k AS DOUBLE)) AS max_temperature, max(CAST(value AS DOUBLE)) AS max_vibration,
    CAST(trunc(avg(event_id)) AS BIGINT) AS avg_mileage FROM v GROUP BY 1, 2)"""


def _window_sql(size: str) -> str:
    return f"WITH {_metrics_sql(size)} SELECT vehicle_id, strftime(ws, {_FMT}) AS window_start, strftime(mt, {_FMT}) AS max_timestamp, max_temperature, max_vibration, avg_mileage FROM w"


_ENRICHED = f"""{_metrics_sql('1 day')}, d AS (
  SELECT CAST(c_custkey AS VARCHAR) AS vehicle_id, strftime(DATE '2024-01-01' + CAST(c_nationkey * 7 AS INTEGER), '%Y-%m-%d') AS last_service_date, c_mktsegment AS maintenance_type, c_name AS model FROM customer),
en AS (SELECT w.vehicle_id, max_temperature, max_vibration, strftime(mt, {_FMT}) AS latest_timestamp, avg_mileage, last_service_date, maintenance_type, model FROM w JOIN d USING (vehicle_id))"""
_DRAW = "((((n + {s}) * 1103515245 + 12345) % 2147483648 + 2147483648) % 2147483648 // 65536) % {b}"
_WIDE_SQL = """wide AS (
  SELECT CAST(event_id AS VARCHAR) AS id, CASE WHEN event_id % 11 = 0 THEN 'many' WHEN event_id % 13 = 0 THEN '3.5' ELSE props->>'$.k' END AS k,
    CASE WHEN event_id % 17 <> 0 THEN event_type END AS kind FROM events),
fit AS (SELECT *, concat_ws('; ', CASE WHEN k IS NOT NULL AND NOT regexp_matches(k, '^[+-]?[0-9]+$') THEN 'k: not int' END, CASE WHEN kind IS NULL THEN 'kind: null' END) AS err FROM wide)"""
_TAXI_COLUMNS = 'ride_id, point_idx, latitude, longitude, "timestamp", meter_reading, meter_increment, ride_status, passenger_count'

ORACLE = {
    "iot_window_metrics": _window_sql("60 seconds"),
    "iot_window_metrics_1d": _window_sql("1 day"),
    "iot_enriched": f"WITH {_ENRICHED} SELECT * FROM en",
    "maintenance_rule": f"""WITH {_ENRICHED} SELECT vehicle_id, CAST(trunc(max_temperature) AS BIGINT) AS max_temperature, max_vibration, latest_timestamp, last_service_date, maintenance_type, model,
      CAST(coalesce(max_temperature > 75, false) OR coalesce(max_vibration > 250, false) OR CAST(last_service_date AS DATE) < DATE '{AS_OF}' - 120 AS BIGINT) AS needs_maintenance FROM en""",
    "enrich_miss": "WITH l AS (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id) SELECT documents.doc_id, lang, quality, l.doc_id IS NULL AS enrichment_miss FROM documents LEFT JOIN l ON documents.doc_id = l.doc_id",
    "frame_offsets": "WITH d AS (SELECT CAST(c_custkey AS VARCHAR) AS vehicle_id, c_nationkey * 7 AS day FROM customer) SELECT vehicle_id, CAST(day - (SELECT min(day) FROM d) AS INTEGER) AS service_day FROM d",
    "cdp_unified": """WITH p AS (SELECT *, date_trunc('day', ts) AS w FROM events WHERE event_type = 'purchase'), c AS (SELECT *, date_trunc('day', ts) AS w FROM events WHERE event_type = 'click')
      SELECT CAST(p.user_id AS VARCHAR) AS transaction_id, CAST(p.user_id % 7 AS VARCHAR) AS household_key, CAST(c.event_id AS VARCHAR) AS coupon_upc, CAST(p.event_id AS VARCHAR) AS product_id, p.props->>'$.k' AS coupon_discount
      FROM p LEFT JOIN c ON p.user_id = c.user_id AND p.w = c.w""",
    "cdp_panes": """WITH p AS (SELECT *, date_trunc('day', ts) AS w FROM events WHERE event_type = 'purchase'), c AS (SELECT *, date_trunc('day', ts) AS w FROM events WHERE event_type = 'click')
      SELECT CAST(p.user_id AS VARCHAR) AS transaction_id, CAST(p.user_id % 7 AS VARCHAR) AS household_key, CAST(p.event_id AS VARCHAR) AS product_id, CAST(c.event_id AS VARCHAR) AS coupon_upc,
        CASE WHEN c.event_id IS NOT NULL THEN greatest(p.event_id % 5, c.event_id % 5) END AS pane FROM p LEFT JOIN c ON p.user_id = c.user_id AND p.w = c.w""",
    "pane_counts": f"""WITH e AS (SELECT date_trunc('day', ts) AS day, event_type, event_id % 7 AS pane, count(*) AS n, max(event_id) AS last FROM events GROUP BY ALL)
      SELECT strftime(day, {_FMT}) AS day, event_type, pane, n, last, CAST(sum(n) OVER w AS BIGINT) AS n_so_far, max(last) OVER w AS last_so_far FROM e WINDOW w AS (PARTITION BY day, event_type ORDER BY pane)""",
    "as_of_views": f"""WITH v AS (SELECT user_id, ts, event_id, value FROM events WHERE event_type = 'view' QUALIFY row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id DESC) = 1)
      SELECT p.event_id, p.user_id, strftime(p.ts, {_FMT}) AS ts, v.event_id AS view_id, v.value AS view_value, strftime(v.ts, {_FMT}) AS viewed
      FROM (SELECT * FROM events WHERE event_type = 'purchase') p ASOF LEFT JOIN v ON p.user_id = v.user_id AND p.ts >= v.ts""",
    "cogroup_lists": """WITH p AS (SELECT CAST(user_id AS VARCHAR) AS u, strftime(ts, '%Y-%m-%d') AS d, string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY CAST(event_id AS VARCHAR)) AS x FROM events WHERE event_type = 'purchase' GROUP BY 1, 2),
      c AS (SELECT CAST(user_id AS VARCHAR) AS u, strftime(ts, '%Y-%m-%d') AS d, string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY CAST(event_id AS VARCHAR)) AS x FROM events WHERE event_type = 'click' GROUP BY 1, 2)
      SELECT coalesce(p.u, c.u) AS transaction_id, coalesce(p.d, c.d) AS day, coalesce(p.x, '') AS products, coalesce(c.x, '') AS coupons FROM p FULL JOIN c ON p.u = c.u AND p.d = c.d""",
    "orders_left_lineitem": "SELECT o_orderkey, o_orderstatus, l_linenumber, l_quantity FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey",
    "semi_filter_ids": f"SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_orderkey IN ({', '.join(map(str, IDS))}) AND l_orderkey IN (SELECT o_orderkey FROM orders)",
    "click_sessions": f"""WITH a AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w > INTERVAL 30 MINUTE OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
      s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS n FROM a)
      SELECT user_id, strftime(min(ts), {_FMT}) AS session_start, strftime(max(ts) + INTERVAL 30 MINUTE, {_FMT}) AS session_end, count(*) AS events FROM s GROUP BY user_id, n""",
    "sliding_counts": f"SELECT strftime(date_trunc('day', ts) - to_days(CAST(i AS INTEGER)), {_FMT}) AS window_start, event_type, count(*) AS n FROM events, range(2) r(i) GROUP BY 1, 2",
    "json_rows": f"WITH {_RAW_SQL} SELECT event_id, CAST(value->>'$.k' AS BIGINT) AS k FROM tagged WHERE error_tag IS NULL",
    "json_dead_letter": f"WITH {_RAW_SQL} SELECT error_tag, value FROM tagged WHERE error_tag IS NOT NULL",
    "job_counters": f"""WITH {_RAW_SQL} SELECT count(*) AS received_messages, count(*) FILTER (error_tag IS NULL AND event_id % 50 <> 0) AS successful_messages, count(*) FILTER (error_tag = 'JsonParseError') AS json_parse_failed_messages,
      count(*) FILTER (error_tag = 'TooBigRow') AS too_big_messages, count(*) FILTER (error_tag IS NULL AND event_id % 50 = 0) AS failed_insert_messages FROM tagged""",
    "oversize_route": "SELECT doc_id, CAST(strlen(text) AS BIGINT) AS bytes FROM documents WHERE strlen(text) >= 4096",
    "conform_sink": f"WITH {_WIDE_SQL} SELECT CAST(id AS BIGINT) AS id, CAST(k AS INTEGER) AS k, kind, CAST(NULL AS VARCHAR) AS note FROM fit WHERE err = ''",
    "deadletter_records": f"""WITH {_WIDE_SQL}, j AS (SELECT err, '{{"id":"' || id || '","k":' || coalesce('"' || k || '"', 'null') || ',"kind":' || coalesce('"' || kind || '"', 'null') || ',"unknown":"ignored"}}' AS p FROM fit WHERE err <> '')
      SELECT '2024-01-01 00:00:00.000000' AS "timestamp", p AS payloadString, hex(encode(p)) AS payloadBytes, '[{{"key":"source","value":"events"}}]' AS attributes, err AS errorMessage FROM j""",
    "taxi_sanitize": f"WITH {_TAXI_SQL} SELECT {_TAXI_COLUMNS} FROM e WHERE err IS NULL",
    "taxi_errors": f"""WITH {_TAXI_SQL} SELECT value AS input_data, err AS error_message, strftime(ts, {_FMT}) AS "timestamp" FROM e WHERE err IS NOT NULL""",
    "taxi_table": f"""WITH {_TAXI_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY ride_id, passenger_count ORDER BY "timestamp" DESC, point_idx DESC) AS rn FROM e WHERE err IS NULL)
      SELECT ride_id, CAST(point_idx AS BIGINT) AS point_idx, latitude, longitude, strftime(CAST(substr("timestamp", 1, 10) AS TIMESTAMP), {_FMT}) AS "timestamp", meter_reading, meter_increment, ride_status, CAST(passenger_count AS BIGINT) AS passenger_count FROM r WHERE rn = 1""",
    "sanitized_json": f"""WITH {_TAXI_SQL} SELECT strftime(ts, {_FMT}) AS publish_time, CASE WHEN NOT ok THEN value ELSE '{{"ride_id":' || to_json(ride_id) || ',"point_idx":' || coalesce(CAST(point_idx AS VARCHAR), 'null')
      || ',"latitude":' || latitude || ',"longitude":' || longitude || ',"timestamp":' || to_json("timestamp") || ',"meter_reading":' || meter_reading || ',"meter_increment":' || meter_increment
      || ',"ride_status":' || to_json(ride_status) || ',"passenger_count":' || coalesce(CAST(passenger_count AS VARCHAR), 'null') || '}}' END AS value FROM t""",
    "upsert_latest": f"SELECT user_id, event_type, strftime(ts, {_FMT}) AS ts, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1",
    "cdc_replica": "SELECT user_id, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1 AND event_type <> 'error'",
    "cell_versions": "SELECT user_id, event_id, value, CAST(rn AS INTEGER) AS version FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn <= 2",
    "format_predictions": "SELECT conv_id, turn, 'Input: ' || chr(10) || coalesce(text, '') || ', ' || chr(10) || chr(10) || chr(10) || 'Output: ' || chr(10) || CASE WHEN turn % 2 = 0 THEN coalesce(role, '') ELSE '' END AS value FROM conversations",
    "local_inference": "SELECT coalesce(text, '') AS example, strlen(coalesce(text, '')) || ' bytes: ' || coalesce(text, '') AS inference, 'stated' AS model_id FROM conversations",
    "endpoint_inference": """SELECT '{"conv_id":' || conv_id || ',"turn":' || turn || '}' AS example, CAST(1000 * conv_id + turn AS VARCHAR) AS inference, 'endpoint' AS model_id FROM conversations""",
    "trained_model": f"""WITH e AS (SELECT CAST(event_id AS VARCHAR) AS vehicle_id, CAST(50 + event_id % 50 AS INTEGER) AS max_temperature, (event_id % 100) / 100 AS max_vibration, DATE '2024-01-01' + CAST(event_id % 300 AS INTEGER) AS d FROM events WHERE event_id % 5 = 0),
      r AS (SELECT *, CAST(max_temperature > 75 OR max_vibration > 0.5 OR d < DATE '{AS_OF}' - 180 AS BIGINT) AS rule FROM e)
      SELECT vehicle_id, max_temperature, max_vibration, strftime(d, '%Y-%m-%d') AS last_service_date, rule,
        CASE WHEN rule = 0 AND max_temperature < 55 AND max_vibration < 0.1 AND DATE '{AS_OF}' - d < 60 OR rule = 1 AND max_temperature > 90 AND max_vibration > 0.9 THEN true END AS agrees_where_clear FROM r""",
    "inference_errors": """SELECT conv_id || '/' || turn AS example, CASE WHEN turn % 10 <> 3 THEN reverse(conv_id || '/' || turn) END AS inference, 'picky' AS model_id,
      CASE WHEN turn % 10 = 3 THEN 'ValueError: no answer to ' || conv_id || '/' || turn END AS error FROM conversations""",
    "delivery_queue": f"""SELECT CAST(event_id AS VARCHAR) AS value, CAST(event_id % 3 + CASE WHEN event_id // 100 % 4 = 1 THEN 1 ELSE 0 END AS INTEGER) AS failures,
      strftime(TIMESTAMP '2024-01-01' + to_minutes(CASE WHEN event_id // 100 % 4 = 3 THEN 5 ELSE 1 << (event_id % 3) END), {_FMT}) AS due
      FROM events WHERE event_id // 100 % 4 = 3 OR event_id // 100 % 4 = 1 AND event_id % 3 < 2""",
    "delivery_letters": """SELECT CAST(event_id AS VARCHAR) AS value, CASE WHEN event_id // 100 % 4 = 2 THEN 400 ELSE 503 END AS status, CAST(event_id % 3 + 1 AS INTEGER) AS attempts
      FROM events WHERE event_id // 100 % 4 = 2 OR event_id // 100 % 4 = 1 AND event_id % 3 = 2""",
    "log_batches": """WITH b AS (SELECT event_id // 100 AS batch, count(*) AS events, CAST(sum(strlen('{"event":' || to_json(props) || '}')) AS BIGINT) AS bytes FROM events GROUP BY 1)
      SELECT batch, events, bytes, CASE WHEN bytes <= 2790 THEN 200 ELSE 413 END AS status, CASE WHEN bytes <= 2790 THEN 'ok' ELSE 'dead' END AS outcome FROM b""",
    "undelivered_events": """WITH e AS (SELECT event_id // 100 AS batch, event_id, event_type FROM events), f AS (SELECT batch, string_agg('{"event":"' || event_type || '"}', '' ORDER BY event_id) AS body FROM e GROUP BY 1)
      SELECT '{"event":"' || event_type || '"}' AS value, 404 AS status, count(*) AS n FROM e JOIN f USING (batch) WHERE contains(substr(body, 1, 40), 'signup') GROUP BY 1""",
    "iot_events": f"""SELECT 'v' || user_id AS vehicle_id, CAST(event_id % 90 AS INTEGER) AS temperature, event_id % 3 + 0.5::DOUBLE AS vibration, CAST(NULL AS INTEGER) AS fuel_level, CAST(event_id AS INTEGER) AS mileage,
      strftime(date_trunc('second', ts), {_FMT}) AS event_time FROM events WHERE event_id % 71 <> 0 AND event_id % 73 <> 0 AND event_id % 79 <> 0""",
    "iot_errors": f"""WITH m AS (SELECT ts, event_id, CASE WHEN event_id % 79 = 0 THEN chr(10) || '{{' || event_id ELSE '{{"vehicle_id":' || CASE WHEN event_id % 71 = 0 THEN 'null' ELSE '"v' || user_id || '"' END
        || ',"timestamp":"' || CASE WHEN event_id % 73 = 0 THEN 'yesterday' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END || '","temperature":"' || event_id % 90 || '","rpm":1,"vibration":' || event_id % 3 || '.5,"fuel_level":null,"mileage":' || event_id || '}}' END AS v FROM events)
      SELECT v AS input_data, CASE WHEN event_id % 79 = 0 THEN 'not a JSON object' WHEN event_id % 71 = 0 THEN 'missing: vehicle_id' ELSE 'missing or malformed: timestamp' END AS error_message, strftime(ts, {_FMT}) AS "timestamp"
      FROM m WHERE event_id % 71 = 0 OR event_id % 73 = 0 OR event_id % 79 = 0""",
    "coupon_rows": """SELECT CAST(user_id AS VARCHAR) AS transaction_id, CASE WHEN event_id % 3 <> 0 THEN 'h' END AS household_key, 'say: NaN, "' || event_id || '", NaN' AS coupon_upc, CAST(NULL AS VARCHAR) AS day
      FROM events WHERE event_id % 31 <> 0 AND event_id % 37 <> 0 AND event_id % 29 <> 0""",
    "coupon_errors": f"""WITH {_COUPON_SQL} SELECT value AS input_data, CASE WHEN event_id % 31 = 0 OR event_id % 37 = 0 THEN 'JsonParseError' ELSE 'missing: transaction_id' END AS error_message
      FROM m WHERE event_id % 31 = 0 OR event_id % 37 = 0 OR event_id % 29 = 0""",
    "with_values": "SELECT event_id, props->>'$.k' AS k FROM events WHERE props->>'$.k' IS NOT NULL",
    "click_enriched": "SELECT event_id, user_id, c_mktsegment, c_custkey IS NULL AS enrichment_miss FROM events LEFT JOIN customer ON user_id = c_custkey AND c_custkey % 3 <> 0 WHERE event_type = 'click'",
    "route_destinations": "SELECT CASE WHEN event_type IN ('click', 'view') THEN 'web_' || event_type ELSE 'other' END AS destination, count(*) AS n, max(event_id) AS last FROM events GROUP BY 1",
    "sanitize_nested": """SELECT event_id, user_id AS id, event_id % 2 = 0 AS known, event_type || ',x' AS tags, CAST(event_id AS INTEGER) AS first, CAST(3 AS BIGINT) AS counted, true AS odd_is_null,
      event_id % 9 + 0.5::DOUBLE AS w, true AS on_a, event_id % 3 = 0 AS on_b FROM events""",
    "cdc_late": "SELECT user_id, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1 AND event_type <> 'error'",
    "change_records": """WITH m AS (SELECT event_id AS id, event_id % 3 AS t, event_id % 5 AS a, event_id % 4 AS b, event_type AS k FROM events)
      SELECT id, CAST(CASE WHEN t = 0 THEN a ELSE b END AS INTEGER) AS amount, CASE WHEN t = 0 THEN k ELSE 'click' END AS kind, CASE t WHEN 0 THEN 'DELETE' WHEN 1 THEN 'UPDATE' ELSE 'INSERT' END AS mod_type,
        CASE WHEN t = 1 THEN concat_ws(',', CASE WHEN a <> b THEN 'amount' END, CASE WHEN k <> 'click' THEN 'kind' END) END AS changed FROM m""",
    "dimension_versions": "SELECT o_custkey, o_orderkey, o_orderstatus FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn FROM orders) WHERE rn = 1",
    "predicted_messages": """WITH m AS (SELECT '{"message":' || to_json('{"user_id":' || user_id || ',"n":' || event_id || '}') || ',"c_mktsegment":' || coalesce('"' || c_mktsegment || '"', 'null') || '}' AS x
        FROM events LEFT JOIN customer ON user_id = c_custkey WHERE event_type = 'purchase')
      SELECT 'Input: ' || chr(10) || x || ', ' || chr(10) || chr(10) || chr(10) || 'Output: ' || chr(10) || strlen(x) || ' bytes: ' || x AS value FROM m""",
    "queue_records": """SELECT conv_id || '/' || turn || ' ' || coalesce(text, '') AS text, CASE WHEN conv_id % 2 = 0 THEN role END AS role, CASE WHEN conv_id % 2 = 0 THEN CAST(turn AS VARCHAR) END AS turn, CAST(CASE WHEN conv_id % 2 = 0 THEN 2 ELSE 0 END AS BIGINT) AS n FROM conversations""",
    "json_lines": """SELECT CASE WHEN c_custkey % 10 <> 7 THEN CAST(c_custkey AS VARCHAR) END AS vehicle_id, CASE WHEN c_custkey % 10 <> 7 THEN strftime(DATE '2024-01-01' + CAST(c_nationkey * 7 AS INTEGER), '%Y-%m-%d') END AS last_service_date,
      CASE WHEN c_custkey % 10 <> 7 THEN c_mktsegment END AS maintenance_type, CASE WHEN c_custkey % 10 <> 7 THEN c_name END AS model, CASE WHEN c_custkey % 10 = 7 THEN '{' || c_custkey END AS bad FROM customer""",
    "log_events": """SELECT event_id, '{"time":' || CAST(floor(epoch(ts)) AS BIGINT) || ',"event":"' || event_type || '"}' AS event FROM events""",
    "delivery_outcomes": """WITH s AS (SELECT CASE WHEN event_id % 7 <> 0 THEN [200, 201, 400, 404, 408, 429, 500, 503][event_id % 8 + 1] END AS st FROM events)
      SELECT CASE WHEN st BETWEEN 200 AND 299 THEN 'ok' WHEN st IS NULL OR st IN (408, 429) OR st >= 500 THEN 'retry' ELSE 'dead' END AS outcome, count(*) AS n FROM s GROUP BY 1""",
    "synthetic_samples": f"""WITH r AS (SELECT c_custkey - 1000 AS n FROM customer), s AS (SELECT CAST(n + 1000 AS VARCHAR) AS vehicle_id, CAST(50 + {_DRAW.format(s=8, b=50)} AS INTEGER) AS max_temperature, {_DRAW.format(s=9, b=1000)} / 1000 AS max_vibration,
      DATE '2025-01-18' - CAST({_DRAW.format(s=10, b=365)} AS INTEGER) AS d FROM r)
      SELECT vehicle_id, max_temperature, max_vibration, strftime(d, '%Y-%m-%d') AS last_service_date, max_temperature > 75 OR max_vibration > 0.5 OR d < DATE '2025-01-18' - 180 AS needs_maintenance FROM s""",
    "row_to_json": """SELECT n_nationkey, '{"n_nationkey":' || n_nationkey || ',"n_name":"' || n_name || '"}' AS value FROM nation""",
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)

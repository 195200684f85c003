"""Fixed schemas and readers of schema descriptions; nothing is ever inferred from data."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T


_KINDS = {"string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(), "timestamp": T.TimestampType(), "binary": T.BinaryType()}
_ATTRIBUTES = T.ArrayType(T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.StringType())]))


def _struct(fields: str, required: str = "") -> T.StructType:
    """``name kind, ...`` as a struct, without a session; fields named in ``required`` (or all: *) are not null."""
    need = set(required.split())
    pairs = [f.split() for f in fields.split(",")]
    return T.StructType([T.StructField(n, _ATTRIBUTES if k == "attributes" else _KINDS[k], n not in need and "*" not in need) for n, k in pairs])


TAXI_EVENT = _struct(
    "ride_id string, point_idx int, latitude double, longitude double, timestamp string, meter_reading double, meter_increment double, ride_status string, passenger_count int", "*"
)
TAXI_KEY = ["ride_id", "point_idx"]
PARSING_ERROR = _struct("input_data string, error_message string, timestamp timestamp")
TRANSACTION = _struct(
    "household_key string, transaction_id string, day string, product_id string, quantity string, sales_value string, store_id string, retail_disc string, trans_time string, week_no string, coupon_disc string, coupon_match_disc string"
)
COUPON_REDEMPTION = _struct("household_key string, day string, coupon_upc string, campaign string, transaction_id string")
UNIFIED = _struct("transaction_id string, household_key string, coupon_upc string, product_id string, coupon_discount string", "transaction_id")
VEHICLE_EVENT = _struct("vehicle_id string, timestamp string, temperature int, rpm int, vibration double, fuel_level int, mileage int")
MAINTENANCE = _struct("vehicle_id string, last_service_date string, maintenance_type string, make string, model string")
MAINTENANCE_ANALYTICS = "vehicle_id:STRING,max_temperature:INTEGER,max_vibration:FLOAT,latest_timestamp:TIMESTAMP,last_service_date:STRING,maintenance_type:STRING,model:STRING,needs_maintenance:INTEGER"
CLICKSTREAM = _struct("prev string, curr string, type string, n bigint")
DEAD_LETTER = _struct(
    "timestamp timestamp, payloadString string, payloadBytes binary, attributes attributes, errorMessage string, stacktrace string", "timestamp payloadString payloadBytes"
)
PREDICTION = _struct("example string, inference string, model_id string")

_WAREHOUSE = {
    "STRING": T.StringType(), "BYTES": T.BinaryType(), "INTEGER": T.LongType(), "INT64": T.LongType(), "FLOAT": T.DoubleType(), "FLOAT64": T.DoubleType(),
    "BOOLEAN": T.BooleanType(), "BOOL": T.BooleanType(), "TIMESTAMP": T.TimestampType(), "DATE": T.DateType(), "DATETIME": T.TimestampNTZType(),
}


def from_warehouse_json(fields: str | list[dict] | dict) -> T.StructType:
    """A warehouse schema file (a list of fields, or {"schema"/"fields": list}) as a struct;
    REQUIRED, NULLABLE and REPEATED modes and nested records are kept."""
    found = json.loads(fields) if isinstance(fields, str) else fields
    while isinstance(found, dict):
        found = found.get("fields") or found.get("schema") or []

    def field(f: dict) -> T.StructField:
        kind = from_warehouse_json(f["fields"]) if f["type"].upper() in ("RECORD", "STRUCT") else _WAREHOUSE[f["type"].upper()]
        mode = f.get("mode", "NULLABLE").upper()
        return T.StructField(f["name"], T.ArrayType(kind) if mode == "REPEATED" else kind, mode != "REQUIRED")

    return T.StructType([field(f) for f in found])


def from_warehouse_string(text: str) -> T.StructType:
    """``name:TYPE, name:TYPE`` as a struct; white space is ignored."""
    pairs = [p.split(":") for p in text.split(",") if p.strip()]
    return T.StructType([T.StructField(n.strip(), _WAREHOUSE[t.strip().upper()]) for n, t in pairs])


@dataclass(frozen=True)
class ParseOutput:
    """The two sides of a parse: typed rows, and error rows (input_data, error_message, timestamp)."""

    good: DataFrame
    errors: DataFrame

"""Small column functions that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INTEGER = r"^[+-]?[0-9]+$"
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
RFC3339 = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]XXX"
VEHICLE_TIME = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def utf8(payload: Column, strict: bool = False) -> Column:
    """Bytes as text; malformed bytes are replaced, or fail the query if ``strict``."""
    return F.validate_utf8(payload.cast("string")) if strict else F.make_valid_utf8(payload.cast("string"))


def to_integer(text: Column, kind: str = "int") -> Column:
    """An optionally signed decimal integer that fits ``kind``, else null (no blanks, no fractions)."""
    return F.when(text.rlike(INTEGER), text.try_cast(kind))


def to_number(text: Column, kind: str = "double") -> Column:
    return F.when(text.rlike(NUMBER), text.try_cast(kind))


def to_flag(text: Column) -> Column:
    """True for any spelling of "true", else false; null stays null."""
    return F.lower(text) == "true"


def prediction_text(example: Column, inference: Column) -> Column:
    """The text of a prediction; missing parts are empty rather than making it null."""
    empty = F.lit("")
    return F.concat(F.lit("Input: \n"), F.coalesce(example.cast("string"), empty), F.lit(", \n\n\nOutput: \n"), F.coalesce(inference.cast("string"), empty))


def row_json(df: DataFrame, *names: str) -> Column:
    """The columns (all by default) as one JSON object; nulls are written."""
    return F.to_json(F.struct(*(names or df.columns)), {"ignoreNullFields": "false"})


def guarded_divide(total: Column, count: Column) -> Column:
    return F.when(count > 0, total / count).otherwise(F.lit(0.0))


def rfc3339(text: Column) -> Column:
    return F.try_to_timestamp(text, F.lit(RFC3339))

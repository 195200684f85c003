"""JSON in and out of pipelines, with every bad message routed, none lost and none fatal.

Two parsers:

* ``parse_objects`` checks that a message is a JSON object below a size limit and tags
  the rest with a reason (too big wins over unparsable, and a message has one tag only);
* ``parse_typed`` rebuilds a message from a schema: only the schema's fields, read as
  text from a shadow schema of strings, then coerced leaf by leaf. Anything that does
  not coerce, and any missing required field, makes an error row.

Both are expressions only, so they run alike on batch and streaming DataFrames.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import to_flag, to_integer, to_number
from ..functions.schemas import ParseOutput

TOO_BIG, BAD_JSON = "TooBigRow", "JsonParseError"
MOST_BYTES = 10 * 1024 * 1024


#: The four characters that JSON has as white space may surround a message.
_WHITE = " \t\r\n"
#: An element that is put behind a message to see where the parser stopped.
_MARK = "end-of-the-message"


def is_object(text: Column) -> Column:
    """Whether a text is one JSON object. Blank texts, scalars, arrays, objects with anything behind them
    and objects that repeat a key are not."""
    trimmed = F.btrim(text, F.lit(_WHITE))
    wrapped = lambda a, b: F.try_parse_json(F.concat(F.lit(a), text, F.lit(b)))
    # The parser stops behind the first value. If the second element is the mark, the first one is the whole text.
    alone = F.try_variant_get(wrapped("[", f',"{_MARK}"]'), "$[1]", "string") == _MARK
    # Of a text that holds the mark itself: what parses both as an element and as a field ends where that value ends.
    both = wrapped("[", "]").isNotNull() & wrapped('{"x":', "}").isNotNull()
    whole = F.when(F.contains(text, F.lit(_MARK)), both).otherwise(alone)
    return F.coalesce(F.startswith(trimmed, F.lit("{")) & F.endswith(trimmed, F.lit("}")) & whole, F.lit(False))


def parse_objects(df: DataFrame, value: str = "value", most: int = MOST_BYTES) -> DataFrame:
    """``df`` with error_tag: null for a JSON object of less than ``most`` bytes."""
    text = F.col(value).cast("string")
    return df.withColumn("error_tag", F.when(F.octet_length(text) >= most, TOO_BIG).when(~is_object(text), BAD_JSON))


def split_tagged(df: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """(rows without tag, (error_tag, value) of the others)."""
    return df.where("error_tag is null").drop("error_tag"), df.where("error_tag is not null").select("error_tag", value)


def _shadow(kind: T.DataType) -> T.DataType:
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _shadow(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_shadow(kind.elementType))
    return T.StringType()


def _coerce(text: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StructType):
        return F.when(text.isNotNull(), F.struct(*[_coerce(text.getField(f.name), f.dataType).alias(f.name) for f in kind.fields]))
    if isinstance(kind, T.ArrayType):
        return F.transform(text, lambda x: _coerce(x, kind.elementType))
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return to_integer(text, kind.simpleString())
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return to_number(text, kind.simpleString())
    if isinstance(kind, T.BooleanType):
        return to_flag(text)
    return text.try_cast(kind)


def sanitize(text: Column, schema: T.StructType) -> Column:
    """A struct of only the schema's fields, in its order, coerced; null if ``text`` is no object."""
    raw = F.when(is_object(text), F.from_json(text, _shadow(schema)))
    # Bound to a lambda's variable, the parsed text is made once and not once for each field.
    return F.transform(F.array(raw), lambda r: _coerce(r, schema))[0]


def sanitize_json(text: Column, schema: T.StructType) -> Column:
    """The sanitised object as JSON; what is no object passes unchanged, for the parser to report."""
    return F.coalesce(F.to_json(sanitize(text, schema), {"ignoreNullFields": "false"}), text)


def parse_typed(df: DataFrame, schema: T.StructType, value: str = "value", timestamp: str = "publish_time") -> ParseOutput:
    """Typed rows of the messages, and (input_data, error_message, timestamp) of the bad ones."""
    text = F.col(value).cast("string")
    # The generator keeps the optimiser from copying the parse into every use of its fields.
    row = df.withColumn("__row", F.explode(F.array(sanitize(text, schema))))
    missing = [F.when(F.col(f"__row.`{f.name}`").isNull(), F.lit(f.name)) for f in schema.fields if not f.nullable]
    bad = F.array_compact(F.array(*missing)) if missing else F.array().cast("array<string>")
    error = F.when(F.col("__row").isNull(), F.lit("not a JSON object")).when(F.size(bad) > 0, F.concat(F.lit("missing or malformed: "), F.array_join(bad, ",")))
    tagged = row.withColumn("__error", error)
    good = tagged.where("__error is null").select("__row.*")
    errors = tagged.where("__error is not null").select(text.alias("input_data"), F.col("__error").alias("error_message"), F.col(timestamp).cast("timestamp").alias("timestamp"))
    return ParseOutput(good, errors)


def counters(tagged: DataFrame, failed_insert: Column | None = None) -> DataFrame:
    """The five job counters of tagged messages in one row; on a stream use ``observe_counters``."""
    return tagged.agg(*_counter_columns(failed_insert))


def observe_counters(tagged: DataFrame, name: str = "job_counters", failed_insert: Column | None = None) -> DataFrame:
    """The messages unchanged; their counters go to the query listener as metrics ``name``."""
    return tagged.observe(name, *_counter_columns(failed_insert))


def _counter_columns(failed_insert: Column | None) -> list[Column]:
    failed = F.lit(False) if failed_insert is None else failed_insert
    tag = F.col("error_tag")
    return [
        F.count(F.lit(1)).alias("received_messages"),
        F.count_if(tag.isNull() & ~failed).alias("successful_messages"),
        F.count_if(tag.eqNullSafe(BAD_JSON)).alias("json_parse_failed_messages"),
        F.count_if(tag.eqNullSafe(TOO_BIG)).alias("too_big_messages"),
        F.count_if(tag.isNull() & failed).alias("failed_insert_messages"),
    ]

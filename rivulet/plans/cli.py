"""``python -m rivulet.plans.cli PIPELINE --option ...``: start a pipeline as a stream.

Models and collectors are given as ``module:factory``: the factory takes the endpoint or
model id and returns a ``ModelHandler``, or, for logs, takes the endpoint and returns the
function that posts a body. ``--lookup`` names one that takes ``--dimension`` and returns what makes a
client of a live store. With ``--early`` the unified rows come out pane by pane, and late ones
among the errors.
"""

from __future__ import annotations

import argparse
import sys
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..functions.schemas import UNIFIED
from ..operators.sinks import publish
from ..sources.messages import read_dimension, read_messages
from ..streaming.runner import append_stream, start
from ..streaming.stateful import ROCKSDB
from . import cdp, clickstream, etl, iot, logs, predictions

OPTIONS = {
    "anomaly": "messages responses endpoint handler deadletter checkpoint",
    "generation": "messages responses model handler deadletter checkpoint",
    "marketing": "messages responses endpoint handler deadletter checkpoint",
    "cdp": "transactions coupons table errors checkpoint",
    "iot": "messages dimension lookup table errors row_key checkpoint",
    "etl": "messages table errors checkpoint",
    "clickstream": "messages table deadletter checkpoint",
    "logs": "messages endpoint handler report queue deadletter checkpoint",
}
#: Options that can be left out, and what holds then.
DEFAULTS = {"row_key": "vehicle_id", "lookup": None, "queue": None}


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="rivulet")
    names = out.add_subparsers(dest="pipeline", required=True)
    for name, options in OPTIONS.items():
        sub = names.add_parser(name)
        for option in options.split():
            optional = option in DEFAULTS or option == "deadletter" and name in ("anomaly", "generation", "marketing")
            sub.add_argument(f"--{option}", required=not optional, default=DEFAULTS.get(option))
        if name == "cdp":
            sub.add_argument("--early", action="store_true", help="give pairs as soon as both rows are there")
        sub.add_argument("--once", action="store_true", help="drain what is there and stop")
    return out


def factory(name: str):
    """What ``module:attribute`` names."""
    module, _, attribute = name.partition(":")
    if not attribute:
        raise ValueError(f"{name!r} is not module:factory")
    return getattr(import_module(module), attribute)


def launch(spark: SparkSession, args: argparse.Namespace) -> list[StreamingQuery]:
    """The running queries of parsed options: the pipeline's, and one for its bad messages where it has such.

    Appends go through the file sink, whose log makes a batch that is run again count once.
    """
    read = lambda uri: read_messages(spark, uri, stream=True)
    out = lambda df, path, name: append_stream(df, path, f"{args.checkpoint}/{name}", once=args.once)
    if args.pipeline in ("anomaly", "generation", "marketing"):
        handler = factory(args.handler)(args.model if args.pipeline == "generation" else args.endpoint)
        if args.deadletter:
            tagged = predictions.tagged(read(args.messages), handler)
            return [start(tagged, f"{args.checkpoint}/answers", lambda rows, n: predictions.write_batch(rows, args.responses, args.deadletter, n), once=args.once)]
        answers = predictions.build(read(args.messages), handler)
        return [start(answers, f"{args.checkpoint}/answers", lambda rows, _: publish(rows, args.responses), once=args.once)]
    if args.pipeline == "cdp":
        sides = [cdp.parse(read(args.transactions), cdp.TRANSACTION), cdp.parse(read(args.coupons), cdp.COUPON_REDEMPTION)]
        errors = sides[0].errors.unionByName(sides[1].errors)
        if args.early:
            paned = cdp.unify_early(sides[0].good, sides[1].good)
            return [start(paned, f"{args.checkpoint}/rows", lambda rows, n: cdp.write_panes(rows, args.table, f"{args.errors}_late", n), once=args.once), out(errors, args.errors, "errors")]
        unified = cdp.unify(sides[0].good, sides[1].good).select(*UNIFIED.names)
        return [out(unified, args.table, "rows"), out(errors, args.errors, "errors")]
    if args.pipeline == "iot":
        dimension = factory(args.lookup)(args.dimension) if args.lookup else read_dimension(spark, args.dimension, args.row_key)
        rows = iot.build(read(args.messages), dimension, iot.Config(row_key=args.row_key))
        return [out(rows, args.table, "rows"), out(iot.parse(read(args.messages)).errors, args.errors, "errors")]
    if args.pipeline == "etl":
        parsed = etl.build(read(args.messages))
        rows = start(parsed.good, f"{args.checkpoint}/rows", lambda batch, _: etl.upsert(batch, args.table), once=args.once)
        return [rows, out(parsed.errors, args.errors, "errors")]
    if args.pipeline == "logs":
        send = factory(args.handler)(args.endpoint)

        def deliver(batch: DataFrame, number: int) -> None:
            logs.deliver(batch, send, args.deadletter, args.report, logs.Config(attempts=5), number, args.queue)

        return [start(read(args.messages), f"{args.checkpoint}/posts", deliver, once=args.once)]
    rows, letters = clickstream.parse(read(args.messages))
    clickstream.require_table(spark, args.table)
    return [out(rows, args.table, "rows"), out(letters, args.deadletter, "letters")]


def main(argv: list[str]) -> None:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"rivulet-{args.pipeline}").config("spark.sql.session.timeZone", "UTC").config("spark.sql.streaming.stateStore.providerClass", ROCKSDB).getOrCreate()
    for query in launch(spark, args):
        query.awaitTermination()


if __name__ == "__main__":
    main(sys.argv[1:])

"""Point lookups in a live keyed store, while events pass.

Unlike a join with a table that is read when a stream starts, a value that changes is seen by the
next lookup. Workers ask an injected client for the distinct keys of an Arrow batch that their cache does not
hold (young enough), some at a time, and wait for an answer for a limited time.
"""

from __future__ import annotations

import threading
import time
import uuid
from collections import OrderedDict
from collections.abc import Callable, Iterator, Sequence
from typing import Any, Protocol

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

HIT, MISS, TIMEOUT, FAILED = "hit", "miss", "timeout", "failed"


class Client(Protocol):
    def get_many(self, keys: Sequence[Any]) -> dict[Any, dict[str, Any]]:
        """The rows of the keys that are there, as values by column."""


class Unanswered(RuntimeError):
    """A lookup that found nothing, failed or took too long, where that is an error."""


class Cache:
    """The ``most`` keys asked for last, with their rows (None: a miss) for ``age`` seconds."""

    def __init__(self, most: int, age: float, clock: Callable[[], float] = time.monotonic):
        self.most, self.age, self.clock = most, age, clock
        self.rows: OrderedDict[Any, tuple[float, dict | None]] = OrderedDict()

    def get(self, key) -> tuple[bool, dict | None]:
        at, row = self.rows.get(key, (None, None))
        if at is None or self.clock() - at >= self.age:
            return False, None
        self.rows.move_to_end(key)
        return True, row

    def put(self, key, row: dict | None) -> None:
        if self.most <= 0 or self.age <= 0:
            return
        self.rows[key] = (self.clock(), row)
        self.rows.move_to_end(key)
        while len(self.rows) > self.most:
            self.rows.popitem(last=False)


class Worker:
    """A worker's connection and cache. A call that takes too long is left alone, and a new connection made for the next one."""

    def __init__(self, connect: Callable[[], Client], timeout: float, batch: int, most: int, age: float):
        self.connect, self.timeout, self.batch = connect, timeout, batch
        self.cache, self.client = Cache(most, age), None

    def _ask(self, keys: list) -> tuple[str, dict]:
        answer: dict[str, Any] = {}

        def call(client: Client | None) -> None:
            try:
                client = client or self.connect()
                answer["rows"] = client.get_many(keys)
                answer["client"] = client
            except Exception as e:  # noqa: BLE001  told to the caller
                answer["error"] = e

        thread = threading.Thread(target=call, args=(self.client,), daemon=True)
        thread.start()
        thread.join(self.timeout)
        if "rows" in answer:
            self.client = answer["client"]
            return HIT, answer["rows"]
        self.client = None
        return (FAILED if "error" in answer else TIMEOUT), {}

    def find(self, keys: Sequence) -> dict[Any, tuple[str, dict | None]]:
        """(outcome, row) of each of some distinct keys."""
        found, ask = {}, []
        for key in keys:
            known, row = self.cache.get(key)
            if known:
                found[key] = (MISS if row is None else HIT, row)
            else:
                ask.append(key)
        for i in range(0, len(ask), self.batch):
            part = ask[i : i + self.batch]
            outcome, rows = self._ask(part)
            for key in part:
                row = rows.get(key)
                found[key] = (outcome if outcome != HIT else MISS if row is None else HIT, row)
                if outcome == HIT:
                    self.cache.put(key, row)
        return found


_workers: OrderedDict[str, Worker] = OrderedDict()
MOST_WORKERS = 4  # lookups that a Python worker keeps a connection for


def lookup(events: DataFrame, connect: Callable[[], Client], key: str, schema: str | T.StructType, timeout: float = 10.0, batch: int = 500, cache: int = 100_000, age: float = 60.0, misses: str = "keep", failures: str = "raise") -> DataFrame:
    """Events with the columns of ``schema`` of their key's row, and lookup: hit, miss, timeout or failed.

    ``connect`` makes a client in a worker. ``misses`` and ``failures`` (no answer in ``timeout`` seconds, or
    an error of the client) say what becomes of such events: ``keep`` (with nulls), ``drop``, or
    ``raise``, which fails the query. A null key is a miss and is not asked for. Columns of ``schema`` that events have
    already are an error. ``age`` 0 asks anew in every batch; a batch asks for a key once.
    """
    fields = (schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)).fields
    names = [f.name for f in fields]
    if clash := set(names) & set(events.columns) | {"lookup"} & {*events.columns, *names}:
        raise ValueError(f"columns stand twice: {sorted(clash)}")
    for policy in (misses, failures):
        if policy not in ("keep", "drop", "raise"):
            raise ValueError(policy)
    own, at, kept = uuid.uuid4().hex, events.columns.index(key), T.StructType([T.StructField(f.name, f.dataType) for f in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        kinds = to_arrow_schema(kept)
        worker = _workers.get(own)
        if worker is None:
            while len(_workers) >= MOST_WORKERS:
                _workers.popitem(last=False)
            worker = _workers[own] = Worker(connect, timeout, batch, cache, age)
        for part in batches:
            keys = part.column(at).to_pylist()
            found = worker.find(list(dict.fromkeys(k for k in keys if k is not None)))
            told = [found.get(k, (MISS, None)) for k in keys]
            for policy, bad in ((misses, (MISS,)), (failures, (TIMEOUT, FAILED))):
                wrong = [k for k, (outcome, _) in zip(keys, told, strict=True) if outcome in bad]
                if policy == "raise" and wrong:
                    raise Unanswered(f"{len(wrong)} lookups without a row, first that of {wrong[0]!r}")
            columns = [pa.array([row.get(f.name) if row else None for _, row in told], kinds.field(f.name).type) for f in fields]
            made = pa.RecordBatch.from_arrays([*part.columns, *columns, pa.array([o for o, _ in told])], names=[*events_columns, *names, "lookup"])
            gone = [o for policy, group in ((misses, (MISS,)), (failures, (TIMEOUT, FAILED))) if policy == "drop" for o in group]
            yield made.filter(pa.array([o not in gone for o, _ in told])) if gone else made

    events_columns = events.columns
    out = T.StructType([*events.schema.fields, *kept.fields, T.StructField("lookup", T.StringType())])
    return events.mapInArrow(run, out)

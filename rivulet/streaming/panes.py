"""Early panes of windows: results before the watermark closes a window, and what comes after it.

``early_left_join`` is the left join of ``joins.windowed_left_join`` fired early with
discarding panes: a micro-batch gives the pairs that its rows make with one another and with all
earlier rows of their key and window, so a pair comes out once, as soon as both of its rows
are there. Left rows without any partner come out when the watermark passes their window;
then the window's state goes. Rows that come later still are given back, marked as late.

``accumulate`` fires early with accumulating panes: a micro-batch gives the whole aggregate so far of
each key and window that it touched, and the newest pane replaces older ones in a keyed table.

How often panes fire is the query's trigger. Both need the RocksDB state store (``stateful.ROCKSDB``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..operators.sinks import upsert
from ..operators.windows import tumbling, watermark
from .runner import start

EARLY, ON_TIME, LATE_LEFT, LATE_RIGHT = "early", "on time", "late left", "late right"
#: Rows of a call that are joined with the kept ones at a time.
CHUNK = 1000


class PanedJoin(StatefulProcessor):
    """The join of one key and window. ``left`` and ``right`` are the columns of each side's part of a row."""

    def __init__(self, left: T.StructType, right: T.StructType):
        self.left, self.right = left, right
        self.made = Row("pane", *left.names, *right.names)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.lefts = handle.getListState("lefts", self.left)
        self.rights = handle.getListState("rights", self.right)

    def _out(self, pane: str, left: tuple | None, right: tuple | None) -> Row:
        return self.made(pane, *(left or [None] * len(self.left.names)), *(right or [None] * len(self.right.names)))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        end, lefts, rights = key[-1], [], []
        known = self.lefts.exists() or self.rights.exists()
        late = not known and end <= timerValues.getCurrentWatermarkInMs()
        if not known and not late:
            self.handle.registerTimer(end)
        for row in rows:
            own = tuple(row[n] for n in (self.left if row["is_left"] else self.right).names)
            if late:
                yield self._out(LATE_LEFT, own, None) if row["is_left"] else self._out(LATE_RIGHT, None, own)
                continue
            (lefts if row["is_left"] else rights).append(own)
            if len(lefts) + len(rights) >= CHUNK:
                yield from self._pairs(lefts, rights)
                lefts, rights = [], []
        yield from self._pairs(lefts, rights)

    def _pairs(self, lefts: list[tuple], rights: list[tuple]) -> Iterator[Row]:
        """The new pairs of some rows, which are then kept."""
        for old in self.rights.get() if lefts else ():
            for new in lefts:
                yield self._out(EARLY, new, tuple(old))
        for old in self.lefts.get() if rights else ():
            for new in rights:
                yield self._out(EARLY, tuple(old), new)
        for left in lefts:
            for right in rights:
                yield self._out(EARLY, left, right)
        if lefts:
            self.lefts.appendList(lefts)
        if rights:
            self.rights.appendList(rights)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        if not self.rights.exists():
            for left in self.lefts.get():
                yield self._out(ON_TIME, tuple(left), None)
        self.lefts.clear()
        self.rights.clear()

    def close(self) -> None:
        pass


def early_left_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_time: str, right_time: str, size: str = "60 seconds", lateness: str = "0 seconds") -> DataFrame:
    """The columns of ``left``, those of ``right`` beside keys and time, and pane.

    pane is ``early`` for pairs, ``on time`` for left rows that had no partner when their
    window closed, and ``late left`` or ``late right`` for rows whose window had closed before.
    All but late rows are together the rows of ``windowed_left_join``; each row that comes in is
    in a pane, or late, so nothing goes unseen. Rows with a null key meet no other; rows with a null time belong to no window and give nothing.

    A join on streams only (a batch has one pane: ``windowed_left_join``).
    """
    payload = [c for c in right.columns if c not in (*keys, right_time)]
    # Null keys get a key of their own row, so that they meet none.
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    group = [*[f"k{i}" for i in range(len(keys))], "alone", "end_ms"]
    shaped = []
    for df, names, time, part in ((watermark(left, left_time, lateness), left.columns, left_time, "l"), (watermark(right, right_time, lateness), [*keys, *payload], right_time, "r")):
        # Neither the end in milliseconds nor a time that was computed anew is an event time to Spark, which so drops no late row unseen.
        end = F.unix_millis(tumbling(time, size)["end"])
        own = [(F.timestamp_micros(F.unix_micros(c)) if c == time else F.col(c)).alias(f"{part}{i}") for i, c in enumerate(names)]
        grouping = [*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], F.when(~whole, F.expr("uuid()")).alias("alone"), end.alias("end_ms")]
        shaped.append(df.where(F.col(time).isNotNull()).select(*grouping, F.lit(part == "l").alias("is_left"), *own))
    kinds = [T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields[len(group) + 1 :]]) for df in shaped]
    both = shaped[0].unionByName(shaped[1], allowMissingColumns=True)
    output = T.StructType([T.StructField("pane", T.StringType()), *kinds[0].fields, *kinds[1].fields])
    joined = both.groupBy(*group).transformWithState(PanedJoin(*kinds), output, outputMode="Append", timeMode="EventTime")
    own = [F.coalesce(f"l{i}", f"r{keys.index(c)}").alias(c) if c in keys else F.col(f"l{i}").alias(c) for i, c in enumerate(left.columns)]
    return joined.select(*own, *[F.col(f"r{i + len(keys)}").alias(c) for i, c in enumerate(payload)], "pane")


def discarded(rows: DataFrame, keys: Sequence[str], pane: str, *aggregates: Column) -> DataFrame:
    """What each discarding pane of rows that carry their pane's number holds: aggregates of the pane's rows alone."""
    return rows.groupBy(*keys, pane).agg(*aggregates)


def accumulated(panes: DataFrame, keys: Sequence[str], pane: str, **merges: Callable[[str], Column]) -> DataFrame:
    """Accumulating panes from discarding ones: each column merged with those of all earlier panes of its key, as ``merges``
    says (``n=F.sum``). Partial aggregates meet here, one a pane, not rows."""
    so_far = Window.partitionBy(*keys).orderBy(pane).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return panes.select(*keys, pane, *[merge(name).over(so_far).alias(name) for name, merge in merges.items()])


def paned_pairs(left: DataFrame, right: DataFrame, keys: Sequence[str], left_time: str, right_time: str, pane: str, size: str = "60 seconds") -> DataFrame:
    """``early_left_join`` over a batch whose rows carry the number of the micro-batch that brought them: the left
    join's rows with the pane that each comes out in, null for left rows without a partner."""
    a = left.withColumn("window", tumbling(left_time, size)).withColumnRenamed(pane, "l_pane")
    b = right.withColumn("window", tumbling(right_time, size)).drop(right_time).withColumnRenamed(pane, "r_pane")
    joined = a.join(b, [*keys, "window"], "left")
    return joined.withColumn(pane, F.when(F.col("r_pane").isNotNull(), F.greatest("l_pane", "r_pane"))).drop("l_pane", "r_pane", "window")


def replace_panes(rows: DataFrame, path: str, keys: Sequence[str], number: int) -> None:
    """Put a pane into a keyed table: of each key the pane of largest number stays, in whatever order panes come."""
    upsert(rows.withColumn("pane", F.lit(number).cast("bigint")), path, keys, ["pane"])


def accumulate(aggregated: DataFrame, path: str, keys: Sequence[str], checkpoint: str, every: str = "10 seconds", once: bool = False) -> StreamingQuery:
    """Keep the newest pane of each key of a streaming aggregate in the table at ``path``.

    The aggregate must have a watermark, so that its state of closed windows goes. A micro-batch is a
    pane and its number; one that is run again replaces itself.
    """
    return start(aggregated, checkpoint, lambda rows, number: replace_panes(rows, path, keys, number), every, mode="update", once=once)

"""Enrichment by the version that a dimension's row had at an event's time.

On a batch ``as_of`` never pairs events with versions. Both are cut into (key, time bucket)
groups, which a union and a last-value window go through in order of time; what a bucket starts with
is carried over from the buckets before by a window over one row a key and bucket. So a key of any
number of events is spread over its buckets, and the work is that of sorting.

On a stream ``VersionLookup`` keeps the versions of each key in state: an event takes the newest one
that is not newer than itself; when the watermark passes, versions that newer ones replaced
before it go.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from .windows import watermark


def as_of(events: DataFrame, versions: DataFrame, key: str, time: str, version_key: str | None = None, version_time: str | None = None, columns: Sequence[str] | None = None, bucket: str = "1 hour") -> DataFrame:
    """Events with the columns, and version_time, of their key's last version at or before their time.

    Of versions with equal key and time the one with the largest columns, in their order, counts. Events
    without a version have nulls, as have those with a null key or time; versions with a null key or
    time never count; repeated events each come out. ``bucket`` bounds the time that one group spans.
    """
    other, at = version_key or key, version_time or time
    names = list(columns or [c for c in versions.columns if c not in (other, at)])
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))  # noqa: E731  of times without zone, in the session's zone
    size = F.expr(f"unix_micros(timestamp_seconds(0) + INTERVAL {bucket})")
    number = lambda t: F.floor(t / size).cast("bigint")
    e = events.select(F.col(key).alias("k"), micros(time).alias("t"), F.struct(*events.columns).alias("e")).withColumn("b", number(F.col("t")))
    v = versions.select(F.col(other).alias("k"), micros(at).alias("t"), F.struct(F.col(at).alias("at"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(names)]).alias("v"))
    v = v.where(F.col("k").isNotNull() & F.col("t").isNotNull()).withColumn("b", number(F.col("t")))
    whole = e.where(F.col("k").isNotNull() & F.col("t").isNotNull())

    # One row a key and bucket: its last version, and what the buckets before it leave.
    last = v.groupBy("k", "b").agg(F.max_by("v", F.struct("t", "v")).alias("v"))
    grid = last.unionByName(whole.select("k", "b").distinct().withColumn("v", F.lit(None).cast(v.schema["v"].dataType)))
    grid = grid.groupBy("k", "b").agg(F.first("v", ignorenulls=True).alias("v"), F.max(F.col("v").isNull()).alias("asked"))
    before = Window.partitionBy("k").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    carried = grid.withColumn("v", F.last("v", ignorenulls=True).over(before)).where("asked and v is not null").select("k", "b", F.lit(None).cast("bigint").alias("t"), F.lit(0).alias("side"), "v")

    none = F.lit(None)
    both = (
        whole.select("k", "b", "t", F.lit(2).alias("side"), none.cast(v.schema["v"].dataType).alias("v"), "e")
        .unionByName(v.select("k", "b", "t", F.lit(1).alias("side"), "v", none.cast(e.schema["e"].dataType).alias("e")))
        .unionByName(carried.withColumn("e", none.cast(e.schema["e"].dataType)))
    )
    line = Window.partitionBy("k", "b").orderBy(F.asc_nulls_first("t"), "side", "v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = both.withColumn("v", F.last("v", ignorenulls=True).over(line)).where("side = 2")
    rest = e.where(F.col("k").isNull() | F.col("t").isNull()).select("e", none.cast(v.schema["v"].dataType).alias("v"))
    own = [F.col(f"e.`{c}`").alias(c) for c in events.columns]
    return found.select("e", "v").unionByName(rest).select(*own, *[F.col(f"v.c{i}").alias(c) for i, c in enumerate(names)], F.col("v.at").alias("version_time"))


class VersionLookup(StatefulProcessor):
    """Versions of one key by their time. ``event`` and ``version`` are the columns of each side's part of a row."""

    def __init__(self, event: T.StructType, version: T.StructType):
        self.event, self.version = event, version
        self.made = Row(*event.names, *version.names, "version_us")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.versions = handle.getMapState("versions", "at bigint", self.version)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        events, none = [], (None,) * len(self.version.names)
        for row in rows:
            if row["is_event"]:
                events.append((row["at"], tuple(row[n] for n in self.event.names)))
            else:
                own = (row["at"],)
                new = tuple(row[n] for n in self.version.names)
                old = tuple(self.versions.getValue(own)) if self.versions.containsKey(own) else None
                if old is None or _order(new) > _order(old):
                    self.versions.updateValue(own, new)
        known = sorted((k[0], tuple(v)) for k, v in self.versions.iterator())
        times = [t for t, _ in known]
        for at, own in events:
            i = bisect_right(times, at) - 1
            yield self.made(*own, *(known[i][1] if i >= 0 else none), times[i] if i >= 0 else None)
        # Of the versions before the watermark the newest one can still be asked for.
        passed = bisect_right(times, timerValues.getCurrentWatermarkInMs() * 1000)
        for t in times[: max(passed - 1, 0)]:
            self.versions.removeKey((t,))

    def close(self) -> None:
        pass


def _order(values: tuple) -> list:
    """Nulls first, then by value: which of two versions of one time counts."""
    return [(x is not None, x if x is not None else 0) for x in values]


def stream_as_of(events: DataFrame, versions: DataFrame, key: str, time: str, version_key: str | None = None, version_time: str | None = None, columns: Sequence[str] | None = None, lateness: str = "0 seconds") -> DataFrame:
    """``as_of`` of two streams: an event takes the newest version that came no later than its micro-batch, at or before its time.

    So results hold for versions that arrive in time; ``lateness`` is how long replaced versions
    are kept for late events. Rows with a null key or time are left out. It needs the RocksDB state store.
    """
    other, at = version_key or key, version_time or time
    names = list(columns or [c for c in versions.columns if c not in (other, at)])
    # Microseconds are no event time to Spark, which so drops no late row unseen.
    sides = []
    for df, own_key, own_time, kept, part in ((watermark(events, time, lateness), key, time, events.columns, "e"), (watermark(versions, at, lateness), other, at, names, "v")):
        micros = F.unix_micros(own_time)
        own = [(F.timestamp_micros(micros) if c == own_time else F.col(c)).alias(f"{part}{i}") for i, c in enumerate(kept)]
        sides.append(df.where(F.col(own_key).isNotNull() & F.col(own_time).isNotNull()).select(F.col(own_key).alias("k"), micros.alias("at"), F.lit(part == "e").alias("is_event"), *own))
    kinds = [T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields[3:]]) for df in sides]
    output = T.StructType([*kinds[0].fields, *kinds[1].fields, T.StructField("version_us", T.LongType())])
    found = sides[0].unionByName(sides[1], allowMissingColumns=True).groupBy("k").transformWithState(VersionLookup(*kinds), output, outputMode="Append", timeMode="EventTime")
    return found.select(*[F.col(f"e{i}").alias(c) for i, c in enumerate(events.columns)], *[F.col(f"v{i}").alias(c) for i, c in enumerate(names)], F.timestamp_micros("version_us").alias("version_time"))

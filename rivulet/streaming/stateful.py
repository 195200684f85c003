"""Window metrics as a stateful processor with event-time timers.

``vehicle_metrics`` is the right way for these metrics; this is the general form, for
state that no built-in aggregate has. It needs the RocksDB state store.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
OUTPUT = "vehicle_id string, window_start timestamp, max_timestamp timestamp, max_temperature double, max_vibration double, avg_mileage bigint"
_STATE = "latest bigint, temperature double, vibration double, mileage double, n bigint"


class WindowMetrics(StatefulProcessor):
    """Accumulates by window; a timer at each window's end emits its row and clears its state."""

    def __init__(self, seconds: int = 60):
        self.seconds = seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.windows = handle.getMapState("windows", "start bigint", _STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        size = self.seconds * 1000
        for frame in rows:
            ms = frame["event_time"].astype("int64") // (10**6 if str(frame["event_time"].dtype).startswith("datetime64[ns") else 10**3)
            for start, part in frame.assign(ms=ms, start=ms // size * size).groupby("start"):
                if start + size <= timerValues.getCurrentWatermarkInMs():
                    continue  # late: its window has gone
                new = (int(part["ms"].max()), float(part["temperature"].max()), float(part["vibration"].max()), float(part["mileage"].sum()), len(part))
                if self.windows.containsKey((int(start),)):
                    old = self.windows.getValue((int(start),))
                    new = (max(old[0], new[0]), max(old[1], new[1]), max(old[2], new[2]), old[3] + new[3], old[4] + new[4])
                else:
                    self.handle.registerTimer(int(start) + size)
                self.windows.updateValue((int(start),), new)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        start = expiredTimerInfo.getExpiryTimeInMs() - self.seconds * 1000
        latest, temperature, vibration, mileage, n = self.windows.getValue((start,))
        self.windows.removeKey((start,))
        yield pd.DataFrame(
            {
                "vehicle_id": [key[0]], "window_start": [pd.Timestamp(start, unit="ms")], "max_timestamp": [pd.Timestamp(latest, unit="ms")],
                "max_temperature": [temperature], "max_vibration": [vibration], "avg_mileage": [int(mileage / n) if n else 0],
            }
        )

    def close(self) -> None:
        pass


def stateful_metrics(events: DataFrame, seconds: int = 60) -> DataFrame:
    """Metrics of a stream of (vehicle_id, event_time, temperature, vibration, mileage) with a watermark."""
    return events.groupBy("vehicle_id").transformWithStateInPandas(
        statefulProcessor=WindowMetrics(seconds), outputStructType=OUTPUT, outputMode="Append", timeMode="EventTime"
    )

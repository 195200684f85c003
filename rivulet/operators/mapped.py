"""Models whose weights are one read-only file a machine.

The weights lie in one Arrow file, which Spark ships to every executor's machine once (``addFile``). Python
workers map it into memory: however many workers run, its pages are resident once, and loading reads nothing ahead.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Callable, Iterable, Mapping, Sequence
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import SparkSession

ALIGN = 64
_SCHEMA = pa.schema([("name", pa.string()), ("dtype", pa.string()), ("shape", pa.list_(pa.int64())), ("data", pa.large_binary())])


def write_arrays(arrays: Mapping[str, np.ndarray], path: str) -> None:
    """Write named arrays into one file, each at a place that its numbers are aligned at."""
    held = [np.ascontiguousarray(a) for a in arrays.values()]
    if any(a.dtype.hasobject for a in held):
        raise TypeError("arrays of objects cannot be mapped")
    data = [a.tobytes() + bytes(-a.nbytes % ALIGN) for a in held]
    columns = [pa.array(list(arrays), pa.string()), pa.array([a.dtype.str for a in held], pa.string()), pa.array([list(a.shape) for a in held], pa.list_(pa.int64())), pa.array(data, pa.large_binary())]
    with pa.OSFile(path, "wb") as sink, pa.ipc.new_file(sink, _SCHEMA) as writer:
        writer.write_batch(pa.record_batch(columns, schema=_SCHEMA))


def map_arrays(path: str) -> dict[str, np.ndarray]:
    """The arrays of a file, mapped and not copied; they can't be written to."""
    batch = pa.ipc.open_file(pa.memory_map(path, "r")).get_batch(0)
    _, places, data = batch.column(3).buffers()  # a scalar of it would be a copy
    offsets = np.frombuffer(places, dtype=np.int64)
    out = {}
    for i in range(batch.num_rows):
        name, kind, shape = (batch.column(c)[i].as_py() for c in range(3))
        count = int(np.prod(shape, dtype=np.int64))
        own = np.frombuffer(data, dtype=np.dtype(kind), count=count, offset=int(offsets[i])) if count else np.zeros(0, np.dtype(kind))
        out[name] = own.reshape(shape)
    return out


def ship(spark: SparkSession, arrays: Mapping[str, np.ndarray], name: str) -> str:
    """Make ``arrays`` a file that every executor has, and give its name for ``MappedHandler``."""
    folder = tempfile.mkdtemp(prefix="weights-")  # of the driver's machine, from which Spark serves it
    path = os.path.join(folder, name)
    write_arrays(arrays, path)
    spark.sparkContext.addFile(path)
    return name


class MappedHandler:
    """A model handler over shipped weights: ``make`` turns the mapped arrays into a model, ``run`` asks it."""

    def __init__(self, weights: str, make: Callable[[dict[str, np.ndarray]], Any], run: Callable[[Sequence[str], Any], Iterable[str]], model_id: str):
        self.weights, self.make, self.run, self.model_id = weights, make, run, model_id

    def load_model(self) -> Any:
        return self.make(map_arrays(SparkFiles.get(self.weights)))

    def run_inference(self, batch: Sequence[str], model: Any) -> Iterable[str]:
        return self.run(batch, model)

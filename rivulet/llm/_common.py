"""Shared Spark and NumPy helpers of the llm operators.

Everything text-shaped works on the UTF-8 bytes that Arrow hands to a Python
worker: words are found with byte tables, hashed and rolled into n-gram hashes
with whole-array NumPy operations, in slices of about ``SLICE_BYTES`` so that a
worker's memory does not depend on the size of an Arrow batch.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 18

#: Membership filters have ``CELLS`` cells a member, rounded up to a power of two, from 2**20 to 2**MOST_BITS (8 MiB).
#: With more members than ``FULL`` of the cells a filter would let most rows through and is left out.
CELLS, LEAST_BITS, MOST_BITS, FULL = 16, 20, 26, 0.5

#: Shuffle files of an execution go with it instead of when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 1 << 21

_U = np.uint64
_MULT = _U(0x9E3779B97F4A7C15)
_GRAM = _U(0xD6E8FEB86659FD93)


# --------------------------------------------------------------- Spark helpers


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared checkpoint folder.

    The folder is the session's ``spark.checkpoint.dir``. Where that is unset, a session on
    one machine (tests, a laptop) gets a temporary one; a cluster must name it. Checkpoint
    files go when the driver forgets them, if ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set. What was
    shuffled for a checkpoint is never read again and goes at its end.
    """
    shared_folder(df.sparkSession)
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        return df.select("*").checkpoint(eager=True)  # an execution of its own, which begins with this setting
    finally:
        conf.unset(CLEANUP) if before is None else conf.set(CLEANUP, before)


def small_batches(spark: SparkSession, most: int = BATCH_BYTES) -> None:
    """Arrow batches of about ``most`` bytes from now on, unless the session has a bound of its own. By default 10,000 rows are
    one; a task holds a batch on either side and on its way in both directions, and what it needs should not grow with the rows."""
    if int(spark.conf.get(BATCH, None) or 0) <= 0:
        spark.conf.set(BATCH, str(most))


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder; made on a session of one machine that has none."""
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not found:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="checkpoint-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(found)
    return found


def hashed_sample(df: DataFrame, key: str, most: int, total: int) -> DataFrame:
    """The ``most`` rows of smallest key hash. ``total``, the rows of ``df``, bounds beforehand which
    hashes can be among them, so that few more rows than that meet in the final top-k."""
    h = F.pmod(F.xxhash64(key), F.lit(1 << 31))
    if total > 2 * most:
        df = df.where(h < int((1 << 31) * (2 * most / total)))
    return df.orderBy(h, key).limit(most)


def row_key(*cols: str):
    """A key of a row's own content, nulls included: rows with equal content share their result."""
    return F.xxhash64(*[x for c in cols for x in (F.col(c), F.col(c).isNull())])


def numbered_columns(df: DataFrame, *names: str) -> tuple[DataFrame, list[str]]:
    """``df`` with its columns named by their places, so that none clashes with an operator's own, and the new names of
    ``names``; ``toDF(*df.columns)`` names them back."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))]), [f"c{df.columns.index(n)}" for n in names]


def filter_bits(members: int) -> int:
    return min(max((CELLS * max(members, 1) - 1).bit_length(), LEAST_BITS), MOST_BITS)


def member_filter(df: DataFrame, hash_col: str, members: int | None = None) -> np.ndarray:
    """One-hash Bloom filter of a 64-bit column as a boolean array, sized by its rows (``members``, else counted).

    Built by a grouped ``bit_or``; at most ``2**MOST_BITS / 32`` rows reach the driver. With
    more members than it has room for it lets more rows through; the join behind it stays exact.
    """
    bits = filter_bits(df.count() if members is None else members)
    cell = F.col(hash_col).bitwiseAND(F.lit((1 << bits) - 1))
    words = (
        df.where(F.col(hash_col).isNotNull())
        .select(F.shiftright(cell, 5).cast("int").alias("w"), F.expr(f"shiftleft(1L, cast({hash_col} & 31L as int))").alias("b"))
        .groupBy("w")
        .agg(F.bit_or("b").alias("b"))
        .toArrow()
    )
    out = np.zeros(1 << (bits - 5), dtype=np.uint32)
    out[words.column("w").to_numpy()] = words.column("b").to_numpy().astype(np.uint32)
    return np.unpackbits(out.view(np.uint8), bitorder="little").astype(bool)


class PackedFilter:
    """``member_filter`` packed for shipping inside a task's closure."""

    def __init__(self, cells: np.ndarray):
        self.packed, self.mask, self.any = np.packbits(cells), len(cells) - 1, bool(cells.any())

    def cells(self) -> np.ndarray:
        return np.unpackbits(self.packed).astype(bool)


def maybe_members(df: DataFrame, key, members: DataFrame) -> DataFrame:
    """``df`` with __maybe: false only for rows whose 64-bit key is not in ``members`` (one column, materialised).

    The same filter as ``member_filter``, as a table of at most ``2**MOST_BITS / 64`` rows (16 MB), which
    is what bounds its broadcast; nothing of ``df`` is shuffled. With too many members for it,
    every row may be one.
    """
    count = members.count()
    bits = filter_bits(count)
    if count > FULL * (1 << bits):
        return df.withColumn("__maybe", key.isNotNull())
    name = members.columns[0]
    cell = F.col(name).bitwiseAND(F.lit((1 << bits) - 1))
    words = members.where(F.col(name).isNotNull()).select(F.shiftright(cell, 6).cast("int").alias("__w"), F.expr(f"shiftleft(1L, cast(`{name}` & 63L as int))").alias("__b"))
    table_ = materialize(words.groupBy("__w").agg(F.bit_or("__b").alias("__b")))
    celled = df.withColumn("__cell", key.bitwiseAND(F.lit((1 << bits) - 1)))
    joined = celled.join(F.broadcast(table_), F.shiftright("__cell", 6).cast("int") == F.col("__w"), "left")
    hit = F.call_function("getbit", F.coalesce("__b", F.lit(0)), F.col("__cell").bitwiseAND(F.lit(63)).cast("int")) == 1
    return joined.withColumn("__maybe", F.coalesce(hit, F.lit(False))).drop("__cell", "__w", "__b")


def without(df: DataFrame, key, gone: DataFrame) -> DataFrame:
    """The rows of ``df`` whose key is not in ``gone`` (one column, materialised). Only rows that may be in it are shuffled."""
    name = gone.columns[0]
    marked = maybe_members(df, key, gone)
    other = gone.select(F.col(name).alias("__gone")).distinct()
    rest = marked.where("__maybe").join(other, key == F.col("__gone"), "left_anti")
    return marked.where("not __maybe").union(rest).drop("__maybe")


# --------------------------------------------------------------- bytes to words

#: Words of op1: runs of ASCII digits, letters and every byte of a non-ASCII character.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

#: Words between ASCII white space: everything but space and 0x09 to 0x0D.
NONSPACE = np.ones(256, dtype=bool)
NONSPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

#: Lower-cases A-Z and leaves all else.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply and xor-shift), so that every bit counts."""
    x = x ^ (x >> _U(32))
    x = x * _MULT
    x = x ^ (x >> _U(29))
    x = x * _GRAM
    return x ^ (x >> _U(32))


_BYTE_HASH = mix(np.arange(1, 257, dtype=np.uint64) * _MULT)
_powers = np.ones(1, dtype=np.uint64)


def powers(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        size = 1 << max(6, int(n - 1).bit_length())
        _powers = np.cumprod(np.concatenate([[_U(1)], np.full(size - 1, _MULT, dtype=np.uint64)]), dtype=np.uint64)
    return _powers


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column and its n + 1 offsets; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if large else np.int32
    buffers = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(buffers[1], dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data, offsets


def slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes, or of one row if that is longer."""
    n, at = len(offsets) - 1, 0
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1
        end = min(max(end, at + 1), n)
        yield at, end
        at = end


class Words:
    """Words of a slice of texts: byte spans, 64-bit hashes and word offsets by text."""

    __slots__ = ("bytes", "counts", "ends", "hashes", "offsets", "starts", "text_of")

    def __init__(self, data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray, hashes: bool = True):
        base = offsets[0]
        d = data[base : offsets[-1]]
        own = offsets - base
        inside = is_word[d]
        before = np.empty_like(inside)
        after = np.empty_like(inside)
        if len(d):
            before[0], after[-1] = False, False
            before[1:], after[:-1] = inside[:-1], inside[1:]
            edges = own[1:-1]
            before[edges[edges < len(d)]] = False
            after[edges[edges > 0] - 1] = False
        self.bytes = d
        self.starts = np.flatnonzero(inside & ~before)
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.offsets = np.searchsorted(self.starts, own)
        self.counts = np.diff(self.offsets)
        self.text_of = np.repeat(np.arange(len(self.counts)), self.counts)
        self.hashes = None
        if hashes:
            lens = self.ends - self.starts
            if len(lens):
                letters = FOLD[d[inside]]
                first = np.cumsum(lens) - lens
                place = np.arange(len(letters)) - np.repeat(first, lens)
                values = _BYTE_HASH[letters]
                values *= powers(int(lens.max()))[place]
                self.hashes = mix(np.add.reduceat(values, first) + lens.astype(np.uint64))
            else:
                self.hashes = np.zeros(0, dtype=np.uint64)

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the k-grams that lie in one text, and the word index where each starts."""
        n = len(self.hashes) - k + 1
        if n <= 0:
            return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        total = self.hashes[:n].copy()
        factor = _GRAM
        with np.errstate(over="ignore"):
            for j in range(1, k):
                total += self.hashes[j : n + j] * factor
                factor = factor * _GRAM
        at = np.flatnonzero(self.text_of[:n] == self.text_of[k - 1 :])
        return mix(total[at]), at


def winnow(grams: np.ndarray, group: np.ndarray, window: int) -> np.ndarray:
    """Indexes of the grams that are the right-most minimum of some window.

    ``group`` numbers the text of each gram, ascending. A text with fewer grams
    than ``window`` has one window, all of them.
    """
    n = len(grams)
    if n == 0:
        return np.zeros(0, dtype=np.int64)
    left = np.zeros(n, dtype=np.int16)
    right = np.zeros(n, dtype=np.int16)
    going_left = np.ones(n, dtype=bool)
    going_right = np.ones(n, dtype=bool)
    for d in range(1, min(window, n)):
        same = group[d:] == group[:-d]
        not_less = grams[:-d] >= grams[d:]
        going_left[:d] = False
        going_left[d:] &= same & not_less
        left += going_left
        going_right[n - d :] = False
        going_right[:-d] &= same & ~not_less
        right += going_right
    first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    sizes = np.diff(np.append(first, n))
    need = np.repeat(np.minimum(sizes, window), sizes)
    return np.flatnonzero(left + right + 1 >= need)


def as_long(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def long_list(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(np.ascontiguousarray(values).view(np.int64)))

"""Importance resampling of documents towards a target distribution (operator 13).

Features are runs of one to ``most_words`` words, hashed to ``buckets`` by the CRC-32 of
their bytes. The first pass counts buckets: ``np.bincount`` gives each Arrow partition one
vector of ``buckets`` numbers, and ``treeReduce`` adds these up on the executors, so that the
driver receives a few vectors however many partitions there are. The corpus vector and
the target vector give each bucket its gain, the logarithm of how much likelier the target
is to show it. The second pass gathers the gains (broadcast, ``buckets`` integers) of a
document's features and sums them with ``np.bincount`` weights. A Gumbel number, made
from a hash of seed and id, is added to the weight, so that the highest scores are a draw
without replacement with these weights.

Ranks are those of a range-partitioned sort of (long enough, score, id), numbered within
each partition and shifted by the rows of the partitions before; only narrow rows are sorted.

Texts are worked on in slices, very long ones in pieces cut between words, so that a worker's
memory depends on neither. Words longer than ``LONG`` bytes are hashed one by one.

Defined results: a null or empty text has no words, no features and weight 0; a null id counts as the
empty string in the draw and comes after the others among equal scores; repeated rows are each counted,
scored and ranked (repeated ids share the random part); with no documents or no target the formulas
hold with sums of 0; other columns, whatever their names, are ignored by ``scores`` and kept by ``draw``.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import ALNUM, FOLD, SLICE_BYTES, Words, materialize, slices, text_bytes

BUCKETS = 10000
SEED = "2024"
PERCENT = 10
LEAST_WORDS = 20
#: Bytes of a word up to which words are hashed together, a byte of each at a time.
LONG = 48
#: Vectors that one reducing task adds up.
FAN_IN = 32


def _crc_table() -> np.ndarray:
    value = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        value = (value >> np.uint32(1)) ^ np.where(value & np.uint32(1), np.uint32(0xEDB88320), np.uint32(0))
    return value


_CRC = _crc_table()


def _crc_more(crc: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The CRC-32 of what ``crc`` stands for followed by the folded bytes of each span."""
    lens = ends - starts
    register = ~crc
    order = np.argsort(-np.minimum(lens, LONG + 1), kind="stable")
    begin, length = starts[order], lens[order]
    long = int(np.searchsorted(-length, -LONG, side="left"))  # those above LONG come first
    state, at = register[order], begin
    most = int(length[long]) if long < len(length) else 0
    for j in range(most):
        end = int(np.searchsorted(-length[long:], -j, side="left")) + long
        part = state[long:end]
        state[long:end] = _CRC[(part ^ FOLD[data[at[long:end] + j]]) & np.uint32(0xFF)] ^ (part >> np.uint32(8))
    for i in range(long):
        state[i] = ~np.uint32(zlib.crc32(FOLD[data[begin[i] : begin[i] + length[i]]].tobytes(), int(~state[i])))
    out = np.empty_like(state)
    out[order] = state
    return ~out


def _features(words: Words, most_words: int, buckets: int, own: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket, text) of all runs of 1 to ``most_words`` words that start at one of the first ``own`` words."""
    n = len(words.starts)
    crc = np.zeros(n, dtype=np.uint32)
    space = np.frombuffer(b" ", dtype=np.uint8)
    for k in range(most_words):
        m = min(n - k, own)
        if m <= 0:
            return
        crc = crc[:m]
        if k:
            zero = np.zeros(m, np.int64)
            crc = _crc_more(crc, space, zero, zero + 1)
        crc = _crc_more(crc, words.bytes, words.starts[k : k + m], words.ends[k : k + m])
        whole = words.text_of[:m] == words.text_of[k : k + m]
        yield (crc[whole] % np.uint32(buckets)).astype(np.int64), words.text_of[:m][whole]


def _parts(data: np.ndarray, offsets: np.ndarray, most_words: int) -> Iterator[tuple[int, np.ndarray, int]]:
    """(first text, offsets, end of what is new) of slices; a long text comes in pieces that are cut
    after a byte of no word and reach ``most_words`` - 1 words into what follows."""
    for a, b in slices(offsets):
        if offsets[b] - offsets[a] <= 2 * SLICE_BYTES:
            yield a, offsets[a : b + 1], int(offsets[b])
            continue
        at, last = int(offsets[a]), int(offsets[b])
        while at < last:
            cut = _after(data, at + SLICE_BYTES, last)
            end = cut
            for _ in range(most_words - 1):
                while end < last and not ALNUM[data[end]]:
                    end += 1
                end = _after(data, end, last)
            yield a, np.array([at, end]), cut
            at = cut


def _after(data: np.ndarray, at: int, last: int) -> int:
    """The first place from ``at`` on that no word spans."""
    while at < last:
        gap = np.flatnonzero(~ALNUM[data[at : min(at + 4096, last)]])
        if len(gap):
            return at + int(gap[0])
        at += 4096
    return last


def bucket_counts(rows: DataFrame, text: str = "text", most_words: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket."""

    def count(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            data, offsets = text_bytes(batch.column(0))
            for _, own, cut in _parts(data, offsets, most_words):
                words = Words(data, own, ALNUM, hashes=False)
                for bucket, _ in _features(words, most_words, buckets, int(np.searchsorted(words.starts, cut - own[0]))):
                    total += np.bincount(bucket, minlength=buckets)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["counts"])

    vectors = rows.select(F.col(text).cast("string").alias("text")).mapInArrow(count, "counts binary").rdd.map(lambda r: np.frombuffer(bytes(r[0]), np.int64))
    parts = vectors.getNumPartitions()
    if not parts:
        return np.zeros(buckets, np.int64)
    return vectors.treeReduce(lambda x, y: x + y, depth=max(2, math.ceil(math.log(parts, FAN_IN))))


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Each bucket's gain in thousandths; both vectors count features of the same buckets."""
    size, every, wanted = len(corpus), float(corpus.sum() + len(corpus)), float(target.sum() + len(target))
    return np.array([math.floor(1000 * math.log((float(target[i]) + 1) * every / ((float(corpus[i]) + 1) * wanted))) for i in range(size)], dtype=np.int64)


def weights(docs: DataFrame, gain: np.ndarray, doc_id: str = "doc_id", text: str = "text", most_words: int = 1) -> DataFrame:
    """id, n_words, n_features and weight (sum of its features' gains) of each row."""
    buckets = len(gain)
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def weigh(batches):
        gain = shared.value.astype(np.float64)
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            n = len(offsets) - 1
            found, features, weight = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.float64)
            for a, own, cut in _parts(data, offsets, most_words):
                words, b = Words(data, own, ALNUM, hashes=False), a + len(own) - 1
                first = int(np.searchsorted(words.starts, cut - own[0]))
                found[a:b] += np.bincount(words.text_of[:first], minlength=b - a)
                for bucket, row in _features(words, most_words, buckets, first):
                    features[a:b] += np.bincount(row, minlength=b - a)
                    weight[a:b] += np.bincount(row, weights=gain[bucket], minlength=b - a)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found), pa.array(features), pa.array(np.rint(weight).astype(np.int64))], names=["id", "n_words", "n_features", "weight"])

    key_type = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text")).mapInArrow(weigh, f"id {key_type}, n_words bigint, n_features bigint, weight bigint")


def scored(weighted: DataFrame, seed: str = SEED) -> DataFrame:
    """``weighted`` with score: its weight and a Gumbel number (thousandths) of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    uniform = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") + F.lit(0.5)) / F.lit(4294967296.0)
    return weighted.withColumn("score", F.col("weight") + F.floor(F.lit(-1000.0) * F.log(-F.log(uniform))))


def ranked(rows: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """``rows`` with rank: 1, 2, 3 for the highest scores of those with ``least_words`` words, as
    many as ``percent`` of these rows; null for the others. Rows with equal score and id are in any order."""
    rows = materialize(rows.withColumn("drawable", F.col("n_words") >= least_words))
    most = percent * rows.where("drawable").count() // 100
    order = [F.desc("drawable"), F.desc("score"), F.asc_nulls_last("id")]
    dealt = materialize(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()))
    part = F.shiftright("at", 33).alias("part")
    sizes = sorted((r.part, r["count"]) for r in dealt.groupBy(part).count().collect())  # a row a partition
    before, shifts = 0, []
    for number, size in sizes:
        shifts.append((number, before))
        before += size
    shift = rows.sparkSession.createDataFrame(shifts, "part bigint, before bigint")
    place = F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    joined = dealt.withColumn("part", part).join(F.broadcast(shift), "part", "left")
    return joined.withColumn("rank", F.when(F.col("drawable") & (place <= most), place)).drop("part", "before", "at", "drawable")


def scores(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", target_text: str = "text", most_words: int = 1, buckets: int = BUCKETS, seed: str = SEED, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """id, n_words, n_features, weight, score and rank of each row of ``docs``."""
    gain = gains(bucket_counts(docs, text, most_words, buckets), bucket_counts(target, target_text, most_words, buckets))
    return ranked(scored(weights(docs, gain, doc_id, text, most_words), seed), percent, least_words).withColumnRenamed("id", doc_id)


def draw(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """The drawn rows of ``docs`` with all their columns. Rows that share an id come together if one of them is drawn."""
    drawn = scores(docs, target, doc_id, **options).where("rank is not null").select(F.col(doc_id).alias("drawn")).distinct()
    return docs.join(drawn, docs[doc_id].eqNullSafe(drawn["drawn"]), "left_semi")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op13: weight, score and rank of every document towards the benchmark texts."""
    docs, target = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return scores(docs, target).select("doc_id", "n_features", "weight", "score", "rank")


#: From the definition, over distinct words; CRC-32 by its table of 256, which the first CTE makes.
ORACLE_SQL = r"""
WITH RECURSIVE bits AS (
  SELECT i, CAST(i AS BIGINT) AS v, 0 AS step FROM range(256) r(i)
  UNION ALL SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, step + 1 FROM bits WHERE step < 8),
crc AS (SELECT list(v ORDER BY i) AS t FROM bits WHERE step = 8),
texts AS (SELECT doc_id, text, 'd' AS side FROM documents UNION ALL SELECT NULL, text, 'b' FROM benchmark),
numbered AS (SELECT *, row_number() OVER () AS r FROM texts),
w AS (
  SELECT side, r, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
  FROM numbered),
n AS (SELECT side, r, word, count(*) AS n FROM w GROUP BY ALL),
h AS (
  SELECT word, xor(list_reduce(list_transform(range(0, strlen(word)), lambda i: CAST('0x' || substr(hex(word), 2 * i + 1, 2) AS BIGINT)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT word FROM n), crc),
sums AS (SELECT side, bucket, sum(n) AS n FROM n JOIN h USING (word) GROUP BY ALL),
total AS (SELECT coalesce(sum(n) FILTER (side = 'd'), 0) AS s, coalesce(sum(n) FILTER (side = 'b'), 0) AS t FROM sums),
gain AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST(coalesce(b.n, 0) + 1 AS DOUBLE) * CAST(total.s + 10000 AS DOUBLE) / (CAST(coalesce(d.n, 0) + 1 AS DOUBLE) * CAST(total.t + 10000 AS DOUBLE)))) AS BIGINT) AS gain
  FROM (SELECT * FROM sums WHERE side = 'd') d FULL JOIN (SELECT * FROM sums WHERE side = 'b') b USING (bucket), total),
weighed AS (SELECT r, sum(n) AS n_features, sum(n * gain) AS weight FROM n JOIN h USING (word) JOIN gain USING (bucket) WHERE side = 'd' GROUP BY r),
scored AS (
  SELECT doc_id, r, CAST(coalesce(n_features, 0) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
    CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5) / 4294967296.0::DOUBLE))) AS BIGINT) AS score
  FROM numbered LEFT JOIN weighed USING (r) WHERE side = 'd'),
drawn AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 10 * n // 100 THEN rank END AS rank FROM scored LEFT JOIN drawn USING (r)
"""

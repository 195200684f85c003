"""Benchmark decontamination by winnowing (operator 1).

Both corpora are reduced to fingerprints: the right-most minimum of every window
of ``span - k + 1`` consecutive k-gram hashes. A run of ``span`` words that a
document shares with an item has the same windows in both, so both keep the same
k-gram of it: no shared run of ``span`` words goes unseen. Fingerprints meet in the join
if a window of ``span`` words around them is the same, so a phrase that many documents and
items hold among other words brings none of them together. They are then extended to both sides,
word by word, as far as ``span - k`` words; that is the shared run.

Items shorter than ``span`` words are one window each. Their length m is a class
of its own with k = m and a window of one, so that each m-gram is a fingerprint.

A filter made from the item fingerprints, sized by their number, keeps most
document fingerprints from leaving the Python worker; the join behind it is exact
and is left to Catalyst, which broadcasts the item side only if it is small.

Defined results: a null or empty text has no words and no hits; repeated rows each
get their own, equal result; items of no words or null text never occur; equal
items all count; items with a null id hit as others do and are one null among the
items; columns beside id and text are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import ALNUM, PackedFilter, Words, materialize, member_filter, mix, numbered_columns, row_key, slices, text_bytes, winnow, without

SPAN = 10
K = 5


def _context_names(reach: int) -> list[str]:
    return [f"{side}{j}" for side in "lr" for j in range(1, reach + 1)]


def _prints(words: Words, span: int, k: int, short: list[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(class, hashes, word index) of the fingerprints; class 0 is that of long items."""
    grams, at = words.grams(k)
    keep = winnow(grams, words.text_of[at], span - k + 1)
    yield 0, grams[keep], at[keep]
    for m in short:
        yield (m, *words.grams(m))


def _context(words: Words, at: np.ndarray, k: int, reach: int, missing: int) -> list[np.ndarray]:
    """Hashes of the words left and right of a k-gram, nearest first."""
    out, text, n = [], words.text_of[at], len(words.hashes)
    for step in [*range(-1, -reach - 1, -1), *range(k, k + reach)]:
        j = at + step
        ok = (j >= 0) & (j < n)
        j = np.clip(j, 0, max(n - 1, 0))
        ok &= words.text_of[j] == text
        out.append(np.where(ok, words.hashes[j].view(np.int64), missing))
    return out


def _windows(h: np.ndarray, context: list[np.ndarray], missing: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, whether it is whole) of the windows that hold a k-gram, a column for each number of words before it:
    from the k-gram's hash and those of the words around, ``missing`` where the text has none."""
    reach = len(context) // 2
    left, right = context[:reach], context[reach:]
    hashes = np.zeros((len(h), reach + 1), np.uint64)
    whole = np.ones((len(h), reach + 1), dtype=bool)
    for j in range(reach + 1):
        value = mix(h.view(np.uint64) + np.uint64(j + 1))
        for word in [*left[:j], *right[: reach - j]]:
            value = mix(value + word.view(np.uint64))
            whole[:, j] &= word != missing
        hashes[:, j] = value
    return hashes, whole


def _table(columns: list[list[np.ndarray]], names: list[str], ids: pa.Array, rows: list[np.ndarray], key: str) -> pa.RecordBatch:
    flat = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in columns]
    index = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    return pa.RecordBatch.from_arrays([ids.take(pa.array(index)), *[pa.array(c.astype(np.int64, copy=False)) for c in flat]], names=[key, *names])


def item_fingerprints(items: DataFrame, item_id: str = "item_id", text: str = "text", span: int = SPAN, k: int = K) -> DataFrame:
    """(class, hash, context, item) of every item, by winnowing."""
    reach = span - k
    names = ["cls", "h", *_context_names(reach)]

    def fingerprint(batches):
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for a, b in slices(offsets):
                words = Words(data, offsets[a : b + 1], ALNUM)
                columns, rows = [[] for _ in names], []
                lengths = words.counts[words.text_of]
                for cls, hashes, at in _prints(words, span, k, sorted(set(words.counts[(words.counts > 0) & (words.counts < span)].tolist()))):
                    ok = lengths[at] >= span if cls == 0 else lengths[at] == cls
                    hashes, at = hashes[ok], at[ok]
                    context = _context(words, at, k, reach, -1) if cls == 0 else [np.full(len(at), -1)] * (2 * reach)
                    for c, v in zip(columns, [np.full(len(at), cls), hashes.view(np.int64), *context], strict=True):
                        c.append(v)
                    rows.append(words.text_of[at] + a)
                yield _table(columns, names, batch.column(0), rows, "item_id")

    key_type = items.schema[item_id].dataType.simpleString()
    schema = f"item_id {key_type}, " + ", ".join(f"{n} {'int' if n == 'cls' else 'bigint'}" for n in names)
    as_declared = ", ".join(f"{n} bigint" for n in names)
    out = items.select(F.col(item_id).alias("item_id"), F.col(text).cast("string").alias("text")).mapInArrow(fingerprint, f"item_id {key_type}, {as_declared}")
    return out.select(*[F.col(f.split()[0]).cast(f.split()[1]) for f in schema.split(", ")])


def hits(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", span: int = SPAN, k: int = K) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(base, spans, owners). base: _key, doc_id and n_words of each row of ``docs``.
    spans: _key, first and after (word indexes) and fid, the number of the fingerprint that was hit;
    one row for each run and hit. owners: fid and item_id of the items that have the fingerprint."""
    reach = span - k
    names = _context_names(reach)
    keys = ["cls", "h", *names]
    prints = materialize(item_fingerprints(items, item_id, item_text, span, k))
    numbered = materialize(prints.select(*keys).distinct().withColumn("fid", F.monotonically_increasing_id()))
    owners = materialize(prints.join(numbered, keys).select("fid", "item_id").distinct())

    def held(batches):
        """The windows of each fingerprint; one of a short item is its own window."""
        for batch in batches:
            cls, h, *context = (c.to_numpy() for c in batch.columns[:-1])
            hashes, whole = _windows(h, context, -1)
            hashes[cls > 0, 0] = (h + cls)[cls > 0].view(np.uint64)
            whole[cls > 0] = np.arange(reach + 1) == 0
            row, j = np.nonzero(whole)
            yield pa.RecordBatch.from_arrays([pa.array(hashes[row, j].view(np.int64)), pa.array(j), *[c.take(pa.array(row)) for c in batch.columns]], names=windowed)

    windowed = ["i_w", "i_j", *[f"i_{n}" for n in keys], "fid"]
    other = materialize(numbered.select(F.col("cls").cast("bigint"), *keys[1:], "fid").mapInArrow(held, ", ".join(f"{n} bigint" for n in windowed)))
    around = PackedFilter(member_filter(other, "i_w"))
    short = [r.cls for r in prints.where("cls > 0").select("cls").distinct().collect()]  # below span values at most
    marked = prints.select(F.expr("h + cls").alias("h"))
    member = PackedFilter(member_filter(marked, "h"))
    key_type = docs.schema[doc_id].dataType.simpleString()

    def fingerprint(batches):
        cells, wide = member.cells(), around.cells()
        for batch in batches:
            data, offsets = text_bytes(batch.column(2))
            for a, b in slices(offsets):
                words = Words(data, offsets[a : b + 1], ALNUM)
                n = b - a
                columns, rows = [[np.full(n, -1)], [words.counts], [np.zeros(n, np.int64)], *[[np.zeros(n, np.int64)] for _ in ["w", "j", *names]]], [np.arange(a, b)]
                for cls, hashes, at in _prints(words, span, k, short) if member.any else ():
                    ok = np.flatnonzero(cells[(hashes + np.uint64(cls)) & np.uint64(member.mask)])
                    hashes, at = hashes[ok], at[ok]
                    if cls == 0:  # of a fingerprint those windows that an item has as well
                        context = _context(words, at, k, reach, 0)
                        w, whole = _windows(hashes, context, 0)
                        row, j = np.nonzero(whole & wide[w & np.uint64(around.mask)])
                        at, w, context = at[row], w[row, j], [c[row] for c in context]
                    else:
                        w, j, context = hashes + np.uint64(cls), np.zeros(len(at), np.int64), [np.zeros(len(at), np.int64)] * (2 * reach)
                    for c, v in zip(columns, [np.full(len(at), cls), np.zeros(len(at), np.int64), at - words.offsets[words.text_of[at]], w.view(np.int64), j, *context], strict=True):
                        c.append(v)
                    rows.append(words.text_of[at] + a)
                index = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(index), batch.column(1).take(index), *[pa.array(np.concatenate(c).astype(np.int64, copy=False)) for c in columns]], names=["_key", "doc_id", "cls", "n_words", "pos", "w", "j", *names])

    fields = "_key bigint, doc_id " + key_type + ", " + ", ".join(f"{n} bigint" for n in ["cls", "n_words", "pos", "w", "j", *names])
    source = docs.select(row_key(doc_id, text).alias("_key"), F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    found = materialize(source.mapInArrow(fingerprint, fields))
    base = found.where("cls = -1").select("_key", "doc_id", "n_words")

    mine = found.where("cls >= 0").select("_key", "cls", "pos", "w", "j", *names)
    met = mine.join(other, (F.col("w") == F.col("i_w")) & (F.col("j") == F.col("i_j")) & (F.col("cls") == F.col("i_cls")))

    def extent(side: str):
        out = F.lit(0)
        for j in range(reach, 0, -1):
            out = F.when(F.col(f"{side}{j}") == F.col(f"i_{side}{j}"), out + 1).otherwise(0)
        return out

    size = F.when(F.col("cls") == 0, F.lit(k)).otherwise(F.col("cls"))
    spans = (
        met.withColumn("left", extent("l"))
        .withColumn("right", extent("r"))
        # a pair that shares several windows around the k-gram counts by the first one
        .where((F.col("cls") > 0) | ((F.col("left") == F.col("j")) & (F.col("left") + k + F.col("right") >= span)))
        .select("_key", (F.col("pos") - F.col("left")).alias("first"), (F.col("pos") + size + F.col("right")).alias("after"), "fid")
    )
    return base, spans, owners


def merge_spans(spans: DataFrame, *keys: str) -> DataFrame:
    """Union of [first, after) spans by key as a sorted array ``runs`` of disjoint structs.

    The furthest end of each start is found first, so the array that a key
    gathers is no longer than its text.
    """
    ends = spans.groupBy(*keys, "first").agg(F.max("after").alias("after"))
    listed = ends.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("first", "after"))).alias("s"))
    reached = """aggregate(s, named_struct('runs', cast(array() as array<struct<first:bigint,after:bigint>>), 'cur', s[0]),
      (acc, x) -> if(x.first <= acc.cur.after,
        named_struct('runs', acc.runs, 'cur', named_struct('first', acc.cur.first, 'after', greatest(acc.cur.after, x.after))),
        named_struct('runs', concat(acc.runs, array(acc.cur)), 'cur', x)),
      acc -> concat(acc.runs, array(acc.cur)))"""
    return listed.select(*keys, F.expr(reached).alias("runs"))


def contamination(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", span: int = SPAN, k: int = K) -> DataFrame:
    """One row for each row of ``docs``: id, n_words, n_hit, items (sorted as
    strings), runs (merged spans of hit words), contaminated."""
    base, spans, owners = hits(docs, items, doc_id, text, item_id, item_text, span, k)
    spans = materialize(spans)
    runs = merge_spans(spans, "_key")
    met = spans.select("_key", "fid").distinct().join(owners, "fid")
    named = met.select("_key", F.col("item_id").cast("string").alias("i")).distinct().groupBy("_key").agg(F.array_sort(F.transform(F.collect_list(F.struct("i")), lambda x: x["i"])).alias("items"))
    out = base.join(runs.join(named, "_key", "left"), "_key", "left")
    n_hit = F.expr("coalesce(aggregate(runs, 0L, (a, x) -> a + x.after - x.first), 0L)")
    return out.select(
        "_key",
        F.col("doc_id").alias(doc_id),
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("runs", F.array().cast("array<struct<first:bigint,after:bigint>>")).alias("runs"),
        (n_hit > 0).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", most_hit: float = 0.0, **names) -> DataFrame:
    """``docs`` without the rows of which more than ``most_hit`` of the words are hit."""
    columns = docs.columns
    docs, (doc_id, text) = numbered_columns(docs, doc_id, text)
    found = contamination(docs, items, doc_id, text, **names).where(F.col("n_hit") > most_hit * F.col("n_words")).select("_key").distinct()
    return without(docs, row_key(doc_id, text), materialize(found)).toDF(*columns)


def query(spark, sf_dir: str) -> DataFrame:
    """op1: the contamination of every document, as its contract states it."""
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    out = contamination(docs, items)
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


#: The same from the definition: all windows of all items as strings, and all document windows.
ORACLE_SQL = r"""
WITH iw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS m, array_to_string(w[p : p + least(len(w), 10) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM iw WHERE len(w) > 0)),
lens AS (SELECT DISTINCT m FROM win),
dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
grams AS (
  SELECT doc_id, m, p, array_to_string(w[p : p + m - 1], ' ') AS g
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS p FROM dw, lens WHERE len(w) >= m)),
hit AS (SELECT doc_id, item_id, grams.m AS m, p FROM grams JOIN win ON grams.m = win.m AND grams.g = win.g),
pos AS (SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(range(p, p + m)) AS q FROM hit) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n, string_agg(i, ',' ORDER BY i) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(pos.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(it.n, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(pos.n, 0) > 0 AS contaminated
FROM dw LEFT JOIN pos USING (doc_id) LEFT JOIN it USING (doc_id)
"""

"""MinHash near-dedup by fast similarity sketching (operator 8).

A sketch has ``BANDS * ROWS`` coordinates. In round i each shingle falls into one
hashed coordinate with a value that grows with i; a coordinate keeps its smallest
value, so later rounds matter only to coordinates that are still empty. After as
many rounds as coordinates, further rounds each fill one coordinate with all
shingles, which guarantees that every coordinate is filled. As every coordinate
averages over the whole set, the estimate is concentrated as that of independent
MinHashes, at the cost of about one hash a shingle for texts of ordinary size.

Texts with the same shingle set (two independent 64-bit digests) are one class, so
copies meet once. Bands of rows meet in a shuffle. Within a bucket links to one
centre, the smallest class, are verified first. Where a bucket then still holds
several components, pairs of different components are left to try:

* with ``FEW`` members or fewer outside the bucket's largest component, each of them
  with the members of other components, unless bitmaps of the two sets show that too
  many shingles are not common: each bit set in one and not in the other stands for at
  least one such shingle. That is at most ``FEW`` tries a member.
* members of larger mixed buckets meet by prefix filtering instead: with a text's
  shingles in the order of their frequency, two texts that link have a shingle in common
  among the first few of each, and only those that its positions there and the bitmaps do not
  rule out are tried. This is exact too and makes no pairs within a bucket.

Every pair of a bucket thus is verified, ruled out exactly or already connected.
The verification compares full shingle sets.

A link at similarity 0.85 is missed by all 32 bands of 4 rows with a probability
of 6e-11 (at 0.8: 5e-8). Shingles are 52-bit hashes.

Defined results: a null or empty text, or one of white space, has no shingles and
is alone in its component; texts with fewer words than a shingle have one shingle,
all words; repeated rows are members of one class; rows with a null id take part
but never name a component (component null if all ids in it are null, and such
rows are not kept); columns beside id and text are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import NONSPACE, PackedFilter, Words, long_list, materialize, maybe_members, member_filter, mix, numbered_columns, row_key, slices, text_bytes, without
from .graph import components, merged

BANDS, ROWS = 32, 4
SIZE = BANDS * ROWS
BITMAP_WORDS = 16  # of 64 bits each
#: Members of a bucket outside its largest component that are tried one by one.
FEW = 64
#: A class with this share of all rows is hot; there are at most 1000 of them.
HOT = 1000
_BITS = 52
_LOW = np.uint64((1 << _BITS) - 1)
_SEEDS = np.arange(2 * SIZE + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)


def shingle_sets(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text, ascending, as 52-bit hashes, and n + 1 offsets."""
    n = len(words.counts)
    grams, at = words.grams(k)
    parts, owner = [grams], [words.text_of[at]]
    for m in range(1, k):
        few = np.flatnonzero(words.counts == m)
        if len(few):
            total = np.zeros(len(few), dtype=np.uint64)
            for j in range(m):
                total = mix(total + words.hashes[words.offsets[few] + j])
            parts.append(total)
            owner.append(few)
    owner = np.concatenate(owner)
    key = (owner.astype(np.uint64) << np.uint64(_BITS)) | (np.concatenate(parts) & _LOW)
    key.sort()
    if len(key):
        key = key[np.concatenate([[True], key[1:] != key[:-1]])]
    offsets = np.searchsorted(key, np.arange(n + 1, dtype=np.uint64) << np.uint64(_BITS))
    return key & _LOW, offsets


def sketches(values: np.ndarray, offsets: np.ndarray, size: int = SIZE) -> np.ndarray:
    """Fast similarity sketches, one row of ``size`` coordinates for each non-empty set."""
    counts = np.diff(offsets)
    full = np.flatnonzero(counts)
    out = np.zeros((len(full), size), dtype=np.uint64)
    filled = np.zeros((len(full), size), dtype=bool)
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    live = np.arange(len(full))
    owner, elements = np.repeat(np.arange(len(full)), counts[full]), values
    for i in range(2 * size):
        hashed = mix(elements + _SEEDS[i + 1])
        best = np.full(len(full) * size, empty)
        place = (hashed & np.uint64(size - 1)).astype(np.int64) if i < size else np.full(len(hashed), i - size)
        np.minimum.at(best, owner * size + place, hashed >> np.uint64(8))
        best = best.reshape(len(full), size)
        new = (best != empty) & ~filled[live]
        rows, cols = np.nonzero(new)
        out[live[rows], cols] = mix(best[rows, cols] + _SEEDS[i])
        filled[live] |= new
        open_ = ~filled[live].all(axis=1)
        if not open_.any():
            break
        if not open_.all():
            keep = open_[owner]
            number = np.cumsum(open_) - 1
            owner, elements, live = number[owner[keep]], elements[keep], live[open_]
            full = full[open_]
    return out


def band_keys(sketch: np.ndarray) -> np.ndarray:
    keys = np.zeros((len(sketch), BANDS), dtype=np.uint64)
    banded = sketch.reshape(len(sketch), BANDS, ROWS)
    for r in range(ROWS):
        keys = mix(keys + banded[:, :, r])
    return mix(keys + np.arange(1, BANDS + 1, dtype=np.uint64)[None, :])


def _slices(offsets: np.ndarray):
    for a, b in slices(offsets):
        for c in range(a, b, 4000):  # the number of a text in its slice has 12 bits
            yield c, min(c + 4000, b)


def signatures(docs: DataFrame, doc_id: str, text: str, k: int) -> DataFrame:
    """_key, doc_id, n_shingles, cls and chk (digests of the shingle set, null if empty), bands."""
    key_type = docs.schema[doc_id].dataType.simpleString()

    def sign(batches):
        for batch in batches:
            data, offsets = text_bytes(batch.column(2))
            for a, b in _slices(offsets):
                values, own = shingle_sets(Words(data, offsets[a : b + 1], NONSPACE), k)
                counts = np.diff(own)
                full = np.flatnonzero(counts)
                digests = np.zeros((2, b - a), dtype=np.uint64)
                if len(full):
                    for digest, salt in zip(digests, (77, 0x5851F42D4C957F2D), strict=True):
                        digest[full] = mix(np.add.reduceat(mix(values + np.uint64(salt)), own[full]) + counts[full].astype(np.uint64))
                bands = band_keys(sketches(values, own))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        batch.column(1).slice(a, b - a),
                        pa.array(counts.astype(np.int64)),
                        *[pa.array(digest.view(np.int64), mask=counts == 0) for digest in digests],
                        long_list(bands.ravel(), np.concatenate([[0], np.cumsum(np.where(counts > 0, BANDS, 0))])),
                    ],
                    names=["_key", "doc_id", "n_shingles", "cls", "chk", "bands"],
                )

    source = docs.select(row_key(doc_id, text).alias("_key"), F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return source.mapInArrow(sign, f"_key bigint, doc_id {key_type}, n_shingles bigint, cls bigint, chk bigint, bands array<bigint>")


def bitmaps(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A bitmap of each set, ``BITMAP_WORDS`` words a row: the bit of each shingle's hash."""
    n = len(offsets) - 1
    bits = np.zeros((n, 64 * BITMAP_WORDS), dtype=bool)
    bits[np.repeat(np.arange(n), np.diff(offsets)), (values & np.uint64(64 * BITMAP_WORDS - 1)).astype(np.int64)] = True
    return np.packbits(bits, axis=1, bitorder="little").view("<i8")


def _sets(docs: DataFrame, nodes: DataFrame, doc_id: str, text: str, k: int) -> DataFrame:
    """(node, n, s, bits) of the classes in ``nodes`` (node, n), from the text of the row whose key the node is."""
    member = PackedFilter(member_filter(nodes, "node"))

    def collect(batches):
        cells = member.cells()
        for batch in batches:
            keys = batch.column(0).to_numpy()
            rows = np.flatnonzero(cells[keys & member.mask])
            if not len(rows):
                continue
            batch = batch.take(pa.array(rows))
            data, offsets = text_bytes(batch.column(1))
            for a, b in _slices(offsets):
                values, own = shingle_sets(Words(data, offsets[a : b + 1], NONSPACE), k)
                bits = long_list(bitmaps(values, own).ravel(), np.arange(b - a + 1) * BITMAP_WORDS)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), long_list(values, own), bits], names=["node", "s", "bits"])

    found = docs.select(row_key(doc_id, text).alias("node"), F.col(text).cast("string").alias("text")).mapInArrow(collect, "node bigint, s array<bigint>, bits array<bigint>")
    return found.dropDuplicates(["node"]).join(nodes, "node").select("node", "n", "s", "bits")


def _verified(pairs: DataFrame, sets: DataFrame, share: int) -> DataFrame:
    """The pairs (a, b) of classes whose full sets have ``100 * common >= share * union``."""
    left = pairs.join(sets.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("s").alias("s_a")), "a")
    both = left.join(sets.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("s").alias("s_b")), "b")
    common = F.size(F.array_intersect("s_a", "s_b")).cast("long")
    return both.where(100 * common >= share * (F.col("n_a") + F.col("n_b") - common)).select("a", "b")


def _may_link(share: int):
    """Whether the bitmaps and sizes of sets a and b (n_a, bits_a, n_b, bits_b) allow a link."""
    beyond = lambda x, y: F.aggregate(F.zip_with(f"bits_{x}", f"bits_{y}", lambda p, q: F.bit_count(p.bitwiseAND(F.bitwise_not(q)))), F.lit(0), lambda s, v: s + v)
    need = share * (F.col("n_a") + F.col("n_b"))
    return ((100 + share) * (F.col("n_a") - beyond("a", "b")) >= need) & ((100 + share) * (F.col("n_b") - beyond("b", "a")) >= need)


def _first_shared():
    """Whether no band before this one is common to a and b: each pair comes out once."""
    before = lambda x: F.slice(f"bands_{x}", F.lit(1), F.col("band"))
    return ~F.exists(F.zip_with(before("a"), before("b"), lambda p, q: p == q), lambda same: same)


def _fits(share: int):
    """Whether the sizes alone allow a link."""
    return 100 * F.least("n_a", "n_b") >= share * F.greatest("n_a", "n_b")


def _tried(mixed: DataFrame, share: int) -> DataFrame:
    """Pairs (a, b) of a bucket's members outside of its largest component with those of other components."""
    side = lambda x: [F.col("band"), F.col("bucket"), F.col("bands").alias(f"bands_{x}"), F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("comp").alias(f"comp_{x}"), F.col("bits").alias(f"bits_{x}")]
    minor = mixed.where("comp <> largest").select(*side("a"))
    every = mixed.select(*side("b"), (F.col("comp") == F.col("largest")).alias("major"))
    cross = minor.join(every, ["band", "bucket"]).where((F.col("comp_a") != F.col("comp_b")) & (F.col("major") | (F.col("a") < F.col("b"))) & _fits(share) & _may_link(share) & _first_shared())
    return cross.select("a", "b")


def _by_prefix(nodes: DataFrame, sets: DataFrame, share: int) -> DataFrame:
    """Pairs (a, b) of ``nodes`` (node, comp) of different components that may link, by prefix filtering.

    Of two sets x and y, |x| >= |y|, with a link, common shingles are ceil(share / (100 + share) * (|x| + |y|))
    at least; so the first one, in an order of all shingles, leaves room behind it for the rest.
    """
    held = materialize(nodes.join(sets.select("node", "n", "s"), "node").select("node", "comp", "n", F.explode("s").alias("g")))
    often = materialize(held.groupBy("g").agg(F.count("*").alias("f")).where("f > 1"))
    ranked = held.join(often, "g", "left").withColumn("pos", F.row_number().over(Window.partitionBy("node").orderBy(F.coalesce("f", F.lit(1)), "g")) - 1)
    # A set's own prefix is that of its meeting with the smallest set that fits.
    first = ranked.where("f > 1").where(100 * (F.col("n") - F.col("pos")) >= share * F.col("n")).select("g", "node", "comp", "n", "pos")
    first = materialize(first.join(sets.select("node", "bits"), "node"))
    side = lambda x: first.select("g", *[F.col(c).alias(f"{c}_{x}") for c in ("node", "comp", "n", "pos", "bits")])
    room = F.least(F.col("n_a") - F.col("pos_a"), F.col("n_b") - F.col("pos_b"))
    met = side("a").join(side("b"), "g").where((F.col("node_a") < F.col("node_b")) & (F.col("comp_a") != F.col("comp_b")) & _fits(share) & ((100 + share) * room >= share * (F.col("n_a") + F.col("n_b"))) & _may_link(share))
    return met.select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = 3, share: int = 85, few: int = FEW) -> DataFrame:
    """_key, id, n_shingles, component_id, kept and _group of each row of ``docs``; _group numbers
    the components, those without any id too.

    Linked are texts whose sets of k-word shingles have at least ``share``
    hundredths of their union in common; a component is named by its smallest id.
    """
    signed = materialize(signatures(docs, doc_id, text, k))
    # A class is known by the smallest row key in it.
    classes = materialize(
        signed.where("cls is not null").groupBy("cls", "chk").agg(F.min("doc_id").alias("rep"), F.min("_key").alias("node"), F.min("n_shingles").alias("n"), F.count("*").alias("m"), F.first("bands").alias("bands"))
    )
    bands = classes.select("node", "n", F.posexplode("bands").alias("band", "bucket"))
    # A centre is drawn for each bucket by a hash of bucket and class, so a class meets another one in each.
    drawn = F.min(F.struct(F.xxhash64("bucket", "node").alias("h"), F.col("node"), F.col("n")))
    centres = materialize(bands.groupBy("bucket").agg(F.count("*").alias("m"), drawn.alias("c")).where("m > 1").select("bucket", F.col("c.node").alias("a"), F.col("c.n").alias("n_a")))
    met = materialize(maybe_members(bands, F.col("bucket"), centres.select("bucket")).where("__maybe").join(centres, "bucket").select("band", "bucket", "node", "n", "a", "n_a"))
    sets = materialize(_sets(docs, materialize(met.select("node", "n").distinct()), doc_id, text, k))
    star = met.where(F.col("a") != F.col("node")).select("a", "n_a", F.col("node").alias("b"), F.col("n").alias("n_b")).where(_fits(share)).select("a", "b")
    labels = components(materialize(_verified(star.distinct(), sets, share)))

    labelled = materialize(met.join(labels, "node", "left").select("band", "bucket", "node", "n", F.coalesce("comp", "node").alias("comp")))
    parts = labelled.groupBy("bucket", "comp").agg(F.count("*").alias("m"))
    largest = F.max(F.struct("m", "comp"))
    split = materialize(parts.groupBy("bucket").agg(F.count("*").alias("parts"), F.sum("m").alias("m"), largest.alias("l")).where("parts > 1").select("bucket", (F.col("m") - F.col("l.m")).alias("minor"), F.col("l.comp").alias("largest")))
    open_ = materialize(labelled.join(split, "bucket"))
    small = open_.where(F.col("minor") <= few).join(sets.select("node", "bits"), "node").join(classes.select("node", "bands"), "node")
    pairs = _tried(materialize(small), share).union(_by_prefix(materialize(open_.where(F.col("minor") > few).select("node", "comp").distinct()), sets, share))
    more = materialize(_verified(pairs.distinct(), sets, share))
    if not more.isEmpty():
        labels = merged(labels, more)

    linked = materialize(labels.join(classes.select("node", "rep"), "node"))
    names = materialize(linked.groupBy("comp").agg(F.min("rep").alias("name")))
    grouped = linked.select("node", "comp").join(names, "comp")
    # What is said of a class: its own smallest id and key where nothing links it. Classes of one row need no word.
    said = classes.join(grouped, "node", "left").where("m > 1 or comp is not null")
    said = materialize(said.select("cls", "chk", "m", F.when(F.col("comp").isNull(), F.col("rep")).otherwise(F.col("name")).alias("name"), F.coalesce("comp", "node").alias("_group")))
    rows = maybe_members(signed.select("_key", "doc_id", "n_shingles", "cls", "chk"), F.col("cls"), said.select("cls"))
    total = signed.count()
    hot = said.where(F.col("m") * HOT >= total)  # the members of all classes are ``total`` at most, so these are ``HOT``
    cold = said.where(F.col("m") * HOT < total)
    first = rows.where("__maybe").join(F.broadcast(hot.drop("m")), ["cls", "chk"], "left")
    own = [F.col("doc_id").alias("component_id"), F.when(F.col("cls").isNotNull(), F.col("_key")).alias("_group")]
    named = lambda df: df.select("_key", "doc_id", "n_shingles", F.when(F.col("_group").isNull(), F.col("doc_id")).otherwise(F.col("name")).alias("component_id"), F.coalesce("_group", "_key").alias("_group"))
    parts = [
        rows.where("not __maybe").select("_key", "doc_id", "n_shingles", *own),
        named(first.where("_group is not null")),
        named(first.where("_group is null").drop("name", "_group").join(cold.drop("m"), ["cls", "chk"], "left")),
    ]
    return parts[0].union(parts[1]).union(parts[2]).select(
        "_key", F.col("doc_id").alias(doc_id), "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"), "_group"
    )


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = 5, share: int = 80) -> DataFrame:
    """One row of each group of near-duplicates, the one with the smallest id.

    Rows that repeat the kept id within the component (whole repeated rows too)
    are further copies: the one with the smallest row key stays. So does that row of
    a group in which no row has an id. Rows without
    words are in no group and all stay.
    """
    names = docs.columns
    docs, (doc_id, text) = numbered_columns(docs, doc_id, text)
    found = materialize(near_duplicates(docs, doc_id, text, k, share))
    worded = found.where("n_shingles > 0")
    # A row is in question where its key is not that of its group, or stands more than once.
    keys = worded.groupBy("_key").agg(F.count("*").alias("n"), F.min("_group").alias("_group"), F.max((F.col("kept") | F.col("component_id").isNull()).cast("int")).alias("stays"))
    keys = materialize(keys)
    kept = keys.where("stays = 1").groupBy("_group").agg(F.min("_key").alias("_key")).select("_key")
    gone = materialize(keys.select("_key").join(kept, "_key", "left_anti"))
    left = without(docs, row_key(doc_id, text), gone)
    copies = materialize(keys.where("n > 1").select("_key"))
    if copies.isEmpty():
        return left.select(*docs.columns).toDF(*names)
    marked = maybe_members(left.withColumn("__key", row_key(doc_id, text)), F.col("__key"), copies)
    again = F.col("__maybe") & F.coalesce(F.col(text).cast("string").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    # Rows that may be copies and are none stand alone, so nothing but copies goes; each task drops its own first.
    return marked.where(~again).select(*docs.columns).union(marked.where(again).dropDuplicates(["__key"]).select(*docs.columns)).toDF(*names)


def query(spark, sf_dir: str) -> DataFrame:
    """op8: components of all documents on 3-word shingles at 0.85."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs).select("doc_id", "n_shingles", "component_id", "kept")


#: From the definition: shingles as strings, all pairs with a common one, and reachability.
ORACLE_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN [array_to_string(w[p : p + 2], ' ') FOR p IN range(1, len(w) - 1)] ELSE [array_to_string(w, ' ')] END) AS g
  FROM w WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pair AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT x, y FROM pair JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 85 * (nx.n + ny.n - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT reach.a, link.y FROM reach JOIN link ON link.x = reach.b),
comp AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id, w.doc_id = component_id AS kept
FROM w JOIN comp ON w.doc_id = comp.doc_id LEFT JOIN n ON n.doc_id = w.doc_id
"""

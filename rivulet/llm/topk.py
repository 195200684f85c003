"""Exact top-k by inner product over an M-tree of paged metric nodes (operator 5).

Vectors become integers, floor(scale * x). With one more coordinate,
sqrt(M^2 - |x|^2) for M the largest norm, all vectors have norm M; to a query, whose
own extra coordinate is 0, the Euclidean order is the order of inner products, so
the index is metric.

Tree: a root of routing objects (the vectors of smallest hash, about the square root
of all, from ``FEWEST`` to ``ROUTERS``: a bounded sample that shapes the tree but never decides
what is indexed), each with parts of ``PAGES`` leaf pages of about ``PAGE`` entries, as many as
it takes. An entry keeps the distance to its
routing object, a page the range of these distances, its covering shell. Vectors
that are equal form one class, of which the first k + 1 ids are kept, which is
enough for every query.

Search: a query goes to the pages of its nearest routing object first; the k-th
score found there is its bound. It then visits only routing objects whose bound
by the triangle inequality reaches it. Each task goes through its pages best
first, raising the bounds of its queries as it goes: pages and then entries are
left out by stored distances alone, before any product is computed. Scores are
integers and bounds are widened by more than the rounding error, so that the
result is exact, ties to the smaller id included.

Pages are dealt to buckets of about ``BUCKET`` vectors. A task unpacks the pages of a bucket once and
queries, of which each comes once a bucket that may hold a result, pass by them in blocks of ``BLOCK``; no page
travels or is a row twice, and what a task holds doesn't grow with the queries. Packed components take 16, 32 or 64 bits, as many as a vector needs.

Defined results: rows with a null id, a null or empty vector, or null or non-finite
components take no part. Shorter vectors count as padded with zeros. Rows that
repeat id and vector are one candidate; one id with several vectors gives a
candidate, and a query, for each distinct one. Other columns are ignored. A vector with a component
of 2**55 and more (2**63 after scaling) has no integer form of 64 bits and takes no part, as vectors that
are not finite; a score beyond 64 bits is the largest or smallest number of 64 bits and never wraps; scores
from 2**53 on, where doubles are no longer exact, are computed in integers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import materialize, small_batches, text_bytes

ROUTERS, FEWEST = 1024, 16
PAGE, PAGES = 1024, 16
BLOCK, BUCKET = 256, 1 << 15
EXACT = 2.0**52
SLACK = 1e-6


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Packed integer vectors as float64 rows of equal width."""
    data, offsets = text_bytes(column)
    bytes_ = int(data[offsets[0]]) if len(column) else 0
    if len(column) and (np.diff(offsets) == 1 + bytes_ * width).all() and (data[offsets[:-1]] == bytes_).all():
        rows = data[offsets[0] : offsets[-1]].reshape(len(column), -1)[:, 1:]
        return np.ascontiguousarray(rows).view(f"<i{bytes_}").astype(np.float64)
    out = np.zeros((len(column), width))
    for i, x in enumerate(column.to_pylist()):
        v = _unpacked(x)
        out[i, : len(v)] = v
    return out


def _unpacked(x: bytes) -> np.ndarray:
    return np.frombuffer(x, dtype=f"<i{x[0]}", offset=1)


def _length(name: str):
    """Components of a packed vector."""
    return F.floor((F.octet_length(name) - 1) / F.conv(F.hex(F.substring(name, 1, 1)), 16, 10).cast("int")).cast("int")


def _packed(x: list | None, scale: int) -> bytes | None:
    """floor(scale * x), packed: the bytes of a component (2, 4 or 8, as few as all fit in), then the components. None for what takes
    no part, such as a vector beyond 64 bits."""
    if not x or None in x:
        return None
    v = np.asarray(x, dtype=np.float64)
    if not np.isfinite(v).all():
        return None
    v = np.floor(scale * v)
    most = np.abs(v).max()
    if most >= 2.0**63:
        return None
    bytes_ = 2 if most < 2**15 else 4 if most < 2**31 else 8
    return bytes([bytes_]) + v.astype(f"<i{bytes_}").tobytes()


def _score(a: bytes, b: bytes) -> int:
    """The integer inner product of packed vectors; one beyond 64 bits is the largest or smallest of 64 bits."""
    total = sum(int(x) * int(y) for x, y in zip(_unpacked(a).tolist(), _unpacked(b).tolist(), strict=False))
    return min(max(total, -(2**63) + 1), 2**63 - 1)


def _classes(vectors: DataFrame, vec_id: str, embedding: str, k: int, scale: int) -> DataFrame:
    """v (packed integers), ids (the k + 1 smallest) and norm2 of each distinct vector."""

    def quantize(batches):
        for batch in batches:
            best: dict[bytes, list[int]] = {}
            ids = batch.column(0).to_pylist()
            for i, x in zip(ids, batch.column(1).to_pylist(), strict=True):
                v = _packed(x, scale)
                if v is not None:
                    best.setdefault(v, []).append(i)
            keys = list(best)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), pa.array([sorted(set(best[b]))[: k + 1] for b in keys], pa.list_(pa.int64()))], names=["v", "ids"]
            )

    parts = (
        vectors.where(F.col(vec_id).isNotNull() & F.col(embedding).isNotNull())
        .select(F.col(vec_id).cast("bigint").alias("i"), F.col(embedding).cast("array<double>").alias("x"))
        .mapInArrow(quantize, "v binary, ids array<bigint>")
    )
    # A batch gives k + 1 ids of a vector at most; two levels keep the lists of a frequent vector short.
    first = lambda: F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, k + 1)
    salted = parts.withColumn("salt", F.pmod(F.xxhash64(F.col("ids")[0]), F.lit(64))).groupBy("v", "salt").agg(first().alias("ids"))
    return salted.groupBy("v").agg(first().alias("ids"))


def _distances(q: np.ndarray, routers: np.ndarray, top: float) -> np.ndarray:
    """Distance of queries (extra coordinate 0) to routing objects on the sphere of norm^2 ``top``."""
    return np.sqrt(np.maximum((q * q).sum(axis=1)[:, None] + top - 2 * q @ routers.T, 0))


def search(vectors: DataFrame, queries: DataFrame, k: int = 5, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = 256, routers: int | None = None, page: int = PAGE) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` best rows of ``vectors`` for each row of ``queries``.

    A row is never its own result (by id).
    """
    spark = vectors.sparkSession
    small_batches(spark)  # a page is a row
    schema = "query_id bigint, rank int, vec_id bigint, score bigint"
    classes = materialize(_classes(vectors, vec_id, embedding, k, scale))
    width, n = classes.select(F.max(_length("v")), F.count("*")).first()
    if width is None:
        return spark.createDataFrame([], schema)

    def ask(batches):
        for batch in batches:
            keep = [(i, v) for i, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) if (v := _packed(x, scale)) is not None]
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in keep], pa.int64()), pa.array([v for _, v in keep], pa.binary())], names=["query_id", "q"])

    asked = (
        queries.where(F.col(vec_id).isNotNull() & F.col(embedding).isNotNull())
        .select(F.col(vec_id).cast("bigint").alias("i"), F.col(embedding).cast("array<double>").alias("x"))
        .mapInArrow(ask, "query_id bigint, q binary")
        .distinct()
    )
    asked = materialize(asked)

    # a query may be longer than every candidate
    width = max(width, asked.select(F.max(_length("q"))).first()[0] or 0)
    routers = routers or min(max(int(n**0.5), FEWEST), ROUTERS)
    sample = _matrix(pa.array([r.v for r in classes.orderBy(F.xxhash64("v"), "v").select("v").limit(routers).collect()]), width)
    shape = materialize(classes.mapInArrow(lambda batches: _norms(batches, width), "norm2 double").agg(F.max("norm2").alias("top")))
    top = float(shape.first().top)
    extra = np.sqrt(np.maximum(top - (sample * sample).sum(axis=1), 0))

    def place(batches):
        """node, distance to its routing object, and a page key."""
        for batch in batches:
            x = _matrix(batch.column(0), width)
            z = np.sqrt(np.maximum(top - (x * x).sum(axis=1), 0))
            d = np.sqrt(np.maximum(2 * top - 2 * (x @ sample.T + z[:, None] * extra[None, :]), 0))
            node = d.argmin(axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(node.astype(np.int32)), pa.array(d[np.arange(len(d)), node]), batch.column(0), batch.column(1)], names=["node", "d", "v", "ids"])

    placed = materialize(classes.select("v", "ids").mapInArrow(place, "node int, d double, v binary, ids array<bigint>"))
    # Pages are shells of the node: equal shares of the range of distances, split further by hash where a shell is full.
    spread = placed.groupBy("node").agg(F.count("*").alias("n"), F.min("d").alias("least"), F.max("d").alias("most"))
    shells = F.greatest(F.lit(1), F.ceil(F.col("n") / page)).cast("int")
    shelled = placed.join(spread, "node").withColumn("shell", F.least(shells - 1, F.floor((F.col("d") - F.col("least")) / (F.col("most") - F.col("least") + 1e-9) * shells)).cast("int")).select("node", "shell", "d", "v", "ids")
    sizes = shelled.groupBy("node", "shell").agg(F.ceil(F.count("*") / page).cast("int").alias("splits"))
    paged = shelled.join(sizes, ["node", "shell"]).withColumn("split", F.pmod(F.xxhash64("v"), F.col("splits"))).groupBy("node", "shell", "split").agg(
        F.sort_array(F.collect_list(F.struct("d", "v", "ids"))).alias("entries"), F.min("d").alias("inner"), F.max("d").alias("outer")
    )
    buckets = max(-(-n // BUCKET), min(2 * spark.sparkContext.defaultParallelism, -(-n // page)))
    part = F.floor(F.col("shell") / PAGES)
    pages = materialize(paged.withColumn("b", F.pmod(F.xxhash64("node", part, "split"), F.lit(buckets)).cast("int")).select("b", "node", "inner", "outer", "entries"))
    # at most ROUTERS rows, each with buckets of its own
    found = pages.groupBy("node").agg(F.min("inner").alias("inner"), F.max("outer").alias("outer"), F.collect_set("b").alias("b")).collect()
    inner, outer, inside = np.full(len(sample), np.inf), np.full(len(sample), -np.inf), np.zeros((len(sample), buckets), dtype=bool)
    for r in found:
        inner[r.node], outer[r.node] = r.inner, r.outer
        inside[r.node, r.b] = True

    def deal(near: bool):
        """The buckets that a query goes to: those of its nearest node, or those of other nodes that may hold a score as good as the bound, by
        their covering radii."""

        def run(batches):
            for batch in batches:
                for at in range(0, batch.num_rows, BLOCK):
                    part = batch.slice(at, BLOCK)
                    q = _matrix(part.column(1), width)
                    d = _distances(q, sample, top)
                    own = d.argmin(axis=1)
                    if near:
                        wanted = inside[own]
                    else:
                        q2 = (q * q).sum(axis=1)
                        gap = np.maximum(np.maximum(d - outer[None, :], inner[None, :] - d), 0)
                        ceiling = (q2[:, None] + top - gap * gap) / 2 + SLACK * (q2[:, None] + top)
                        may = (ceiling >= part.column(2).to_numpy()[:, None]) & (inner[None, :] <= outer[None, :])
                        may[np.arange(len(d)), own] = False
                        wanted = may.astype(np.float32) @ inside.astype(np.float32) > 0
                    rows, to = np.nonzero(wanted)
                    index = pa.array(rows)
                    yield pa.RecordBatch.from_arrays([pa.array(to.astype(np.int32)), pa.array(own[rows].astype(np.int32)), *[part.column(c).take(index) for c in range(3)]], names=["b", "node", "query_id", "q", "bound"])

        return run

    def visit(asking: DataFrame, near: bool) -> DataFrame:
        held = pages.select("b", F.lit(0).cast("tinyint").alias("kind"), "node", "inner", "outer", "entries", *[F.lit(None).cast(t).alias(c) for c, t in (("query_id", "bigint"), ("q", "binary"), ("bound", "bigint"))])
        passing = asking.mapInArrow(deal(near), "b int, node int, query_id bigint, q binary, bound bigint")
        passing = passing.select("b", F.lit(1).cast("tinyint").alias("kind"), "node", *[F.lit(None).cast(held.schema[c].dataType).alias(c) for c in ("inner", "outer", "entries")], "query_id", "q", "bound")
        met = held.union(passing).repartition(buckets, "b").sortWithinPartitions("b", "kind")
        return met.mapInArrow(lambda batches: _scan(batches, sample, top, width, k, near), "query_id bigint, q binary, vec_id bigint, score bigint")

    least = F.lit(-(2**63) + 1)
    near = materialize(_best(visit(asked.select("query_id", "q", least.alias("bound")), True), k))
    bounds = asked.join(near.groupBy("query_id", "q").agg(F.when(F.count("*") >= k, F.min("score")).alias("bound")), ["query_id", "q"], "left").select("query_id", "q", F.coalesce("bound", least).alias("bound"))
    far = visit(bounds, False)
    # Distinct vectors of one query id answer together.
    ranked = _best(near.select("query_id", "q", "vec_id", "score").union(far), k).drop("q")
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _norms(batches, width: int):
    for batch in batches:
        x = _matrix(batch.column(0), width)
        yield pa.RecordBatch.from_arrays([pa.array((x * x).sum(axis=1))], names=["norm2"])


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query, ranked; a query has a few candidates from each task."""
    from pyspark.sql import Window

    order = Window.partitionBy("query_id", "q").orderBy(F.desc("score"), F.asc("vec_id"))
    return found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


class _Page:
    """A page, unpacked: the distances of its entries to the routing object, ascending, their vectors, norms and ids."""

    def __init__(self, row: pa.RecordBatch, width: int):
        self.node, self.inner, self.outer = (row.column(c)[0].as_py() for c in (2, 3, 4))
        e = row.column(5)[0].values
        self.parents, self.packed, self.ids = np.array(e.field("d")), e.field("v"), e.field("ids").to_pylist()
        self.x = _matrix(self.packed, width)
        self.norms = np.sqrt((self.x**2).sum(axis=1))


def _scan(batches, sample: np.ndarray, top: float, width: int, k: int, near: bool):
    """Of the buckets of a task, each the rows of its pages and then of queries: what the queries find, block by block."""
    bucket, pages = None, []
    for batch in batches:
        bs, kinds = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        cut = np.flatnonzero((np.diff(bs) != 0) | (np.diff(kinds) != 0)) + 1
        for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(bs)], strict=True) if len(bs) else ():
            if bs[a] != bucket:
                bucket, pages = bs[a], []
            if kinds[a] == 0:
                pages += [_Page(batch.slice(i, 1), width) for i in range(a, b)]
                continue
            for at in range(a, b if pages else a, BLOCK):
                yield from _found(_pass(pages, batch.slice(at, min(BLOCK, b - at)), sample, top, width, k, near))


def _pass(pages: list[_Page], queries: pa.RecordBatch, sample: np.ndarray, top: float, width: int, k: int, near: bool) -> dict:
    """The k best of a block of queries in the pages of their own nodes (``near``) or of all others: (id, vector) -> [(-score, id)], ascending."""
    keys = list(zip(queries.column(6).to_pylist(), queries.column(7).to_pylist(), strict=True))
    own, q = queries.column(2).to_numpy(), _matrix(queries.column(7), width)
    q2 = (q * q).sum(axis=1)
    slack = SLACK * (q2 + top)
    lower = lambda bound: bound - np.abs(bound) * 2.0**-50  # noqa: E731  as a double it may have been rounded up
    floor = lower(queries.column(8).to_numpy().astype(np.float64))  # the score that counts, by query
    best: list[list[tuple[int, int]]] = [[] for _ in keys]
    nodes = np.array([p.node for p in pages])
    known, which = np.unique(nodes, return_inverse=True)
    d = _distances(q, sample[known], top).T[which]  # page, query
    gap = np.maximum(np.maximum(d - np.array([p.outer for p in pages])[:, None], np.array([p.inner for p in pages])[:, None] - d), 0)
    asked = (own[None, :] == nodes[:, None]) == near
    for n in np.argsort(np.where(asked, gap, np.inf).min(axis=1), kind="stable").tolist():
        page = pages[n]
        live = np.flatnonzero(asked[n] & ((q2 + top - gap[n] * gap[n]) / 2 + slack >= floor))
        if not len(live):
            continue
        reach = np.sqrt(np.maximum(q2 + top - 2 * (floor - slack), 0))  # farther entries can't reach the bound
        first = np.searchsorted(page.parents, (d[n] - reach)[live].min(), "left")
        after = np.searchsorted(page.parents, (d[n] + reach)[live].max(), "right")
        if first >= after:
            continue
        scores = q[live] @ page.x[first:after].T
        size = np.sqrt(q2[live])[:, None] * page.norms[None, first:after]  # no sum on the way is larger
        plain = bool(size.max() < EXACT)
        # where doubles are not exact they only say which products may count; integers say what they are
        may = scores >= floor[live][:, None] if plain else scores + SLACK * size >= floor[live][:, None]
        for row in np.flatnonzero(may.any(axis=1)).tolist():
            j, good = int(live[row]), np.flatnonzero(may[row])
            i, packed = keys[j]
            if plain:
                s = scores[row]
                if len(good) > 4 * k:
                    least = np.partition(s[good], len(good) - k - 1)[len(good) - k - 1]  # one class may be the query's own
                    good = good[s[good] >= least]
                more = [(-int(s[g]), x) for g in good for x in page.ids[first + g] if x != i]
            else:
                more = [(-score, x) for g in good if any(x != i for x in page.ids[first + g]) for score in [_score(packed, page.packed[first + int(g)].as_py())] for x in page.ids[first + g] if x != i]
            if more:
                best[j] = sorted({*best[j], *more})[:k]
                if len(best[j]) == k:
                    floor[j] = max(floor[j], lower(float(-best[j][-1][0])))
    return dict(zip(keys, best, strict=True))


def _found(best: dict):
    out = [(key[0], key[1], i, -s) for key, found in best.items() for s, i in found]
    if out:
        part = list(zip(*out, strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(part[0], pa.int64()), pa.array(part[1], pa.binary()), pa.array(part[2], pa.int64()), pa.array(part[3], pa.int64())], names=["query_id", "q", "vec_id", "score"])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5: the five best other rows of every row whose id is divisible by 50."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return search(vectors, vectors.where("vec_id % 50 = 0"))


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

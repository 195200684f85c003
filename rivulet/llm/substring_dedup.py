"""Substring dedup by collinear chaining (operator 2).

Seeds are winnowed k-grams of words. Each seed that occurs in several documents is
matched with the first and the last of its holders in the order of row keys, at its first place in them, so that a passage of n copies gives less
than 2 n matches a seed, not n^2. Up to three holders all meet so, if each has one place; of more, a crowd, and of places the rest follows in a second round (below). The
matches of a document with one other document are merged along diagonals into
fragments and chained: Fenwick trees of maxima by the other document's positions give each
fragment the best chain that ends shortly before it in both, less a gap cost that grows
with the words between. Chains are then aligned word by word, along diagonals with small
dynamic programs in the gaps, and extended at both ends. What spans at least
``LEAST_WORDS`` words of which ``LEAST_SHARE`` or more agree is a passage that the
other document holds too.

A run of ``window + k - 1`` equal words always has a common seed. As a seed meets two
holders first, which may be other documents, exact repeats have a route of
their own: windows of ``least`` words. In a window that a smaller document holds too, all
seeds that the window alone decides are shared, so runs of matched seeds between which no other
seed was chosen say where such windows can lie. Those among them that no passage
covers are hashed and matched with the first occurrence of the whole window, found by
a second pass over all texts; matches of successive windows with one document are merged. Every window of ``least``
words that a document of smaller row key holds is thus part of a passage.

The second round is for seeds of crowds and for seeds that a document has at several places. A chain has two seeds that lie at least ``LEAST_SPAN - K`` words apart; where no passage
found so far holds both, the document meets every document of smaller row key that holds these two, and all seeds of the
two documents, at all their places, that can lie in a passage of the two are chained and aligned at once. Nobody is left out of it, so its work grows with the pairs that share such two
seeds outside of known passages. What is shuffled doesn't: documents meet in blocks inside of tasks, and a table of words tells of most pairs at once that no
passage of the two can be. Of two documents no passage within another is returned. What lies within a passage already is not looked for in further documents.

Words are those of ASCII digits, letters and non-ASCII characters, A-Z lower-cased.

Defined results: null and empty texts have no passages; rows equal in id and text are
one document (they are not repeats of each other and are cut alike); rows with a null
id are documents too; passages repeated only within one document are left alone;
other columns pass through ``cut`` untouched.
"""

from __future__ import annotations

import math
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ._common import ALNUM, Words, materialize, maybe_members, mix, numbered_columns, powers, row_key, slices, text_bytes, winnow
from .decontaminate import merge_spans

K, WINDOW = 5, 8
LEAST_WORDS, LEAST_SHARE = 50, 0.8
#: Seeds that a chain has at least to be aligned; a fragment longer than a seed has two at least.
LEAST_SEEDS = 2
#: Words from its first to its last that such a chain spans at least.
LEAST_SPAN = LEAST_WORDS // 4
#: Words that a gap of a chain has at most, on either side; a longer gap divides chains.
MOST_GAP = 40
GAP_COST = 0.25
#: Words before and after a chain that alignment may add: edited ends hold no seed.
SLACK = 40
#: Documents that ask for a link and that hold it which meet in one go, and cells of a table of words by documents.
ASKERS, HOLDERS, TABLE = 256, 1024, 1 << 23
#: Bits of a filter for each member, bits of a filter at most (32 MiB), and the chunks that it is built in.
CELLS, MOST_BITS, CHUNKS = 16, 28, 256
#: Bits for each whole window: all windows of all texts are asked for few of them.
WINDOW_CELLS = 64


# ---------------------------------------------------------------------- filters


class BitFilter:
    """Two bits a member in one array of bits; may_hold is false only for what is no member."""

    def __init__(self, packed: np.ndarray):
        self.packed, self.mask = packed, np.uint64(8 * len(packed) - 1)

    def may_hold(self, h: np.ndarray) -> np.ndarray:
        out = np.ones(len(h), dtype=bool)
        for c in _cells(h, self.mask):
            out &= (self.packed[(c >> np.uint64(3)).astype(np.int64)] >> (c & np.uint64(7)).astype(np.uint8)) & 1 > 0
        return out


def _cells(h: np.ndarray, mask: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """The two cells of each hash, both in the chunk that its low bits choose."""
    other = mix(h + np.uint64(1))
    chunk = h & np.uint64(CHUNKS - 1)
    inside = mask ^ np.uint64(CHUNKS - 1)
    rows = lambda x: (chunk * ((mask + np.uint64(1)) // np.uint64(CHUNKS))) + ((x & inside) >> np.uint64(CHUNKS.bit_length() - 1))
    return rows(h), rows(other)


def bit_filter(df: DataFrame, name: str, cells: int = CELLS) -> BitFilter:
    """Filter of a materialised column of distinct 64-bit hashes, of ``cells`` to 2 * ``cells`` bits each up to
    2**MOST_BITS in all; beyond that it lets more through. Chunks are built where their hashes meet,
    so that only the bits themselves reach the driver."""
    bits = min(max((cells * max(df.count(), 1) - 1).bit_length(), 20), MOST_BITS)
    mask = np.uint64((1 << bits) - 1)
    size = (1 << bits) // CHUNKS // 8

    def build(batches):
        chunks: dict[int, np.ndarray] = {}
        for batch in batches:
            h = batch.column(0).to_numpy().view(np.uint64)
            cells = np.concatenate(_cells(h, mask)).astype(np.int64)
            cells.sort()
            for part in np.split(cells, np.flatnonzero(np.diff(cells // (8 * size))) + 1) if len(cells) else ():
                c = int(part[0]) // (8 * size)
                held = chunks.setdefault(c, np.zeros(size, np.uint8))
                np.bitwise_or.at(held, part // 8 - c * size, (1 << (part % 8)).astype(np.uint8))
        yield pa.RecordBatch.from_arrays([pa.array(list(chunks), pa.int32()), pa.array([c.tobytes() for c in chunks.values()], pa.binary())], names=["c", "bits"])

    found = df.select(name).repartition(F.col(name).bitwiseAND(F.lit(CHUNKS - 1))).mapInArrow(build, "c int, bits binary").toArrow()
    packed = np.zeros((CHUNKS, size), np.uint8)
    for c, chunk in zip(found.column("c").to_pylist(), found.column("bits").to_pylist(), strict=True):
        packed[c] |= np.frombuffer(chunk, np.uint8)
    return BitFilter(packed.ravel())


# ------------------------------------------------------------------------ seeds


def _seeds(keyed: DataFrame, members: BitFilter | None = None, once: bool = False) -> DataFrame:
    """h, key, pos and reach of the winnowed k-grams of (key, text): those that may be in ``members``.
    reach says which windows choose a gram: those that start from reach // 8 to reach % 8 grams before it.
    ``once``: of each document only the first occurrence, and in place of reach whether there is another (again)."""

    def find(batches):
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            keys = batch.column(0).to_numpy()
            for a, b in slices(offsets):
                words = Words(data, offsets[a : b + 1], ALNUM)
                grams, at = words.grams(K)
                text = words.text_of[at]
                keep = winnow(grams, text, WINDOW)
                extra = np.zeros(len(keep), np.int8) if once else _reach(grams, text, keep)
                if members is not None:
                    held = members.may_hold(grams[keep])
                    keep, extra = keep[held], extra[held]
                text = text[keep]
                if once:
                    order = np.lexsort((keep, grams[keep], text))
                    g, t = grams[keep[order]], text[order]
                    new = np.ones(len(g), dtype=bool)
                    new[1:] = (g[1:] != g[:-1]) | (t[1:] != t[:-1])
                    extra = (np.diff(np.append(np.flatnonzero(new), len(new))) > 1).astype(np.int8)
                    keep, text = keep[order[new]], t[new]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(grams[keep].view(np.int64)), pa.array(keys[a:b][text]), pa.array((at[keep] - words.offsets[text]).astype(np.int32)), pa.array(extra)], names=["h", "key", "pos", last]
                )

    last = "again" if once else "reach"
    return keyed.mapInArrow(find, f"h bigint, key bigint, pos int, {last} tinyint")


def _reach(grams: np.ndarray, text: np.ndarray, keep: np.ndarray) -> np.ndarray:
    """Of each chosen gram, how far before it the first and the last window start that choose it.

    The windows of a text choose its grams in order; the next one takes over where it comes into the window, if it
    is no larger, else where the one before it leaves."""
    if not len(keep):
        return np.zeros(0, np.int8)
    first = np.searchsorted(text, text[keep], side="left")
    last = np.maximum(np.searchsorted(text, text[keep], side="right") - WINDOW, first)
    new = np.ones(len(keep), dtype=bool)
    new[1:] = text[keep][1:] != text[keep][:-1]
    low = first.copy()
    taken = np.where(grams[keep[1:]] <= grams[keep[:-1]], keep[1:] - WINDOW + 1, keep[:-1] + 1)
    low[1:] = np.where(new[1:], first[1:], taken)
    high = last.copy()
    high[:-1] = np.where(new[1:], last[:-1], low[1:] - 1)
    return (8 * (keep - low) + keep - high).astype(np.int8)


def _word_arrays(docs: DataFrame, keys: DataFrame, doc_id: str, text: str) -> DataFrame:
    """key and w, the 32-bit hashes of all words, of the documents in ``keys``."""
    key = row_key(doc_id, text)
    rows = maybe_members(docs.select(doc_id, text), key, keys).where("__maybe").select(key.alias("key"), F.col(text).cast("string").alias("text"))

    def hash_(batches):
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for a, b in slices(offsets):
                words = Words(data, offsets[a : b + 1], ALNUM)
                low = (words.hashes & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.ListArray.from_arrays(pa.array(words.offsets.astype(np.int32)), pa.array(low))], names=["key", "w"])

    return rows.mapInArrow(hash_, "key bigint, w array<int>").dropDuplicates(["key"]).join(keys, "key", "left_semi")


# --------------------------------------------------------------------- chaining


def fragments(pos: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, start in the other, words) of seed matches merged along diagonals; matches sorted by pos."""
    order = np.lexsort((pos, pos - other))
    p, o = pos[order], other[order]
    new = np.ones(len(p), dtype=bool)
    new[1:] = ((p - o)[1:] != (p - o)[:-1]) | (p[1:] - p[:-1] > K + WINDOW)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(p)) - 1
    return p[first], o[first], p[last] - p[first] + K


def all_fragments(pos: np.ndarray, seeds: np.ndarray, o_pos: np.ndarray, o_seeds: np.ndarray, most: int = 1 << 20) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As of ``fragments``, of the seeds of two documents, each at all of its places in both. Texts that repeat a few words have
    very many matches on few diagonals, so about ``most`` matches are made at a time and merged before the next ones."""
    order = np.argsort(o_seeds, kind="stable")
    known, first, count = np.unique(o_seeds[order], return_index=True, return_counts=True)
    at = np.minimum(np.searchsorted(known, seeds), max(len(known) - 1, 0))
    same = np.flatnonzero(known[at] == seeds) if len(known) else np.zeros(0, np.int64)
    first, count = first[at[same]], count[at[same]]
    parts = [[np.zeros(0, np.int64)] for _ in range(3)]
    for a, b in slices(np.concatenate([[0], np.cumsum(count)]), most):
        n = count[a:b]
        theirs = order[np.repeat(first[a:b] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        for part, x in zip(parts, fragments(np.repeat(pos[same[a:b]], n), o_pos[theirs]), strict=True):
            part.append(x)
    s, o, z = (np.concatenate(x) for x in parts)
    if len(parts[0]) < 3:
        return s, o, z
    order = np.lexsort((s, s - o))
    s, o, z = s[order], o[order], z[order]
    new = np.ones(len(s), dtype=bool)
    new[1:] = ((s - o)[1:] != (s - o)[:-1]) | (s[1:] - (s + z - K)[:-1] > K + WINDOW)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(s)) - 1
    return s[first], o[first], s[last] + z[last] - s[first]


class Reach:
    """Ends of chains within ``MOST_GAP`` words, by their end in the other document, in Fenwick trees.

    The other document is cut into blocks of ``MOST_GAP + 1`` words, so the ends that a fragment can
    follow are the last ones of one block and the first ones of the next: a tree of maxima
    over each block's beginnings and one over its tails answer in logarithmic time. A tree's node holds
    the falling maxima of its ends in the order of the sweep, whose front leaves once it lies too far back.
    """

    SIZE = MOST_GAP + 1

    def __init__(self):
        self.heads: dict[int, list[deque]] = {}
        self.tails: dict[int, list[deque]] = {}

    def add(self, o_end: int, end: int, value: float, fragment: int) -> None:
        block, at = divmod(o_end, self.SIZE)
        for trees, k in ((self.heads, at + 1), (self.tails, self.SIZE - at)):
            tree = trees.get(block)
            if tree is None:
                tree = trees[block] = [deque() for _ in range(self.SIZE + 1)]
            while k <= self.SIZE:
                node = tree[k]
                while node and node[-1][1] <= value:
                    node.pop()
                node.append((end, value, fragment))
                k += k & -k

    def best(self, o_start: int, start: int) -> tuple[float, int]:
        """(value, fragment) of the best end in [o_start - MOST_GAP, o_start] that lies at most MOST_GAP before ``start``."""
        block, at = divmod(o_start, self.SIZE)
        found = (-1e18, -1)
        for tree, k in ((self.heads.get(block), at + 1), (self.tails.get(block - 1), self.SIZE - 1 - at)):
            while tree is not None and k > 0:
                node = tree[k]
                while node and node[0][0] < start - MOST_GAP:
                    node.popleft()
                if node and node[0][1] > found[0]:
                    found = node[0][1:]
                k -= k & -k
        return found


def chains(start: np.ndarray, other: np.ndarray, size: np.ndarray) -> list[list[int]]:
    """Local chains of fragments, each a list of indexes in order.

    A fragment follows the chain that maximises score - GAP_COST * (words between, on
    both sides), among fragments that end at most MOST_GAP words before it on both sides.
    Ends enter the trees as the sweep over starts passes them. A chain starts anew where
    following would cost more than it brings.
    """
    n = len(start)
    if n == 1:
        return [[0]]
    by_start = np.argsort(start, kind="stable").tolist()
    by_end = np.argsort(start + size, kind="stable").tolist()
    s, o, z = start.tolist(), other.tolist(), size.tolist()
    reach, score, back, done = Reach(), [0.0] * n, [-1] * n, 0
    for j in by_start:
        while done < n and s[by_end[done]] + z[by_end[done]] <= s[j]:
            i = by_end[done]
            end, o_end = s[i] + z[i], o[i] + z[i]
            reach.add(o_end, end, score[i] + GAP_COST * (end + o_end), i)
            done += 1
        best, last = reach.best(o[j], s[j])
        score[j] = float(z[j])
        gain = best - GAP_COST * (s[j] + o[j])
        if last >= 0 and gain > 0:
            score[j] += gain
            back[j] = last
    used, out = [False] * n, []
    for j in sorted(range(n), key=lambda x: -score[x]):
        path = []
        while j >= 0 and not used[j]:
            used[j] = True
            path.append(j)
            j = back[j]
        if path:
            out.append(path[::-1])
    return out


def stretches(pos: np.ndarray, reach: np.ndarray, least: int) -> Iterator[tuple[int, int]]:
    """[first, after) where windows of ``least`` words can lie that other documents hold: all seeds that such a
    window's own words choose are matched, so the windows of ``WINDOW`` grams in it are those of matched seeds without a gap."""
    pos, where = np.unique(pos, return_index=True)
    if not len(pos):
        return
    low, high = pos - reach[where] // 8, pos - reach[where] % 8
    cuts = np.flatnonzero(low[1:] != high[:-1] + 1) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(pos)], strict=True):
        first, after = int(low[a]), int(high[b - 1]) + K + WINDOW - 1
        if after - first >= least:
            yield first, after


def _candidates(key: int, other: int, s: np.ndarray, o: np.ndarray, z: np.ndarray) -> Iterator[tuple]:
    """key, other, first, after, o_first, o_after and frags of the chains of two documents' fragments that can be passages."""
    for path in chains(s, o, z):
        a, b = path[0], path[-1]
        if sum(1 + (z[i] > K) for i in path) >= LEAST_SEEDS and s[b] + z[b] - s[a] >= LEAST_SPAN:
            yield key, other, int(s[a]), int(s[b] + z[b]), int(o[a]), int(o[b] + z[b]), [int(x) for i in path for x in (s[i], o[i], z[i])]


def _chained(matches: DataFrame, words: int = LEAST_WORDS) -> DataFrame:
    """key, other, first, after, o_first, o_after and frags (start, other start, words) of the
    chains of (key, other, pos, o_pos, reach) that can be passages; and, with other null, first and
    after of each stretch of a document that may hold exact windows.

    With columns h and crowded, also, with other and first null, the seeds and their places (frags, 2 * place + crowded)
    of each document that has a crowded one."""
    schema = "key bigint, other bigint, first int, after int, o_first int, o_after int, frags array<int>, seeds array<bigint>"
    seeded = "h" in matches.columns

    def run(batches: Iterator[pa.RecordBatch]):
        held: list[np.ndarray] | None = None
        for batch in batches:
            now = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if held is not None:
                now = [np.concatenate([h, c]) for h, c in zip(held, now, strict=True)]
            if not len(now[0]):
                continue
            cut = np.flatnonzero(now[0][1:] != now[0][:-1]) + 1
            last = int(cut[-1]) if len(cut) else 0
            held = [c[last:] for c in now]
            yield from emit([c[:last] for c in now])
        if held is not None:
            yield from emit(held)

    def emit(now):
        if not len(now[0]):
            return
        key = np.flatnonzero(now[0][1:] != now[0][:-1]) + 1
        cut = np.flatnonzero((now[0][1:] != now[0][:-1]) | (now[1][1:] != now[1][:-1])) + 1
        bounds = [0, *cut.tolist(), len(now[0])]
        rows = [(*r, None) for a, b in zip(bounds, bounds[1:], strict=False) if b - a > 1 for r in _candidates(int(now[0][a]), int(now[1][a]), *fragments(now[2][a:b].astype(np.int64), now[3][a:b].astype(np.int64)))]
        bounds = [0, *key.tolist(), len(now[0])]
        rows += [(int(now[0][a]), None, x, y, None, None, None, None) for a, b in zip(bounds, bounds[1:], strict=False) for x, y in stretches(*[now[c][a:b][now[1][a:b] < now[0][a:b]] for c in (2, 4)], words)]
        for a, b in zip(bounds, bounds[1:], strict=False) if seeded else ():
            if now[6][a:b].any():
                pos, where = np.unique(now[2][a:b], return_index=True)
                rows.append((int(now[0][a]), None, None, None, None, None, 2 * pos + now[6][a:b][where], now[5][a:b][where]))
        columns = list(zip(*rows, strict=True)) or [[] for _ in range(8)]
        kinds = [pa.int64(), pa.int64(), *[pa.int32()] * 4, pa.list_(pa.int32()), pa.list_(pa.int64())]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=["key", "other", "first", "after", "o_first", "o_after", "frags", "seeds"])

    names = ["key", "other", "pos", "o_pos", "reach", *["h", "crowded"] * seeded]
    return matches.select(*names).repartition("key").sortWithinPartitions("key", "other", "pos", "o_pos").mapInArrow(run, schema)


# ------------------------------------------------------------------------ links


def seed_pairs(pos: np.ndarray, seeds: np.ndarray, crowded: np.ndarray, least: int, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, place of the first, place of the second) of all two seeds of a document, in order of place, of which one is
    crowded and that lie ``least`` to ``most`` words apart."""
    i, step = [np.zeros(0, np.int64)], 1
    while step < len(pos):
        apart = pos[step:] - pos[:-step]
        near = np.flatnonzero((apart >= least) & (apart <= most) & (crowded[step:] | crowded[:-step]))
        if apart.min() > most:
            break
        i.append(near * len(pos) + near + step)
        step += 1
    i, j = np.divmod(np.concatenate(i), max(len(pos), 1))
    h = seeds.view(np.uint64)
    return mix(h[i] + mix(h[j])), pos[i], pos[j]


def _links(held: DataFrame, members: BitFilter | None = None) -> DataFrame:
    """l and key, once each, of the two seeds each of (key, frags, seeds, c) that no span in ``c`` holds both; or of those that may
    be in ``members``."""

    step = MOST_GAP + K
    # A chain's seeds are ``step`` words apart at most and its ends ``LEAST_SPAN - K`` at least, so it has two seeds so far apart, one
    # of them crowded unless its ends met already. In the other document words may be missing or added.
    bounds = (LEAST_SPAN - K, step + LEAST_SPAN - K - 1) if members is None else (1, step + 2 * (LEAST_SPAN - K))

    def find(batches):
        for batch in batches:
            links, keys = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            for i in range(batch.num_rows):
                pos, seeds = (batch.column(c)[i].values.to_numpy() for c in (1, 2))
                link, a, b = seed_pairs((pos >> 1).astype(np.int64), seeds, (pos & 1).astype(bool), *bounds)
                if members is None:
                    keep = np.ones(len(link), dtype=bool)
                    for x in batch.column(3)[i].as_py() or ():
                        keep &= (a < x["first"]) | (b + K > x["after"])
                else:
                    keep = members.may_hold(link)
                links.append(np.unique(link[keep]))
                keys.append(np.full(len(links[-1]), batch.column(0)[i].as_py()))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(links).view(np.int64)), pa.array(np.concatenate(keys))], names=["l", "key"])

    return held.mapInArrow(find, "l bigint, key bigint")


def _open_links(held: DataFrame, done: DataFrame) -> DataFrame:
    """l, key and asks: the documents (asks) with two seeds which no passage in ``done`` covers, and all documents that hold these two;
    ``held`` are the seeds (key, frags, seeds). A chain has two seeds at least, so no pair but of an asking document and one of smaller
    key that holds the link can have one that is open."""
    left = materialize(_links(_with_spans(held, done)))
    often = bit_filter(materialize(left.select("l").distinct()), "l")
    there = _links(held.select("key", "frags", "seeds"), often).select("l", F.col("key").alias("other"))
    there = there.where("l is not null and other is not null").repartition("l")  # as the joins have it, so that one exchange serves all
    asked = _one_of_alike(left, there)
    found = there.join(asked.select("l").distinct(), "l", "left_semi").select("l", F.col("other").alias("key"), F.lit(False).alias("asks"))
    return materialize(asked.select("l", "key", F.lit(True).alias("asks")).union(found))


def _one_of_alike(left: DataFrame, there: DataFrame) -> DataFrame:
    """Of the links of a document that the same documents hold, as all in one line are, one: it brings all pairs that the others bring."""
    ours = there.groupBy("l").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("other")).alias("x"), F.min("other").alias("least"), F.max("other").alias("most"))
    return left.join(ours, "l").where("least < key").groupBy("key", "n", "x", "least", "most").agg(F.min("l").alias("l")).select("l", "key")


def _with_spans(held: DataFrame, done: DataFrame) -> DataFrame:
    spans = done.groupBy("key").agg(F.collect_list(F.struct("first", "after")).alias("c"))
    return held.join(spans, "key", "left").select("key", "frags", "seeds", "c")


# -------------------------------------------------------------------- alignment


def _gap(a: np.ndarray, b: np.ndarray) -> int:
    """Most words that two short gaps have in common, in order."""
    if not len(a) or not len(b):
        return 0
    row = np.zeros(len(b) + 1, np.int64)
    for x in a:
        match = row[:-1] + (b == x)
        row[1:] = np.maximum(row[1:], match)
        np.maximum.accumulate(row, out=row)
    return int(row[-1])


#: Words that an extension skips at most on a side to go on, and equal words that it then needs.
MOST_SKIP, RESUME = 4, 2
_SKIPS = sorted(((i, j) for i in range(MOST_SKIP + 1) for j in range(MOST_SKIP + 1) if i or j), key=lambda s: (max(s), abs(s[0] - s[1])))


def _extend(a: list[int], b: list[int]) -> tuple[int, int, int]:
    """(words of a, words of b, equal ones) that an extension takes: over equal words and short differences,
    to the best sum of +1 for an equal word and -2 for one skipped."""
    i = j = matched = lost = 0
    best = (0, 0, 0, 0)
    n, m = len(a), len(b)
    while i < n and j < m:
        if a[i] == b[j]:
            i, j, matched = i + 1, j + 1, matched + 1
            if matched - 2 * lost > best[0]:
                best = (matched - 2 * lost, i, j, matched)
            continue
        for di, dj in _SKIPS:
            if a[i + di : i + di + RESUME] == b[j + dj : j + dj + RESUME] and i + di + RESUME <= n and j + dj + RESUME <= m:
                i, j, lost = i + di, j + dj, lost + max(di, dj)
                break
        else:
            break
    return best[1:]


def align(frags: list[int], a: np.ndarray, b: np.ndarray, a0: int, b0: int, least: int = 0) -> tuple[int, int, int, int, int]:
    """(first, after, o_first, o_after, matched) of a chain, extended; ``a`` and ``b`` hold the
    words from a0 and b0 on. One of fewer than ``least`` words is not looked into: it has no matched words."""
    f = np.array(frags).reshape(-1, 3)
    first, o_first = f[0][0] - a0, f[0][1] - b0
    after, o_after = f[-1][0] + f[-1][2] - a0, f[-1][1] + f[-1][2] - b0
    left, o_left, same = _extend(a[:first][::-1].tolist(), b[:o_first][::-1].tolist())
    right, o_right, more = _extend(a[after:].tolist(), b[o_after:].tolist())
    ends = int(first - left + a0), int(after + right + a0), int(o_first - o_left + b0), int(o_after + o_right + b0)
    if ends[1] - ends[0] < least:
        return *ends, 0
    matched = 0
    for k, (s, o, z) in enumerate(f):
        matched += int((a[s - a0 : s - a0 + z] == b[o - b0 : o - b0 + z]).sum())
        if k:
            ps, po, pz = f[k - 1]
            matched += _gap(a[ps + pz - a0 : s - a0], b[po + pz - b0 : o - b0])
    return *ends, matched + same + more


def _aligned(found: DataFrame, words: DataFrame, least: int, share: float) -> DataFrame:
    """Passages (key, first, after, other, o_first, o_after, matched) of the chains that hold up."""
    part = lambda a, b: F.slice("w", F.greatest(F.col(a) - SLACK, F.lit(0)) + 1, F.col(b) - F.greatest(F.col(a) - SLACK, F.lit(0)) + SLACK)
    one = found.join(words, "key").withColumn("a", part("first", "after")).drop("w")
    two = one.join(words.withColumnRenamed("key", "other"), "other").withColumn("b", part("o_first", "o_after")).drop("w")
    names = ["key", "first", "after", "other", "o_first", "o_after", "matched"]

    def run(batches):
        for batch in batches:
            keys, others, firsts, o_firsts = (batch.column(i).to_numpy() for i in range(4))
            rows = []
            for i in range(batch.num_rows):
                a, b = (batch.column(c)[i].values.to_numpy(zero_copy_only=False) for c in (5, 6))
                s, e, o, p, matched = align(batch.column(4)[i].as_py(), a, b, max(int(firsts[i]) - SLACK, 0), max(int(o_firsts[i]) - SLACK, 0), least)
                if e - s >= least and matched >= share * max(e - s, p - o):
                    rows.append((int(keys[i]), s, e, int(others[i]), o, p, matched))
            columns = list(zip(*rows, strict=True)) or [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], names=names)

    return two.select("key", "other", "first", "o_first", "frags", "a", "b").mapInArrow(run, ", ".join(f"{n} bigint" for n in names))


# --------------------------------------------------------------- the second round


def passage_ends(own: np.ndarray, other: np.ndarray, least: int, share: float) -> np.ndarray:
    """For each place of the words ``own`` the last end of what can be a passage, of ``least`` words and more, that begins there or
    before it and that the words ``other`` hold; -1 for none. What goes beyond it lies in no passage of the two.

    A passage of n words has at least ``share`` * n of them in the other document; and as a word without a partner parts two pairs of
    neighbours in one document and one in the other, (3 * share - 2) * n - 1 pairs of neighbours at least are neighbours there too."""
    pairs = lambda w: (w[:-1].astype(np.int64) << 32) | (w[1:].astype(np.int64) & 0xFFFFFFFF)
    out = np.full(len(own), len(own), np.int64)
    for mine, theirs, part, more in ((own, other, share, 0), (pairs(own), pairs(other), 3 * share - 2, 1)):
        hit = np.isin(mine, theirs)
        total = np.concatenate([[0.0], np.cumsum(hit - part)])
        high = np.maximum.accumulate(total[::-1])
        ends = len(mine) - np.searchsorted(high, total + (part - 1) * more - 1e-6) + more
        ends[ends < np.arange(len(ends)) + least] = -1
        ends = np.maximum.accumulate(ends)
        out = np.minimum(out, ends[: len(own)])
    return out


def slice_hashes(low: np.ndarray, first: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Hashes of the words [first, after) of 32-bit word hashes, wherever they lie."""
    n = len(low)
    with np.errstate(over="ignore"):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((low.view(np.uint32).astype(np.uint64) + np.uint64(1)) * powers(n + 1)[:n], dtype=np.uint64)])
        down = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, pow(int(powers(2)[1]), -1, 1 << 64), np.uint64)]), dtype=np.uint64)
        return mix((total[after] - total[first]) * down[first] + (after - first).astype(np.uint64))


def pair_passages(key: int, other: int, frags: tuple[np.ndarray, np.ndarray, np.ndarray], a: np.ndarray, b: np.ndarray, done: list[tuple[int, int]], least: int, share: float) -> Iterator[tuple]:
    """Passages of two documents of words ``a`` and ``b`` from their fragments, at chains that no span in ``done`` covers. Texts that
    repeat themselves have very many chains between equal words: of those one is aligned for all. A passage within another of the two is left out."""
    found = [r for r in _candidates(key, other, *frags) if not any(x <= r[2] and r[3] <= y for x, y in done)]
    if not found:
        return
    bounds = np.array([r[2:6] for r in found], np.int64)
    low, o_low = np.maximum(bounds[:, 0] - SLACK, 0), np.maximum(bounds[:, 2] - SLACK, 0)
    high, o_high = np.minimum(bounds[:, 1] + SLACK, len(a)), np.minimum(bounds[:, 3] + SLACK, len(b))
    alike, met, spans = zip(slice_hashes(a, low, high).tolist(), slice_hashes(b, o_low, o_high).tolist(), strict=True), {}, []
    for r, same, x, y, o_x, o_y in zip(found, alike, low.tolist(), high.tolist(), o_low.tolist(), o_high.tolist(), strict=True):
        # Equal words around chains of the same shape: places in the slices, not in the texts.
        moved = (np.array(r[6]).reshape(-1, 3) - (x, o_x, 0)).ravel()
        shape = (*same, moved.tobytes())
        if shape not in met:
            met[shape] = align(moved, a[x:y], b[o_x:o_y], 0, 0, least)
        s, e, o, p, matched = met[shape]
        if e - s >= least and matched >= share * max(e - s, p - o):
            spans.append((s + x, e + x, o + o_x, p + o_x, matched))
    reach = -1
    for s, e, o, p, matched in sorted(set(spans), key=lambda t: (t[0], -t[1], -t[4], t[2])):
        if e > reach:
            reach = e
            yield key, s, e, other, o, p, matched


def _agree(hit: np.ndarray, least: int, share: float) -> np.ndarray:
    """Of each row of ``hit`` (whether the other document has the word, for each word), whether ``least`` words and more in
    a row can be a passage, as ``passage_ends`` says by words alone."""
    if hit.shape[1] < least:
        return np.zeros(len(hit), dtype=bool)
    total = np.zeros((len(hit), hit.shape[1] + 1))
    np.cumsum(hit, axis=1, out=total[:, 1:])
    total -= share * np.arange(total.shape[1])
    low = np.minimum.accumulate(total[:, : total.shape[1] - least], axis=1)
    return (total[:, least:] - low >= -1e-5).any(axis=1)


class Askers:
    """Documents that ask for a link, which meet its holders many at a time.

    Each is (key, pos, seeds, words, spans that are done, links it asks for), each holder (key, pos, seeds, words, links it holds). Two documents with several
    links in common meet at the smallest. A table of the askers' words by holders tells which of them agree in so many words that a passage
    can be; only these are looked into one by one."""

    def __init__(self, link: int, docs: list[tuple]):
        self.link, self.docs = link, docs
        self.known, where = np.unique(np.concatenate([d[3] for d in docs]), return_inverse=True)
        self.where = np.split(where, np.cumsum([len(d[3]) for d in docs])[:-1])

    def met(self, holders: list[tuple], least: int, share: float) -> Iterator[tuple[tuple, tuple]]:
        """Pairs (asker, holder) that can have a passage."""
        keys = np.array([h[0] for h in holders], np.int64)
        links = np.concatenate([h[4] for h in holders])
        held_by = np.repeat(np.arange(len(holders)), [len(h[4]) for h in holders])
        order = np.argsort(links, kind="stable")
        links, held_by = links[order], held_by[order]
        step = max(1, TABLE // len(self.known))
        for first in range(0, len(holders), step):
            part = holders[first : first + step]
            flat = np.concatenate([h[3] for h in part])
            row = np.repeat(np.arange(len(part)), [len(h[3]) for h in part])
            at = np.minimum(np.searchsorted(self.known, flat), len(self.known) - 1)
            same = self.known[at] == flat
            table = np.zeros((len(part), len(self.known)), dtype=bool)
            table[row[same], at[same]] = True
            for doc, words in zip(self.docs, self.where, strict=True):
                may = keys[first : first + step] < doc[0]
                for l in doc[5][doc[5] < self.link].tolist():
                    a, b = np.searchsorted(links, [l, l + 1])
                    other = held_by[a:b] - first
                    may[other[(other >= 0) & (other < len(part))]] = False
                which, most = np.flatnonzero(may), max(1, TABLE // 8 // max(len(words), 1))
                for some in np.split(which, range(most, len(which), most)):
                    for i in some[_agree(table[np.ix_(some, words)], least, share)].tolist():
                        yield doc, part[i]


def _doc_passages(one: tuple, two: tuple, least: int, share: float) -> Iterator[tuple]:
    """Passages of two documents of all their seeds at all places that can lie in one, where no span that is done covers the chains."""
    (key, pos, seeds, a, done, _), (other, o_pos, o_seeds, b, _) = one, two
    keep = passage_ends(a, b, least, share)[pos] >= pos + K
    if keep.any():
        back = passage_ends(b, a, math.ceil(share * least), share)[o_pos] >= o_pos + K
        frags = all_fragments(pos[keep], seeds[keep], o_pos[back], o_seeds[back])
        if len(frags[0]):
            yield from pair_passages(key, other, frags, a, b, done, least, share)


def _rest(links: DataFrame, held: DataFrame, done: DataFrame, words: DataFrame, least: int, share: float) -> DataFrame:
    """Passages, as of ``_aligned``, of the documents that ask for ``links`` (l, key, asks) with all that hold them and have a smaller key.

    Documents meet inside of tasks: those that ask for a link are dealt to blocks of about ``ASKERS``, those that hold it to blocks of
    about ``HOLDERS``, and each block of the one meets each of the other. A text travels once a block that it meets and no pair is a row."""
    parts = lambda asks, most: F.greatest(F.lit(1), F.ceil(F.sum(F.when(F.col("asks") == asks, 1).otherwise(0)) / most)).cast("int")
    sizes = links.groupBy("l").agg(parts(True, ASKERS).alias("na"), parts(False, HOLDERS).alias("nb"), F.max(F.when(F.col("asks"), F.col("key"))).alias("last"))
    listed = links.groupBy("key").agg(*[F.sort_array(F.collect_list(F.when(F.col("asks") == asks, F.col("l")))).alias(n) for asks, n in ((True, "asked"), (False, "found"))])
    texts = _with_spans(held, done).join(words, "key").join(listed, "key")
    own = lambda n: F.pmod(F.xxhash64("key"), F.col(n)).cast("int")
    met = (
        links.join(sizes, "l")
        .where("asks or key < last")
        .join(texts, "key")
        .select("l", "key", (~F.col("asks")).cast("tinyint").alias("holds"), own("na").alias("a"), own("nb").alias("b"), "frags", "seeds", "w", F.when(F.col("asks"), F.col("c")).alias("c"), F.when(F.col("asks"), F.col("asked")).otherwise(F.col("found")).alias("links"), F.explode(F.sequence(F.lit(0), F.when(F.col("asks"), F.col("nb")).otherwise(F.col("na")) - 1)).alias("x"))
        .withColumn("a", F.when(F.col("holds") == 0, F.col("a")).otherwise(F.col("x")))
        .withColumn("b", F.when(F.col("holds") == 0, F.col("x")).otherwise(F.col("b")))
        .select("l", "a", "b", "holds", "key", "frags", "seeds", "w", "links", "c")
    )
    names = ["key", "first", "after", "other", "o_first", "o_after", "matched"]

    def run(batches):
        group, askers, waiting = None, [], None
        for batch in batches:
            ls, blocks_a, blocks_b, holds, keys = (batch.column(c).to_numpy() for c in range(5))
            lists = [(x.values.to_numpy(), x.offsets.to_numpy()) for x in batch.columns[5:9]]
            take = lambda i: [values[offsets[i] : offsets[i + 1]] for values, offsets in lists]  # noqa: B023, E731
            cut = np.flatnonzero((np.diff(ls) != 0) | (np.diff(blocks_a) != 0) | (np.diff(blocks_b) != 0) | (np.diff(holds) != 0)) + 1
            rows = []
            for x, y in zip([0, *cut.tolist()], [*cut.tolist(), len(ls)], strict=True) if len(ls) else ():
                now = (int(ls[x]), int(blocks_a[x]), int(blocks_b[x]))
                if now != group:
                    group, askers, waiting = now, None, []
                docs = []
                for i in range(x, y):
                    frags, seeds, w, links = take(i)
                    docs.append((int(keys[i]), (frags >> 1).astype(np.int64), seeds, w))
                    docs[-1] += (links,) if holds[x] else ([(s["first"], s["after"]) for s in batch.column(9)[i].as_py() or ()], links)
                if not holds[x]:
                    # what outlives its batch is copied out of it
                    waiting += [(d[0], d[1], d[2].copy(), d[3].copy(), d[4], d[5].copy()) for d in docs]
                elif waiting:
                    askers = askers or Askers(group[0], waiting)
                    for one, two in askers.met(docs, least, share):
                        rows += _doc_passages(one, two, least, share)
            columns = list(zip(*rows, strict=True)) or [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], names=names)

    dealt = met.repartition("l", "a", "b").sortWithinPartitions("l", "a", "b", "holds", "key")
    return dealt.mapInArrow(run, ", ".join(f"{n} bigint" for n in names))


# ---------------------------------------------------------------- exact windows


def window_hashes(low: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all windows of ``size`` words, of 32-bit word hashes."""
    n = len(low) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        up = powers(len(low))[: len(low)]
        down = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, pow(int(powers(2)[1]), -1, 1 << 64), np.uint64)]), dtype=np.uint64)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((low.astype(np.uint64) + np.uint64(1)) * up, dtype=np.uint64)])
        # The factor of a position is odd and has an inverse: equal windows have equal sums wherever they lie.
        return mix((total[size:] - total[:-size]) * down)


def uncovered(low: np.ndarray, spans: list[tuple[int, int]], covered: list[tuple[int, int]], size: int) -> np.ndarray:
    """Starts of the windows in ``spans`` that lie in no single span of ``covered``."""
    n = max(len(low) - size + 1, 0)
    steps = [np.zeros(n + 1, np.int64), np.zeros(n + 1, np.int64)]
    for step, some in zip(steps, (spans, covered), strict=True):
        for first, after in some:
            a, b = min(first, n), min(after - size + 1, n)
            if b > a:
                step[a] += 1
                step[b] -= 1
    inside, done = (np.cumsum(step)[:n] > 0 for step in steps)
    return np.flatnonzero(inside & ~done)


def _targets(places: DataFrame, aligned: DataFrame, words: DataFrame, size: int) -> DataFrame:
    """h, key and pos of the windows in ``places`` (key, first, after) that no passage covers; pos are all
    places of the window in its document, as a text that repeats a few words is made of few windows."""
    listed = lambda df, name: df.groupBy("key").agg(F.collect_list(F.struct(F.col("first").cast("int").alias("first"), F.col("after").cast("int").alias("after"))).alias(name))
    rows = listed(places, "s").join(words, "key").join(listed(aligned, "c"), "key", "left").select("key", "w", "s", "c")

    def find(batches):
        for batch in batches:
            hs, keys, at, counts = ([np.zeros(0, kind)] for kind in (np.uint64, np.int64, np.int64, np.int64))
            for i in range(batch.num_rows):
                low = batch.column(1)[i].values.to_numpy(zero_copy_only=False).view(np.uint32)
                spans, covered = ([(x["first"], x["after"]) for x in batch.column(c)[i].as_py() or ()] for c in (2, 3))
                p = uncovered(low, spans, covered, size)
                if len(p):
                    h, which, n = np.unique(window_hashes(low, size)[p], return_inverse=True, return_counts=True)
                    hs.append(h)
                    keys.append(np.full(len(h), batch.column(0)[i].as_py()))
                    at.append(p[np.argsort(which, kind="stable")])
                    counts.append(n)
            h, ends = np.concatenate(hs), np.cumsum(np.concatenate(counts))
            places = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(np.concatenate(at).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(np.concatenate(keys)), places], names=["h", "key", "pos"])

    return rows.mapInArrow(find, "h bigint, key bigint, pos array<int>")


def _first_windows(keyed: DataFrame, members: BitFilter, size: int) -> DataFrame:
    """h, other and o_pos: the first occurrence of each window in ``members`` that occurs twice."""

    def find(batches):
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            keys = batch.column(0).to_numpy()
            for a, b in slices(offsets):
                words = Words(data, offsets[a : b + 1], ALNUM)
                h = window_hashes((words.hashes & np.uint64(0xFFFFFFFF)).astype(np.uint32), size)
                at = np.flatnonzero(words.text_of[: len(h)] == words.text_of[size - 1 :]) if len(h) else np.zeros(0, np.int64)
                at = at[members.may_hold(h[at])]
                # of each text the first place of a window: one that repeats a few words has few windows at many places
                order = np.lexsort((at, h[at], words.text_of[at]))
                at = at[order]
                new = np.ones(len(at), dtype=bool)
                new[1:] = (h[at[1:]] != h[at[:-1]]) | (words.text_of[at[1:]] != words.text_of[at[:-1]])
                at = at[new]
                text = words.text_of[at]
                yield pa.RecordBatch.from_arrays([pa.array(h[at].view(np.int64)), pa.array(keys[a:b][text]), pa.array((at - words.offsets[text]).astype(np.int32))], names=["h", "key", "pos"])

    found = keyed.mapInArrow(find, "h bigint, key bigint, pos int").groupBy("h")
    return found.agg(F.min(F.struct("key", "pos")).alias("o"), F.max("key").alias("last")).where("o.key <> last").select("h", F.col("o.key").alias("other"), F.col("o.pos").alias("o_pos"))


def _exact(keyed: DataFrame, places: DataFrame, aligned: DataFrame, words: DataFrame, size: int) -> DataFrame:
    """Passages, as of ``_aligned``, of the exact repeats of ``size`` words and more that it has not."""
    targets = materialize(_targets(places, aligned, words, size))
    firsts = materialize(_first_windows(keyed, bit_filter(materialize(targets.select("h").distinct()), "h", WINDOW_CELLS), size))
    met = targets.join(firsts, "h").where("key <> other").select("key", "other", "pos", "o_pos")
    # Of a pair of documents all windows meet: no more than the text of the first has.
    listed = met.groupBy("key", "other").agg(F.collect_list(F.struct("pos", "o_pos")).alias("windows"))
    names = ["key", "first", "after", "other", "o_first", "o_after", "matched"]

    def merge(batches):
        """Windows that follow one another are one passage, also where a repeated unit lets the other's place jump back."""
        for batch in batches:
            parts = [[] for _ in names]
            for i in range(batch.num_rows):
                windows = batch.column(2)[i].values
                places, o_pos = windows.field("pos"), windows.field("o_pos").to_numpy()
                pos = places.flatten().to_numpy()
                other = np.repeat(o_pos, np.diff(places.offsets.to_numpy()))
                order = np.argsort(pos, kind="stable")
                pos, other = pos[order].astype(np.int64), other[order].astype(np.int64)
                start = np.flatnonzero(np.concatenate([[True], np.diff(pos) > 1]))
                end = np.append(start[1:], len(pos)) - 1
                first, after = pos[start], pos[end] + size
                own = (batch.column(0)[i].as_py(), first, after, batch.column(1)[i].as_py(), np.minimum.reduceat(other, start), np.maximum.reduceat(other, start) + size, after - first)
                for part, x in zip(parts, own, strict=True):
                    part.append(x if isinstance(x, np.ndarray) else np.full(len(start), x, np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(p) if p else np.zeros(0, np.int64)) for p in parts], names=names)

    return listed.mapInArrow(merge, ", ".join(f"{n} bigint" for n in names))


# --------------------------------------------------------------------- operator


def passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST_WORDS, share: float = LEAST_SHARE) -> DataFrame:
    """key, first, after (words), other, o_first, o_after, matched: passages of a document that
    the document ``other``, of a smaller row key, holds as well; of two documents none within another."""
    keyed = docs.select(row_key(doc_id, text).alias("key"), F.col(text).cast("string").alias("text"))
    # Rows of equal key are one document and have equal positions.
    ends = [f(*x).alias(n) for n, f, x in (("k0", F.min, ["key"]), ("p0", F.min_by, ["pos", "key"]), ("k1", F.max, ["key"]), ("p1", F.max_by, ["pos", "key"]))]
    holders = _seeds(keyed, once=True).groupBy("h").agg(*ends, F.count("*").alias("n"), F.max("again").alias("again"))
    # Of up to three holders the first and the last meet all, at all places if each has one; more are a crowd.
    shared = materialize(holders.where("k0 <> k1").select("h", "k0", "p0", "k1", "p1", ((F.col("n") > 3) | (F.col("again") > 0)).alias("crowded")))
    met = _seeds(keyed, bit_filter(shared, "h")).join(shared, "h")
    each = F.array(*[F.struct(F.col(f"k{i}").alias("other"), F.col(f"p{i}").alias("o_pos")) for i in range(2)])
    matches = met.select("key", "pos", "reach", "h", "crowded", F.explode(each).alias("o")).where("key <> o.other").select("key", F.col("o.other").alias("other"), "pos", F.col("o.o_pos").alias("o_pos"), "reach", "h", "crowded")
    found = materialize(_chained(matches, least))
    del shared, met, matches  # what nothing names any more can leave the checkpoint folder
    chained = found.where("other is not null").drop("seeds")
    held = found.where("seeds is not null").select("key", "frags", "seeds")
    keys = materialize(found.select("key").union(chained.select("other")).distinct())
    words = materialize(_word_arrays(docs, keys, doc_id, text))
    aligned = materialize(_owned(_aligned(chained, words, least, share)))
    exact = _exact(keyed, found.where("first is not null and other is null").select("key", "first", "after"), aligned, words, least)
    done = materialize(aligned.union(exact))
    del aligned, exact
    if held.isEmpty():
        return materialize(_longest(done))
    rest = materialize(_owned(_rest(_open_links(held, done), held, done, words, least, share)))
    return materialize(_longest(done.union(rest)))


def _longest(passages: DataFrame) -> DataFrame:
    """Without the passages that lie, in their document, within another one of the same two documents."""
    before = Window.partitionBy("key", "other").orderBy("first", F.desc("after"), F.desc("matched"), "o_first", "o_after")
    reach = F.max("after").over(before.rowsBetween(Window.unboundedPreceding, -1))
    return passages.withColumn("reach", reach).where("reach is null or after > reach").drop("reach")


def _owned(passages: DataFrame) -> DataFrame:
    """A passage belongs to the document of larger key, whichever of the two was matched with the other."""
    swap = {"key": "other", "first": "o_first", "after": "o_after", "other": "key", "o_first": "first", "o_after": "after"}
    return passages.select(*[F.when(F.col("key") > F.col("other"), F.col(n)).otherwise(F.col(swap.get(n, n))).alias(n) for n in passages.columns]).distinct()


def cut(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n_chars: str = "n_chars", **settings) -> DataFrame:
    """``docs`` without the passages that a document of smaller row key holds; documents of
    which no word is left go. ``n_chars``, if it is a column, is counted anew where a text changed."""
    names, counted = docs.columns, n_chars in docs.columns
    docs, (doc_id, text, n_chars) = numbered_columns(docs, doc_id, text, n_chars if counted else text)
    found = passages(docs, doc_id, text, **settings)
    runs = materialize(merge_spans(found, "key")).withColumnsRenamed({"key": "__key", "runs": "__runs"})
    key = row_key(doc_id, text)
    marked = maybe_members(docs, key, runs.select("__key"))
    touched = marked.where("__maybe").withColumn("__own", key)
    hit = touched.join(runs, touched["__own"] == runs["__key"], "left").select(*docs.columns, "__runs")
    at = docs.columns.index(text)

    def remove(batches):
        for batch in batches:
            data, offsets = text_bytes(batch.column(at))
            out, changed, keep = [], [], []
            for a, b in slices(offsets):
                words = Words(data, offsets[a : b + 1], ALNUM, hashes=False)
                raw = words.bytes.tobytes()
                own = offsets[a : b + 1] - offsets[a]
                for i in range(b - a):
                    lo, hi = own[i], own[i + 1]
                    runs = batch.column(len(docs_columns))[a + i].as_py()
                    if not runs:
                        out.append(batch.column(at)[a + i].as_py())
                        changed.append(False)
                        keep.append(True)
                        continue
                    starts = words.starts[words.offsets[i] : words.offsets[i + 1]]
                    parts, cursor, left = [], lo, len(starts)
                    for r in runs:
                        parts.append(raw[cursor : starts[r["first"]]])
                        cursor = starts[r["after"]] if r["after"] < len(starts) else hi
                        left -= r["after"] - r["first"]
                    out.append(b"".join([*parts, raw[cursor:hi]]).decode("utf-8", "replace"))
                    changed.append(True)
                    keep.append(left > 0)
            columns = [pa.array(out, pa.string()) if j == at else batch.column(j) for j in range(len(docs_columns))]
            made = pa.RecordBatch.from_arrays([*columns, pa.array(changed, pa.bool_())], names=[*docs_columns, "__changed"])
            yield made.filter(pa.array(keep, pa.bool_()))

    docs_columns = docs.columns
    schema = StructType([*docs.schema.fields, *StructType.fromDDL("__changed boolean").fields])
    mended = hit.mapInArrow(remove, schema)
    if counted:
        length = F.when(F.col("__changed"), F.char_length(text)).otherwise(F.col(n_chars))
        mended = mended.withColumn(n_chars, length.cast(docs.schema[n_chars].dataType))
    return marked.where("not __maybe").select(*docs.columns).union(mended.select(*docs.columns)).toDF(*names)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2: every passage of a document that another one holds too, with both ids; documents
    without such passages have no row."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = passages(docs)
    ids = materialize(docs.select(row_key("doc_id", "text").alias("key"), "doc_id").distinct())
    named = found.join(ids, "key").join(ids.withColumnsRenamed({"key": "other", "doc_id": "source_doc_id"}), "other")
    return named.select(
        "doc_id", F.col("first").alias("first_word"), F.col("after").alias("after_word"), "source_doc_id", F.col("o_first").alias("source_first_word"), F.col("o_after").alias("source_after_word"), F.col("matched").alias("matched_words")
    )

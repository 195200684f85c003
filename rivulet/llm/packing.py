"""Best-fit packing of tokenised documents into sequences of bounded length (operator 11).

A document is its tokens and an end token; one longer than a sequence is cut into full pieces, of which
the first may be shorter. Sequences are planned over *lengths*, not pieces: what must be known of
the corpus is how many pieces have each length, ``CAP`` numbers however large it is. The plan is made
by exact complements: for each length, from the longest on, tables indexed by sum are asked for a single
length, a pair or a triple that fills the gap exactly; the pattern is used as often as its lengths are
available. What finds no complement is packed best fit, longest first, again by whole classes of
equal sequences. Plain best fit over all lengths is tried too; the plan of fewer sequences is taken.

Pieces get their number among those of their length from counts: an Arrow pass numbers them within its
partition, and a window over (length, partition) counts shifts the numbers. The plan gives each
pattern a range of these numbers, so a piece's sequence and offset follow from its length and number by a
binary search; no piece meets another one, and no length is a hot key.

Ids come from the public library. Texts are split as its byte-level pattern splits them, by whole-array
operations on code points, and the library encodes each distinct word of a worker once; a
text with code points whose class differs between Unicode versions is encoded by it as a whole. Very
long texts are split in parts before white space that follows none, which is always a word's end.

Defined results: a null or empty text is the end token alone; a null id is kept; repeated rows are packed each;
an empty table gives no pieces; other columns are ignored.
"""

from __future__ import annotations

import functools
import os
import sys
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import materialize, slices, text_bytes

CAP = 2048
END = 0
#: Bytes of text worked on together, and distinct words that a worker remembers.
SLICE, MOST_WORDS = 3 << 20, 1 << 20
#: Words that the library gets at once.
TOGETHER = 2000

LETTER, NUMBER, OTHER, SPACE, UNSURE, UNSEEN = range(6)
#: White space of Unicode.
_WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


# ------------------------------------------------------------------- encoding


class Encoder:
    """Ids of whole texts by the library, each distinct word once."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True  # their strings in a text are ordinary text
        self.kind = np.full(sys.maxunicode + 1, UNSEEN, np.uint8)
        self.kind[_WHITE] = SPACE
        vocabulary_ = self.library.get_vocab()
        self.bytes = np.zeros(max(vocabulary_.values()) + 1, np.int64)  # a token has a sign for each byte
        self.bytes[list(vocabulary_.values())] = [len(t) for t in vocabulary_]
        numbers = np.arange(1, 257, dtype=np.uint64)
        self.scatter = numbers * np.uint64(0x9E3779B97F4A7C15)
        self.forget()

    def forget(self) -> None:
        self.known, self.second = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.first, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.uint32)

    def _classes(self, codes: np.ndarray) -> np.ndarray:
        kind = self.kind[codes]
        if (kind == UNSEEN).any():
            old = unicodedata.ucd_3_2_0
            for c in np.unique(codes[kind == UNSEEN]).tolist():
                now, before = unicodedata.category(chr(c)), old.category(chr(c))
                self.kind[c] = UNSURE if now[0] != before[0] or now == "Cn" else {"L": LETTER, "N": NUMBER}.get(now[0], OTHER)
            kind = self.kind[codes]
        return kind

    def words(self, codes: np.ndarray, kind: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Where the words start. ``first``: the places where texts start.

        Letters, digits and other signs are runs; the last of several white spaces stands alone or, a blank,
        begins the next word; an apostrophe takes the letters of an English short form with it."""
        n = len(codes)
        if not n:
            return np.zeros(0, np.int64)
        begins = np.ones(n + 1, dtype=bool)
        begins[1:n] = kind[1:] != kind[:-1]
        begins[first[first < n]] = True
        fresh = np.zeros(n + 1, dtype=bool)  # where a text starts or ends
        fresh[first], fresh[n] = True, True
        ends = np.flatnonzero(begins[1:]) + 1
        white = ends[(kind[ends - 1] == SPACE) & ~fresh[ends]]
        blank = codes[white - 1] == 0x20
        begins[white - 1] = True
        begins[white[blank]] = False
        quote = np.flatnonzero((codes[:-1] == 0x27) & (kind[1:] == LETTER) & begins[: n - 1] & ~fresh[1:n]) if n > 1 else np.zeros(0, np.int64)
        if len(quote):
            padded = np.append(codes, [0, 0])
            one, two = padded[quote + 1], padded[quote + 2]
            two = np.where(fresh[np.minimum(quote + 2, n)], 0, two)
            short = np.isin(one, [ord(c) for c in "stmd"])
            long = ~short & (((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l"))))
            begins[quote[short | long] + 1] = False
            begins[quote[short] + 2] = True
            begins[np.minimum(quote[long] + 3, n)] = True
        return np.flatnonzero(begins[:n])

    def _hashes(self, codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lens = np.diff(np.append(starts, len(codes)))
        place = np.arange(len(codes)) - np.repeat(starts, lens)
        spread = self.scatter[place & 255] ^ (place >> 8).astype(np.uint64)
        wide = codes.astype(np.uint64) + np.uint64(1)
        out = []
        with np.errstate(over="ignore"):
            for salt in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F):
                x = (wide ^ spread) * np.uint64(salt)
                x ^= x >> np.uint64(31)
                x *= np.uint64(0x9E3779B97F4A7C15)
                x ^= x >> np.uint64(29)
                out.append(np.add.reduceat(x, starts) + lens.astype(np.uint64))
        return out[0], out[1]

    def _library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _distinct(self, words: list[str], joinable: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, count for each word). Words that begin with a blank and hold no other white space
        stay words when they are joined; their ids are told apart by the bytes of the tokens."""
        counts, parts = np.zeros(len(words), np.int64), []
        together, alone = np.flatnonzero(joinable), np.flatnonzero(~joinable)
        for a in range(0, len(together), TOGETHER):
            own = [words[i] for i in together[a : a + TOGETHER].tolist()]
            ids = np.array(self._library(["".join(own)])[0], np.uint32)
            ends = np.cumsum([len(w.encode()) for w in own])
            bounds = np.searchsorted(np.cumsum(self.bytes[ids]), ends, side="right")
            counts[together[a : a + TOGETHER]] = np.diff(bounds, prepend=0)
            parts.append(ids)
        found = self._library([words[i] for i in alone.tolist()])
        counts[alone] = np.fromiter(map(len, found), np.int64, len(found))
        parts.append(np.fromiter((i for ids in found for i in ids), np.uint32, int(counts[alone].sum())))
        ids, order = np.concatenate(parts), np.concatenate([together, alone])
        first = np.empty(len(words), np.int64)
        first[order] = np.cumsum(counts[order]) - counts[order]
        return ids[np.repeat(first - (np.cumsum(counts) - counts), counts) + np.arange(len(ids))], counts

    def slice(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, n + 1 offsets) of texts."""
        raw = data[offsets[0] : offsets[-1]]
        text = raw.tobytes().decode()
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        lead = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])  # code points before each byte
        own = lead[offsets - offsets[0]]
        n = len(own) - 1
        if not len(codes):
            return np.zeros(0, np.uint32), np.zeros(n + 1, np.int64)
        kind = self._classes(codes)
        odd = np.zeros(n, dtype=bool)
        odd[np.searchsorted(own, np.flatnonzero(kind == UNSURE), side="right") - 1] = True
        starts = self.words(codes, kind, own[:-1])
        one, two = self._hashes(codes, starts)
        words, where, which = np.unique(one, return_index=True, return_inverse=True)
        if len(self.known) + len(words) > MOST_WORDS and len(self.known):
            self.forget()
        at = np.searchsorted(self.known, words)
        new = np.ones(len(words), dtype=bool)
        inside = at < len(self.known)
        new[inside] = self.known[at[inside]] != words[inside]
        if new.any():
            begin, end = starts[where[new]], np.append(starts[1:], len(codes))[where[new]]
            second = np.minimum(begin + 1, len(codes) - 1)
            joinable = (codes[begin] == 0x20) & (end - begin > 1) & (kind[second] != SPACE) & ~odd.any()
            ids, count = self._distinct([text[a:b] for a, b in zip(begin.tolist(), end.tolist(), strict=True)], joinable)
            first = len(self.pool) + np.cumsum(count) - count
            self.pool = np.concatenate([self.pool, ids])
            self.known, self.second = np.insert(self.known, at[new], words[new]), np.insert(self.second, at[new], two[where[new]])
            self.first, self.count = np.insert(self.first, at[new], first), np.insert(self.count, at[new], count)
        at = np.searchsorted(self.known, words)[which]
        clash = self.second[at] != two  # another word of the same hash
        text_of = np.searchsorted(own, starts, side="right") - 1
        odd[text_of[clash]] = True
        first, count = self.first[at], self.count[at]
        total = np.concatenate([[0], np.cumsum(count)])
        ids = self.pool[np.repeat(first - total[:-1], count) + np.arange(total[-1])]
        bounds = total[np.searchsorted(starts, own)]
        if not odd.any():
            return ids, bounds
        parts = [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        for i in np.flatnonzero(odd).tolist():
            parts[i] = np.array(self._library([text[own[i] : own[i + 1]]])[0], np.uint32)
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])

    def texts(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first text, ids, offsets) of slices of a column."""
        data, offsets = text_bytes(column)
        for a, b in slices(offsets, SLICE):
            own = offsets[a : b + 1]
            if own[-1] - own[0] > 2 * SLICE:
                ids = [self.slice(data, np.array(part))[0] for part in _parts(data, int(own[0]), int(own[-1]))]
                ids = np.concatenate(ids)
                yield a, ids, np.array([0, len(ids)])
            else:
                yield a, *self.slice(data, own)


@functools.cache
def encoder(path: str) -> Encoder:
    """The worker's own encoder, which remembers words from task to task."""
    return Encoder(path)


def _parts(data: np.ndarray, at: int, last: int) -> Iterator[tuple[int, int]]:
    """Parts of a long text; each ends after a byte above the controls and before a blank."""
    while at < last:
        cut = at + SLICE
        while cut < last:
            window = data[cut - 1 : min(cut + 65536, last)]
            found = np.flatnonzero((window[1:] == 0x20) & (window[:-1] > 0x20) & (window[:-1] < 0x7F))
            if len(found):
                cut += int(found[0])
                break
            cut += 65536
        yield at, min(cut, last)
        at = min(cut, last)


# ------------------------------------------------------------------- planning


class Plan:
    """Patterns: how many sequences are alike, and how many pieces of each length one holds."""

    def __init__(self, patterns: list[tuple[int, dict[int, int]]]):
        self.patterns = patterns

    @property
    def sequences(self) -> int:
        return sum(n for n, _ in self.patterns)

    def slots(self) -> np.ndarray:
        """Rows (length, first number, pieces a sequence, offset, first sequence), sorted: the pieces of a
        length with numbers from the first on fill the sequences of a pattern one after another."""
        taken: dict[int, int] = {}
        rows, sequence = [], 0
        for n, pattern in self.patterns:
            offset = 0
            for length, k in pattern.items():
                at = taken.get(length, 0)
                rows.append((length, at, k, offset, sequence))
                taken[length] = at + n * k
                offset += k * length
            sequence += n
        return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


class _Sums:
    """Which available lengths add up to a sum: singles by ``left``, pairs by ``pairs``, triples by a length and ``pairs``."""

    def __init__(self, left: np.ndarray):
        self.left, size = left, len(left)
        self.pairs = np.zeros(size, np.int64)  # of two different lengths
        lengths = np.flatnonzero(left)
        for x in lengths:
            self._count(int(x), lengths[lengths > x], 1)

    def _count(self, x: int, others: np.ndarray, by: int) -> None:
        sums = others + x
        np.add.at(self.pairs, sums[sums < len(self.pairs)], by)

    def take(self, pattern: dict[int, int], n: int) -> None:
        for length, k in pattern.items():
            self.left[length] -= n * k
            if not self.left[length]:
                self._count(length, np.flatnonzero(self.left), -1)

    def has(self, pattern: dict[int, int]) -> bool:
        return all(self.left[length] >= k for length, k in pattern.items())

    def pair(self, total: int, held: dict[int, int]) -> dict[int, int] | None:
        """``held`` and two lengths of this sum, the pair that most pieces are left of."""
        low = np.arange(max(1, total - len(self.left) + 1), total // 2 + 1)
        most = np.minimum(self.left[low], self.left[total - low])
        for a in low[np.argsort(-most, kind="stable")[: np.count_nonzero(most)]].tolist():
            if self.has(found := _more(held, total - a, a)):
                return found
        return None

    def exact(self, length: int) -> dict[int, int] | None:
        """A pattern with ``length`` that fills a sequence: one, two or three lengths more."""
        gap = len(self.left) - 1 - length
        if gap <= 0:
            return {length: 1}
        if self.has(found := _more({length: 1}, gap)):
            return found
        if found := self.pair(gap, {length: 1}):
            return found
        third = np.flatnonzero(self.left[:gap])[::-1]
        rest = gap - third
        even = (rest % 2 == 0) & (self.left[rest // 2] > 1)
        for c, r in zip(third[(self.pairs[rest] > 0) | even].tolist(), rest[(self.pairs[rest] > 0) | even].tolist(), strict=True):
            if self.has(held := _more({length: 1}, c)) and (found := self.pair(r, held)):
                return found
        return None


def _more(pattern: dict[int, int], *lengths: int) -> dict[int, int]:
    out = dict(pattern)
    for x in lengths:
        out[x] = out.get(x, 0) + 1
    return out


def _best_fit(left: np.ndarray) -> list[tuple[int, dict[int, int]]]:
    """Best fit, longest first; sequences of the same gap and content are a class and are filled together."""
    cap = len(left) - 1
    open_: dict[int, list[tuple[int, dict[int, int]]]] = {}
    for length in np.flatnonzero(left)[::-1].tolist():
        n = int(left[length])
        while n:
            gap = min((g for g in open_ if g >= length), default=cap)
            k = gap // length
            have, pattern = open_[gap].pop() if gap in open_ else (n, {})
            if gap in open_ and not open_[gap]:
                del open_[gap]
            full = min(have, n // k)
            k, used = (k, full) if full else (n, 1)
            if pattern and have > used:
                open_.setdefault(gap, []).append((have - used, pattern))
            rest = gap - k * length
            open_.setdefault(rest, []).append((used, pattern | {length: k}))
            n -= used * k
    return [x for same in open_.values() for x in same]


def plan(counts: dict[int, int], cap: int = CAP) -> Plan:
    """Sequences for so many pieces of each length."""
    left = np.zeros(cap + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    plain = Plan(_best_fit(left.copy()))
    if plain.sequences <= -(-int((left * np.arange(cap + 1)).sum()) // cap):
        return plain  # no plan has fewer
    sums, patterns = _Sums(left), []
    for length in range(cap, 0, -1):
        while left[length] and (pattern := sums.exact(length)):
            n = min(int(left[x]) // k for x, k in pattern.items())
            patterns.append((n, pattern))
            sums.take(pattern, n)
    exact = Plan(patterns + _best_fit(left))
    return min(exact, plain, key=lambda p: p.sequences)


# ------------------------------------------------------------------- Spark


def pieces(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", cap: int = CAP, end: int = END, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids) of each piece of each row, with part and local: the
    partition that made it, and its number among the pieces of its length there."""
    from pyspark import TaskContext

    def cut(batches):
        coder, part, seen = encoder(path), TaskContext.get().partitionId(), np.zeros(cap + 1, np.int64)
        for batch in batches:
            for a, ids, bounds in coder.texts(batch.column(1)):
                rows, number, start, length, crc, local, own = [], [], [], [], [], [], []
                for i, (x, y) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
                    whole = np.append(ids[x:y], np.uint32(end)).astype("<u4")
                    at, k = 0, 0
                    while at < len(whole):
                        size = (len(whole) - 1) % cap + 1 if at == 0 else cap
                        rows.append(a + i)
                        number.append(k)
                        start.append(at)
                        length.append(size)
                        crc.append(zlib.crc32(whole[at : at + size].tobytes()))
                        local.append(int(seen[size]))
                        seen[size] += 1
                        if with_ids:
                            own.append(whole[at : at + size].astype(np.int32))
                        at, k = at + size, k + 1
                columns = [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(number, pa.int32()), *[pa.array(c, pa.int64()) for c in (start, length, crc)], pa.array([part] * len(rows), pa.int32()), pa.array(local, pa.int64())]
                if with_ids:
                    columns.append(pa.array(own, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "local", *["ids"] * with_ids]
    schema = f"doc_id {docs.schema[doc_id].dataType.simpleString()}, piece int, start bigint, length bigint, ids_crc32 bigint, part int, local bigint" + ", ids array<int>" * with_ids
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(cut, schema)


def placed(cut: DataFrame, cap: int = CAP) -> DataFrame:
    """``cut`` (materialised pieces) with sequence_id and offset instead of part and local."""
    counts = materialize(cut.groupBy("part", "length").agg(F.count("*").alias("n")))
    found = plan({r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}, cap)  # ``cap`` rows at most
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select(F.col("part").alias("of_part"), F.col("length").alias("of_length"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    kept = [c for c in cut.columns if c not in ("part", "local")]
    numbered = cut.join(shifts, (cut["part"] == F.col("of_part")) & (cut["length"] == F.col("of_length"))).select(*kept, (F.col("local") + F.col("before")).alias("number"))
    slots = cut.sparkSession.sparkContext.broadcast(found.slots())
    wide = 1 << 42

    def place(batches):
        table = slots.value
        keys = table[:, 0] * wide + table[:, 1]
        for batch in batches:
            length, number = (batch.column(i).to_numpy() for i in (at_length, len(kept)))
            row = table[np.searchsorted(keys, length * wide + number, side="right") - 1]
            nth = number - row[:, 1]
            own = [pa.array(row[:, 4] + nth // row[:, 2]), pa.array(row[:, 3] + nth % row[:, 2] * length)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *own], names=[*kept, "sequence_id", "offset"])

    at_length = kept.index("length")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in numbered.select(*kept).schema) + ", sequence_id bigint, offset bigint"
    return numbered.mapInArrow(place, schema)


def pack(docs: DataFrame, path: str | None = None, doc_id: str = "doc_id", text: str = "text", cap: int = CAP, end: int = END, with_ids: bool = False) -> DataFrame:
    """The pieces of all rows with their places in sequences."""
    return placed(materialize(pieces(docs, path or vocabulary(), doc_id, text, cap, end, with_ids)), cap)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and input_ids of packed pieces with ids."""
    found = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))  # ``cap`` ids at most
    return found.select("sequence_id", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("input_ids"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op11: the place of every piece of every document."""
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))

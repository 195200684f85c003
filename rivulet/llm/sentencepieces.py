"""SentencePiece encoding and decoding by suffix-array matching (operator 7).

For a BPE model with byte fallback (no normalisation, dummy prefix). Pieces hold the
word mark at their start only (or nothing else), so a text falls into words that are
encoded apart. The words of a batch that the worker doesn't know yet are laid out
in one text, whose suffixes are sorted; each piece is binary-searched for the range
of suffixes that it begins. The occurrences, as edges sorted by where they end, are
relaxed in that order, all words at once: a prefix of a word ends in the piece that
the piece before it lets stand, which is the one that merging would give (two pieces
may be neighbours if merging their joined text leaves exactly the two). Characters
that no piece holds are edges of their own and become byte pieces.

The result is that of the library's encoder, id by id; decoding gives the text back.

Defined results: null and empty texts have no ids and decode to the empty text;
U+2581 is read as a space, as the format has it; words of more than ``LONG`` bytes are relaxed
one by one, in time linear in their length, ``BLOCK`` bytes at a time; repeated rows are each answered; other
columns pass through untouched. A worker remembers ``MOST_WORDS`` words, by two independent
hashes, and starts anew beyond that, and one pair of pieces for each of ``MOST_PAIRS`` hashes.
"""

from __future__ import annotations

import hashlib
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from ._common import mix, powers, slices, text_bytes

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁".encode()
GAP = 0xFF  # divides words; UTF-8 never has it
SLICE = 1 << 18
BLOCK = 1 << 18  # bytes of words that are matched at a time
MOST_WORDS = 400_000  # words that a worker remembers; then it starts anew
MOST_PAIRS = 1 << 19
NEVER = 1 << 30  # rank of what is no piece
LONG = 512
_RAW_HASH = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
_CHECK = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x165667B19E3779F9))


class Vocabulary:
    """Pieces of a model with spaces for marks: bytes, ranks, byte pieces, and which pieces merging can reach."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.pieces = [b"" if model.is_control(i) or model.is_unknown(i) else model.id_to_piece(i).replace("▁", " ").encode() for i in range(n)]
        self.byte_ids = np.zeros(256, dtype=np.int32)
        plain = []
        for i in range(n):
            if model.is_byte(i):
                value = int(model.id_to_piece(i)[3:-1], 16)
                self.byte_ids[value] = i
                self.pieces[i] = bytes([value])
            elif self.pieces[i]:
                plain.append(i)
        score = np.array([model.get_score(i) for i in range(n)])
        self.rank = dict(zip((self.pieces[i] for i in plain), np.argsort(np.argsort(-score[plain], kind="stable")).tolist(), strict=True))
        steps: dict[int, list[tuple[int, bytes, bytes]]] = {i: [] for i in plain}
        self.edges = [i for i in plain if len(self.merge(self.pieces[i], steps[i])) == 1]
        self._trace(steps)
        self.digest = hashlib.sha256(b"\n".join(self.pieces)).hexdigest()

    def merge(self, text: bytes, steps: list[tuple[int, bytes, bytes]] | None = None) -> list[bytes]:
        """Best-first merging of a short text; ``steps`` gets the rank of each merge and the first and last part before it."""
        parts = [c.encode() for c in text.decode()]
        rank = self.rank
        while len(parts) > 1:
            best, at = min((rank.get(parts[i] + parts[i + 1], NEVER), i) for i in range(len(parts) - 1))
            if best == NEVER:
                break
            if steps is not None:
                steps.append((best, parts[0], parts[-1]))
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _trace(self, steps: dict[int, list[tuple[int, bytes, bytes]]]) -> None:
        """Of each edge the states that merging it goes through: number of the first and of the last part, and rank of the next merge."""
        number: dict[bytes, int] = {}
        self.state = np.zeros(len(self.pieces), dtype=np.int64)
        first, last, upcoming = array("i"), array("i"), array("i")
        for i in self.edges:
            self.state[i] = len(first)
            for rank, a, b in [*steps[i], (NEVER, self.pieces[i], self.pieces[i])]:
                first.append(number.setdefault(a, len(number)))
                last.append(number.setdefault(b, len(number)))
                upcoming.append(rank)
        self.first, self.last, self.upcoming = (np.array(x, dtype=np.int32) for x in (first, last, upcoming))
        self.parts = len(number)
        joined = {}
        for piece, rank in self.rank.items():
            for k in range(1, len(piece)):
                a, b = number.get(piece[:k]), number.get(piece[k:])
                if a is not None and b is not None:
                    joined[a * self.parts + b] = rank
        self.joined = np.array(sorted(joined), dtype=np.int64)
        self.joined_rank = np.array([joined[c] for c in self.joined.tolist()], dtype=np.int32)

    def stand(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging the joined text of edges a and b leaves exactly the two.

        Until parts of both are merged, each goes through its own states, and of two merges that of smaller rank comes
        first, else the left one. So all pairs walk through their states together, and a pair falls where the last part of
        a and the first of b merge before anything else does."""
        x, y, ok, live = self.state[a], self.state[b], np.ones(len(a), dtype=bool), np.arange(len(a))
        while len(live):
            i, j = x[live], y[live]
            code = self.last[i].astype(np.int64) * self.parts + self.first[j]
            at = np.searchsorted(self.joined[:-1], code)
            rank = np.where(self.joined[at] == code, self.joined_rank[at], NEVER) if len(self.joined) else np.full(len(code), NEVER)
            left, right = self.upcoming[i], self.upcoming[j]
            across = (rank < left) & (rank <= right)
            ok[live[across]] = False
            going = ~across & (np.minimum(left, right) < NEVER)
            live, on_left = live[going], (left <= right)[going]
            x[live] += on_left
            y[live] += ~on_left
        return ok


class Encoder:
    """Encodes slices of texts; remembers words and pairs of pieces."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.unknown = len(vocabulary.pieces)  # stands for a character without a piece
        ids = np.array(vocabulary.edges, dtype=np.int64)
        pieces = [vocabulary.pieces[i] for i in vocabulary.edges]
        self.sizes = np.array([len(p) for p in pieces])
        self.longest = int(self.sizes.max(initial=4))
        self.ids = ids
        self.heads_low = np.array([p[:16] for p in pieces], dtype="S16")
        self.heads_high = np.array([p[:16] + b"\xff" * (16 - len(p[:16])) for p in pieces], dtype="S16")
        eight = lambda fill: np.frombuffer(b"".join(p[:8] + fill * (8 - len(p[:8])) for p in pieces), ">u8").astype(np.uint64)
        self.eight_low, self.eight_high = eight(b"\0"), eight(b"\xff")
        self.over_eight = np.flatnonzero(self.sizes > 8)
        self.tails = {k: p[16:] for k, p in enumerate(pieces) if len(p) > 16}
        self.singles = np.array([p for p in pieces if len(p.decode()) == 1], dtype="S4")
        self.singles.sort()
        self.lengths = np.array([len(p) for p in vocabulary.pieces] + [0])
        self.salt = 0
        self.forget_pairs()
        self.forget()

    def forget_pairs(self):
        self.pairs = np.full(MOST_PAIRS, -1, np.int64)  # 2 * code + whether they stand, where the code's hash says
        self.long_pairs: dict[int, bool] = {}

    def forget(self):
        self.known_check = np.zeros(0, np.uint64)
        self.known = np.zeros(0, np.uint64)
        self.known_at = np.zeros(1, np.int64)
        self.known_ids = np.zeros(0, np.int32)

    # ------------------------------------------------------------------ pairs

    def compatible(self, before: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """Whether merging leaves each piece behind the one before as it is."""
        code = before * (self.unknown + 1) + piece
        slot = (mix(code.view(np.uint64)) & np.uint64(MOST_PAIRS - 1)).astype(np.int64)
        found = self.pairs[slot]
        new = np.flatnonzero(found >> 1 != code)
        if len(new):
            need, which = np.unique(code[new], return_inverse=True)
            a, b = np.divmod(need, self.unknown + 1)
            ok = np.ones(len(need), dtype=bool)
            both = np.flatnonzero((a != self.unknown) & (b != self.unknown))
            ok[both] = self.v.stand(a[both], b[both])
            found[new] = (2 * need + ok)[which]
            self.pairs[slot[new]] = found[new]
        return found & 1 > 0

    def _stands(self, a: int, b: int) -> bool:
        p = self.v.pieces
        return a == self.unknown or b == self.unknown or self.v.merge(p[a] + p[b]) == [p[a], p[b]]

    # ------------------------------------------------------------------ words

    def long_word(self, text: np.ndarray) -> np.ndarray:
        """Ids of one word, its edges relaxed one after the other, in the order of their first bytes:
        all edges that end where one begins come before it."""
        last, back, known = array("q", [-1]) * (len(text) + 1), array("q", [-1]) * (len(text) + 1), self.long_pairs
        for base in range(0, len(text), BLOCK):
            first, after, piece = self.edges(text[base : base + BLOCK + self.longest])
            own = np.flatnonzero(first < BLOCK)
            order = own[np.lexsort((after[own], first[own]))]
            for f, e, p in zip((first[order] + base).tolist(), (after[order] + base).tolist(), piece[order].tolist(), strict=True):
                if f:
                    if last[f] < 0:
                        continue
                    code = last[f] * (self.unknown + 1) + p
                    stands = known.get(code)
                    if stands is None:
                        if len(known) > MOST_PAIRS:
                            known.clear()
                        stands = known[code] = self._stands(last[f], p)
                    if not stands:
                        continue
                last[e], back[e] = p, f
        out, at = [], len(text)
        while at > 0:
            out += [last[at]] if last[at] != self.unknown else self.v.byte_ids[text[back[at] : at]][::-1].tolist()
            at = back[at]
        return np.array(out[::-1], dtype=np.int32)

    def edges(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first byte, byte after, id) of every piece in a text of words divided by ``GAP``."""
        suffix = np.flatnonzero(((text & 0xC0) != 0x80) & (text != GAP))
        padded = np.concatenate([text, np.full(16, GAP, np.uint8)])
        head = np.lib.stride_tricks.sliding_window_view(padded, 16)[suffix]
        # What follows the end of a word is no part of its suffixes.
        head = np.where(np.logical_and.accumulate(head != GAP, axis=1), head, 0).astype(np.uint8)
        keys = np.ascontiguousarray(head).view(">u8")
        order = np.lexsort((keys[:, 1], keys[:, 0]))
        suffix = suffix[order]
        ordered = np.ascontiguousarray(head[order]).view("S16").ravel()
        # By the first eight bytes, and of the longer pieces those that may occur by sixteen.
        eight = keys[order, 0].astype(np.uint64)
        low = np.searchsorted(eight, self.eight_low, "left")
        high = np.searchsorted(eight, self.eight_high, "right")
        more = self.over_eight[low[self.over_eight] < high[self.over_eight]]
        low[more] = np.searchsorted(ordered, self.heads_low[more], "left")
        high[more] = np.searchsorted(ordered, self.heads_high[more], "right")
        counts = high - low
        which = np.repeat(np.arange(len(counts)), counts)
        first = suffix[np.repeat(low - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())]
        keep = np.ones(len(first), dtype=bool)
        raw = None
        for k, tail in self.tails.items():
            if counts[k]:
                raw = raw if raw is not None else text.tobytes()
                for e in np.flatnonzero(which == k):
                    keep[e] = raw.startswith(tail, first[e] + 16)
        which, first = which[keep], first[keep]
        # Characters that are no piece.
        lead = text[suffix]
        size = np.where(lead < 0x80, 1, np.where(lead < 0xE0, 2, np.where(lead < 0xF0, 3, 4)))
        window = np.lib.stride_tricks.sliding_window_view(padded, 4)[suffix].copy()
        window[np.arange(4)[None, :] >= size[:, None]] = 0
        char = window.view("S4").ravel()
        at = np.searchsorted(self.singles, char)
        lone = self.singles[np.minimum(at, len(self.singles) - 1)] != char
        return (
            np.concatenate([first, suffix[lone]]),
            np.concatenate([first + self.sizes[which], suffix[lone] + size[lone]]),
            np.concatenate([self.ids[which], np.full(lone.sum(), self.unknown)]),
        )

    def words(self, text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of the words [starts, ends) of ``text``."""
        first, after, piece = self.edges(text)
        word = np.searchsorted(starts, first, side="right") - 1
        depth = after - starts[word]
        order = np.argsort(depth.astype(np.uint16), kind="stable")  # words here have ``LONG`` bytes at most
        first, after, piece, depth = first[order], after[order], piece[order], depth[order]
        last = np.full(len(text) + 1, -1, dtype=np.int64)
        back = np.full(len(text) + 1, -1, dtype=np.int64)
        at_start = np.zeros(len(text) + 1, dtype=bool)
        at_start[starts] = True
        cuts = np.flatnonzero(np.concatenate([[True], depth[1:] != depth[:-1]])) if len(depth) else np.zeros(0, np.int64)
        for a, b in zip(cuts, np.append(cuts[1:], len(depth)), strict=True):
            f, e, p = first[a:b], after[a:b], piece[a:b]
            free = at_start[f]
            joined = np.flatnonzero(~free & (last[f] >= 0))
            ok = free.copy()
            if len(joined):
                ok[joined] = self.compatible(last[f[joined]], p[joined])
            last[e[ok]] = p[ok]
            back[e[ok]] = f[ok]
        # Back from the end of each word.
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        owner, at, step = np.arange(len(starts)), ends.copy(), 0
        while len(owner):
            found.append((owner, at, last[at]))
            at = back[at]
            live = at > starts[owner]
            owner, at = owner[live], at[live]
            step += 1
        owner = np.concatenate([f[0] for f in found]) if found else np.zeros(0, np.int64)
        end = np.concatenate([f[1] for f in found]) if found else np.zeros(0, np.int64)
        piece = np.concatenate([f[2] for f in found]) if found else np.zeros(0, np.int64)
        order = np.lexsort((end, owner))
        owner, end, piece = owner[order], end[order], piece[order]
        size = np.where(piece == self.unknown, end - back[end], 1)
        out = np.repeat(piece, size).astype(np.int32)
        if (piece == self.unknown).any():
            place = np.arange(len(out)) - np.repeat(np.cumsum(size) - size, size)
            bytes_at = np.repeat(back[end], size) + place
            odd = out == self.unknown
            out[odd] = self.v.byte_ids[text[bytes_at[odd]]]
        per_word = np.bincount(owner, size, minlength=len(starts)).astype(np.int64)
        return out, np.concatenate([[0], np.cumsum(per_word)])

    # ------------------------------------------------------------------ texts

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, n + 1 offsets) of a slice of texts."""
        n = len(offsets) - 1
        d, own = _marked(data, offsets)
        if not len(d):
            return np.zeros(0, np.int32), np.zeros(n + 1, np.int64)
        space = d == 0x20
        begins = space.copy()
        begins[1:] &= ~space[:-1]
        begins[own[:-1][np.diff(own) > 0]] = True
        starts = np.flatnonzero(begins)
        ends = np.append(starts[1:], len(d))
        lens = ends - starts
        place = np.arange(len(d)) - np.repeat(starts, lens)
        up = powers(int(lens.max()))[place]
        salt = np.uint64(self.salt)
        hashes = mix(np.add.reduceat(_RAW_HASH[d] * up, starts) + lens.astype(np.uint64) + salt * np.uint64(0x9E3779B97F4A7C15))
        check = mix(np.add.reduceat(_CHECK[d] * up, starts) + salt)
        words, where, which = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.known, words)
        new = (at >= len(self.known)) | (self.known[np.minimum(at, len(self.known) - 1)] != words) if len(self.known) else np.ones(len(words), dtype=bool)
        if (check != check[where][which]).any() or (self.known_check[at[~new]] != check[where[~new]]).any():
            self.salt += 1  # two words have one hash: hash otherwise, and start anew
            self.forget()
            return self.encode(data, offsets)
        if new.any():
            if len(self.known) + new.sum() > MOST_WORDS and len(self.known):
                self.forget()
                new = np.ones(len(words), dtype=bool)
            length = ends[where] - starts[where]
            short, long = np.flatnonzero(new & (length <= LONG)), np.flatnonzero(new & (length > LONG))
            parts, counts = [], []
            for a, b in slices(np.concatenate([[0], np.cumsum(length[short] + 1)]), BLOCK):
                s, size = starts[where[short[a:b]]], length[short[a:b]]
                base = np.cumsum(size + 1) - size - 1
                text = np.full(int((size + 1).sum()), GAP, np.uint8)
                inner = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                text[np.repeat(base, size) + inner] = d[np.repeat(s, size) + inner]
                ids, bounds = self.words(text, base, base + size)
                parts.append(ids)
                counts.append(np.diff(bounds))
            for w in where[long]:
                parts.append(self.long_word(d[starts[w] : ends[w]]))
                counts.append(np.array([len(parts[-1])]))
            both = np.concatenate([short, long])
            self._remember(words[both], check[where[both]], np.concatenate(parts), np.concatenate([[0], np.cumsum(np.concatenate(counts))]))
        at = np.searchsorted(self.known, words)
        first, count = self.known_at[at][which], np.diff(self.known_at)[at][which]
        total = np.concatenate([[0], np.cumsum(count)])
        out = self.known_ids[np.repeat(first - total[:-1], count) + np.arange(total[-1])]
        return out, total[np.searchsorted(starts, own)]

    def _remember(self, words: np.ndarray, check: np.ndarray, ids: np.ndarray, bounds: np.ndarray) -> None:
        all_words, all_check = np.concatenate([self.known, words]), np.concatenate([self.known_check, check])
        counts = np.concatenate([np.diff(self.known_at), np.diff(bounds)])
        firsts = np.concatenate([self.known_at[:-1], bounds[:-1] + len(self.known_ids)])
        order = np.argsort(all_words, kind="stable")
        pool = np.concatenate([self.known_ids, ids])
        counts, firsts = counts[order], firsts[order]
        total = np.concatenate([[0], np.cumsum(counts)])
        self.known_ids = pool[np.repeat(firsts - total[:-1], counts) + np.arange(total[-1])]
        self.known, self.known_check, self.known_at = all_words[order], all_check[order], total


def _marked(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts with U+2581 as space and one space before each text that isn't empty."""
    d = data[offsets[0] : offsets[-1]]
    own = offsets - offsets[0]
    mark = np.flatnonzero((d[:-2] == MARK[0]) & (d[1:-1] == MARK[1]) & (d[2:] == MARK[2])) if len(d) > 2 else np.zeros(0, np.int64)
    if len(mark):
        keep = np.ones(len(d), dtype=bool)
        keep[mark + 1] = keep[mark + 2] = False
        d = d.copy()
        d[mark] = 0x20
        own = np.concatenate([[0], np.cumsum(keep)])[own]
        d = d[keep]
    sizes = np.diff(own)
    full = sizes > 0
    new = np.concatenate([[0], np.cumsum(sizes + full)])
    out = np.full(int(new[-1]), 0x20, dtype=np.uint8)
    shift = np.repeat(new[:-1] + full - own[:-1], sizes)
    out[np.arange(len(d)) + shift] = d
    return out, new


def decode_ids(vocabulary: Vocabulary, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, n + 1 offsets) of the texts of id lists: pieces joined, marks as spaces, the dummy prefix off."""
    pool, at, size = _piece_table(vocabulary)
    n = size[ids]
    total = np.concatenate([[0], np.cumsum(n)])
    out = pool[np.repeat(at[ids] - total[:-1], n) + np.arange(total[-1])]
    bounds = total[offsets]
    lead = np.zeros(len(out), dtype=bool)
    firsts = bounds[:-1][np.diff(bounds) > 0]
    lead[firsts] = out[firsts] == 0x20
    kept = np.concatenate([[0], np.cumsum(~lead)])
    return out[~lead], kept[bounds]


@lru_cache(maxsize=4)
def _piece_table(vocabulary: Vocabulary):
    size = np.array([len(p) for p in vocabulary.pieces])
    return np.frombuffer(b"".join(vocabulary.pieces), np.uint8), np.cumsum(size) - size, size


_encoders: dict[str, Encoder] = {}


def _encoder(vocabulary: Vocabulary) -> Encoder:
    if vocabulary.digest not in _encoders:
        _encoders.clear()
        _encoders[vocabulary.digest] = Encoder(vocabulary)
    return _encoders[vocabulary.digest]


def encode(docs: DataFrame, model: str = MODEL, text: str = "text", ids: str = "input_ids") -> DataFrame:
    """``docs`` with the column ``ids``, the pieces' ids of its texts; it takes the place of one that has its name."""
    docs = docs.drop(ids) if ids != text else docs
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(model))  # one vocabulary file, 1 MB
    at = docs.columns.index(text)

    def run(batches):
        encoder = _encoder(shared.value)
        for batch in batches:
            data, offsets = text_bytes(batch.column(at))
            for a, b in slices(offsets, SLICE):
                found, bounds = encoder.encode(data, offsets[a : b + 1])
                yield pa.RecordBatch.from_arrays([*[c.slice(a, b - a) for c in batch.columns], pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(found))], names=[*batch.schema.names, ids])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(ids, ArrayType(IntegerType()))]))


def decode(docs: DataFrame, model: str = MODEL, ids: str = "input_ids", text: str = "decoded") -> DataFrame:
    """``docs`` with the column ``text``, what its id lists decode to (malformed UTF-8 is replaced)."""
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(model))
    at = docs.columns.index(ids)

    def run(batches):
        for batch in batches:
            lists = batch.column(at)
            counts = np.array([0 if x is None else len(x) for x in lists.to_pylist()], dtype=np.int64)
            out, bounds = decode_ids(shared.value, lists.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(counts)]))
            raw = out.tobytes()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([raw[x:y].decode("utf-8", "replace") for x, y in zip(bounds, bounds[1:], strict=False)], pa.string())], names=[*batch.schema.names, text])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(text, StringType())]))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7: how many pieces each document has, a digest of its ids (32-bit little-endian,
    SHA-256), and whether decoding gives its text back (U+2581 as a space)."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    shared = spark.sparkContext.broadcast(Vocabulary(MODEL))

    def run(batches):
        encoder = _encoder(shared.value)
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for a, b in slices(offsets, SLICE):
                found, bounds = encoder.encode(data, offsets[a : b + 1])
                back, own = decode_ids(encoder.v, found, bounds)
                marked, at = _marked(data, offsets[a : b + 1])
                digests, same = [], []
                for i in range(b - a):
                    digests.append(hashlib.sha256(found[bounds[i] : bounds[i + 1]].tobytes()).hexdigest())
                    same.append(bool(np.array_equal(back[own[i] : own[i + 1]], marked[at[i] + 1 : at[i + 1]])))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(np.diff(bounds)), pa.array(digests, pa.string()), pa.array(same)], names=["doc_id", "n_pieces", "ids_sha256", "round_trip"])

    return docs.mapInArrow(run, StructType([docs.schema["doc_id"], StructField("n_pieces", LongType()), StructField("ids_sha256", StringType()), *StructType.fromDDL("round_trip boolean").fields]))

"""Toxicity by noisy-channel deobfuscation (operator 6).

Words that look disguised (signs or digits among letters, letters drawn out,
letters spaced out) become a lattice: a sign may stand for the letters it
resembles, be a separator or be itself; a run of one letter may be one, two or
all of its letters; between letters that are spaced out a word may end. A Viterbi
search over all states of the lattice, the two bytes before, picks the most likely
reading under a character trigram model of exact counts over all documents. Words
that have a single reading are their own. The restored words, beside the others, are
then scored.

The scorer is learned from labelled rows outside the held-out fold, from at most
``most_toxic`` and ``most_clean`` rows of smallest id hash: word features (the
word and its first 4, 5 and 6 bytes) that are far more frequent in toxic
documents, by document counts, and a logistic calibration of their sum, largest
weight and density, fitted on a quarter of the sample that the counts don't see.

Defined results: a null or empty text has the score of a text without any learned
word; with no labelled rows of either class the score is the rate of label 1 (0.5
without labels); rows with a null id teach nothing and aren't held out; repeated
rows are each answered, repeated labels count as often as they occur; words of any
length are read whole; columns beside id and text are ignored, in labels too.
"""

from __future__ import annotations

import uuid
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import FOLD, NONSPACE, Words, hashed_sample, materialize, mix, slices, text_bytes
from .language import fold

FOLDS, HELD_OUT = 5, 0
MOST_TOXIC, MOST_CLEAN = 4_000, 8_000
LEAST_DOCS = 4
LEAST_LOG_ODDS = 1.5

#: The letters that a sign or digit resembles.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "*": "aeiou",
}
#: Signs that can separate the letters of one word, or hide one.
SEPARATORS = set(".-_*'~^:/\\,;")
COST_LOOKALIKE, COST_SEPARATOR, COST_SIGN, COST_RUN, COST_BOUNDARY = 0.8, 0.7, 6.0, 0.5, 1.0
#: Stands between letters that are spaced out, where a word may end.
BETWEEN = "\x1f"
MOST_REMEMBERED = 64  # longest word that a worker remembers the reading of

_LETTERS = np.zeros(256, dtype=bool)
_LETTERS[0x41:0x5B] = _LETTERS[0x61:0x7B] = _LETTERS[0x80:] = True
_LOOKS = np.zeros(256, dtype=bool)
_LOOKS[[ord(c) for c in LOOKALIKES if ord(c) < 128]] = True
_SEPARATES = np.zeros(256, dtype=bool)
_SEPARATES[[ord(c) for c in SEPARATORS]] = True
#: Look-alikes that are no punctuation, and so count at the ends of words too.
_FIRM = np.zeros(256, dtype=bool)
_FIRM[[ord(c) for c in "0123456789@$"]] = True
#: Symbols of the character model: letters, bytes of other characters, and 0 for all else.
_SYMBOL = np.zeros(256, dtype=np.int64)
_SYMBOL[0x61:0x7B] = _SYMBOL[0x41:0x5B] = np.arange(1, 27)
_SYMBOL[0x80:] = np.arange(27, 155)
SYMBOLS = 155


# ------------------------------------------------------------ character model


def _trigrams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Codes of the symbol trigrams that lie in one text."""
    d = _SYMBOL[data[offsets[0] : offsets[-1]]]
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    if len(d) < 3:
        return np.zeros(0, np.int64)
    code = (d[:-2] * SYMBOLS + d[1:-1]) * SYMBOLS + d[2:]
    return code[text[:-2] == text[2:]]


def character_counts(docs: DataFrame, text: str):
    """Broadcast of (name, codes, counts) of the symbol trigrams of all texts, exact; ``SYMBOLS`` ** 3 = 3.7 million codes at most."""

    def count(batches):
        total = np.zeros(SYMBOLS**3, dtype=np.int64)
        for batch in batches:
            data, offsets = text_bytes(batch.column(0))
            for a, b in slices(offsets):
                codes, n = np.unique(_trigrams(data, offsets[a : b + 1]), return_counts=True)
                total[codes] += n
        code = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(total[code])], names=["code", "n"])

    rows = docs.where(F.col(text).isNotNull()).select(F.col(text).cast("string").alias("text"))
    found = rows.mapInArrow(count, "code bigint, n bigint").groupBy("code").agg(F.sum("n").alias("n")).toArrow()
    return docs.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, found.column("code").to_numpy().astype(np.int32), found.column("n").to_numpy()))


class Decoder:
    """Viterbi readings under -log P(symbol | two symbols before), with memory for repeated words."""

    def __init__(self, counts: tuple[np.ndarray, np.ndarray]):
        codes, n = counts[0].astype(np.int64), counts[1]
        pairs = np.bincount(codes // SYMBOLS, n, minlength=SYMBOLS**2)
        cost = np.log(pairs + 2.56).astype(np.float32).repeat(SYMBOLS) - np.float32(np.log(0.01))
        cost[codes] += np.float32(np.log(0.01)) - np.log(n + 0.01).astype(np.float32)
        self.cost = cost
        self._remember = lru_cache(maxsize=200_000)(self._read)

    def read(self, token: str) -> str:
        return self._remember(token) if len(token) <= MOST_REMEMBERED else self._read(token)

    def step(self, before: int, letters: str) -> tuple[float, int]:
        """Cost of ``letters`` after the two symbols ``before``, and the two symbols then."""
        total, raw = 0.0, letters.encode("utf-8", "replace")
        for byte in raw:
            code = before * SYMBOLS + int(_SYMBOL[byte])
            total += min(max(float(self.cost[code]), 0.0), 12.0)
            before = code % SYMBOLS**2
        return total, before

    @staticmethod
    def arcs(token: str, i: int, j: int):
        """(next position, letters, cost) of the readings of the sign at i, which repeats up to j."""
        c = token[i]
        if c == BETWEEN:
            yield i + 1, "", 0.0
            yield i + 1, " ", COST_BOUNDARY
            return
        if c.isalpha():
            yield i + 1, c, 0.0
            if j - i >= 2:
                yield j, c, COST_RUN
            if j - i >= 3:
                yield j, c + c, COST_RUN
        for letter in LOOKALIKES.get(c, ""):
            yield i + 1, letter, COST_LOOKALIKE
            if j - i >= 2:
                yield j, letter, COST_LOOKALIKE + COST_RUN
        if c in SEPARATORS:
            yield j, "", COST_SEPARATOR
        if not c.isalpha():
            yield j, " ", COST_SIGN

    def _read(self, token: str) -> str:
        """The likeliest reading of a lower-cased token; white space where a sign stays one."""
        n = len(token)
        ends = [n] * (n + 1)
        for i in range(n - 2, -1, -1):
            ends[i] = ends[i + 1] if token[i] == token[i + 1] else i + 1
        # Of each position the states that reach it: cost, and where from by which letters.
        at: list[dict[int, tuple[float, int, int, str]]] = [{} for _ in range(n + 1)]
        at[0][0] = (0.0, -1, 0, "")
        for i in range(n):
            if not at[i]:
                continue
            arcs = list(self.arcs(token, i, ends[i]))
            for before, (cost, *_) in at[i].items():
                for j, letters, extra in arcs:
                    step, after = self.step(before, letters) if letters else (0.0, before)
                    total = cost + extra + step
                    old = at[j].get(after)
                    if old is None or total < old[0]:
                        at[j][after] = (total, i, before, letters)
        state = min(at[n], key=lambda x: at[n][x][0] + self.step(x, " ")[0])
        out, i = [], n
        while i > 0:
            _, i, state, letters = at[i][state]
            out.append(letters)
        return "".join(reversed(out))


_decoders: dict[str, Decoder] = {}


def _decoder(shared) -> Decoder:
    """The worker's decoder of broadcast counts, made once."""
    name, codes, n = shared.value
    if name not in _decoders:
        _decoders.clear()
        _decoders[name] = Decoder((codes, n))
    return _decoders[name]


def disguised(words: Words) -> np.ndarray:
    """Which words have more than one reading: three readable signs (letters and look-alikes, a letter among
    them) with a look-alike or separator between them, or at an end if it is a digit or the like; or a letter
    three times in a row."""
    if not len(words.starts):
        return np.zeros(0, dtype=bool)
    d = words.bytes
    before = lambda marks: np.concatenate([[0], np.cumsum(marks[d], dtype=np.int64)])
    letters, readable = before(_LETTERS), before(_LETTERS | _LOOKS)
    # A sign counts between readable ones, or beside two letters at an end; a row of one punctuation sign there does not.
    place = np.flatnonzero(NONSPACE[d])
    owner = np.repeat(np.arange(len(words.starts)), words.ends - words.starts)
    signs = place[(_LOOKS | _SEPARATES)[d[place]]]
    of = owner[np.searchsorted(place, signs)]
    start, end = words.starts[of], words.ends[of]
    left, right = readable[signs] - readable[start], readable[end] - readable[signs + 1]
    edge_run = (signs + 1 < len(d)) & (d[np.minimum(signs + 1, len(d) - 1)] == d[signs]) | (signs > 0) & (d[np.maximum(signs - 1, 0)] == d[signs])
    beside = np.maximum(letters[signs] - letters[start], letters[end] - letters[signs + 1]) > 1
    counts_ = ((left > 0) & (right > 0)) | _FIRM[d[signs]] | (_LOOKS[d[signs]] & (d[signs] != 0x21) & beside & ~edge_run)
    out = np.zeros(len(words.starts), dtype=bool)
    out[of[counts_]] = True
    out &= (letters[words.ends] > letters[words.starts]) & (readable[words.ends] - readable[words.starts] >= 3)
    low = FOLD[d]
    triple = np.flatnonzero((low[2:] == low[1:-1]) & (low[1:-1] == low[:-2]) & _LETTERS[d[2:]] & (d[2:] < 0x80)) if len(d) > 2 else np.zeros(0, np.int64)
    word = np.searchsorted(words.starts, triple, side="right") - 1
    ok = (word >= 0) & (triple + 3 <= words.ends[word])
    out[word[ok]] = True
    return out


def spaced(words: Words) -> list[tuple[int, int]]:
    """[first, after) of runs of three or more words of one letter or look-alike each (with a sign behind
    it at most) of which two are letters."""
    lens = words.ends - words.starts
    head = words.bytes[words.starts] if len(words.starts) else np.zeros(0, np.uint8)
    letter = _LETTERS[head] & (head < 0x80)
    one = (lens <= 2) & (letter | _FIRM[head] | (head == 0x21) & (lens == 1))
    if len(words.starts):
        second = words.bytes[np.minimum(words.starts + 1, len(words.bytes) - 1)]
        one &= (lens == 1) | ~(_LETTERS | _FIRM)[second]
    if not one.any():
        return []
    edge = np.diff(np.concatenate([[0], one.astype(np.int8), [0]]))
    runs = []
    for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True):
        cuts = [a, *(a + 1 + np.flatnonzero(np.diff(words.text_of[a:b]))), b]
        runs += [(x, y) for x, y in zip(cuts, cuts[1:], strict=False) if y - x >= 3 and letter[x:y].sum() >= 2]
    return runs


def restored(words: Words, decoder: Decoder) -> tuple[list[tuple[int, int, str]], None]:
    """(first word, after, reading) of the disguised words of a slice."""
    found = []
    runs = spaced(words)
    taken = np.zeros(len(words.starts), dtype=bool)
    text = words.bytes.tobytes()
    for a, b in runs:
        taken[a:b] = True
        letters = BETWEEN.join(chr(words.bytes[s]) for s in words.starts[a:b]).lower()
        found.append((a, b, decoder.read(letters)))
    for i in np.flatnonzero(disguised(words) & ~taken) if len(words.starts) else ():
        token = text[words.starts[i] : words.ends[i]].decode("utf-8", "replace").lower()
        found.append((int(i), int(i) + 1, decoder.read(token)))
    return found


def restore(docs: DataFrame, counts, text: str = "text") -> DataFrame:
    """``docs`` with the column restored: the text with every disguised word in its likeliest reading."""
    at = docs.columns.index(text)

    def mend(batches):
        decoder = _decoder(counts)
        for batch in batches:
            data, offsets = text_bytes(batch.column(at))
            out: list[str] = []
            for a, b in slices(offsets):
                words = Words(data, offsets[a : b + 1], NONSPACE, hashes=False)
                raw, own = words.bytes.tobytes(), offsets[a : b + 1] - offsets[a]
                pieces: list[list[bytes]] = [[] for _ in range(b - a)]
                cursor = own[:-1].copy()
                for first, after, reading in sorted(restored(words, decoder)):
                    t = words.text_of[first]
                    pieces[t] += [raw[cursor[t] : words.starts[first]], reading.encode()]
                    cursor[t] = words.ends[after - 1]
                out += [b"".join([*pieces[t], raw[cursor[t] : own[t + 1]]]).decode("utf-8", "replace") for t in range(b - a)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], names=[*batch.schema.names, "restored"])

    from pyspark.sql.types import StringType, StructField, StructType

    return docs.mapInArrow(mend, StructType([*docs.schema.fields, StructField("restored", StringType())]))


# ------------------------------------------------------------------- features


def _of_words(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Features of each word (4 columns; repeated where a word is short) and the word's text."""
    lens = words.ends - words.starts
    out = np.empty((len(lens), 4), dtype=np.uint64)
    out[:, 0] = words.hashes
    padded = np.concatenate([FOLD[words.bytes], np.zeros(8, np.uint8)])
    code = np.zeros(len(lens), dtype=np.uint64)
    for j in range(6):
        code = (code << np.uint64(8)) | padded[words.starts + j].astype(np.uint64)
        if j >= 3:
            out[:, j - 2] = np.where(lens > j, mix(code + np.uint64(j + 1)), words.hashes)
    return out, words.text_of


def slice_features(data: np.ndarray, offsets: np.ndarray, decoder: Decoder) -> tuple[np.ndarray, np.ndarray]:
    """Features of the words of a slice of texts and of the restored readings of its disguised words."""
    plain, of_plain = _of_words(Words(data, offsets, _LETTERS))
    whole = Words(data, offsets, NONSPACE, hashes=False)
    readings = restored(whole, decoder)
    if not readings:
        return plain, of_plain
    texts = [r.encode() for _, _, r in readings]
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    more, of_more = _of_words(Words(np.frombuffer(b"".join(texts), np.uint8), bounds, _LETTERS))
    owners = whole.text_of[[first for first, _, _ in readings]]
    return np.concatenate([plain, more]), np.concatenate([of_plain, owners[of_more]])


class Lexicon:
    """Learned features by hash with weights, behind a small table of cells for a quick look."""

    def __init__(self, hashes: np.ndarray, weights: np.ndarray):
        order = np.argsort(hashes)
        self.hashes, self.weights = hashes[order], weights[order].astype(np.float64)
        self.cells = np.zeros(1 << 18, dtype=bool)
        self.cells[(hashes & np.uint64((1 << 18) - 1)).astype(np.int64)] = True

    def look_up(self, features: np.ndarray, text_of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, index in the lexicon, word) of the features that are in it."""
        flat = features.ravel()
        maybe = np.flatnonzero(self.cells[(flat & np.uint64((1 << 18) - 1)).astype(np.int64)])
        at = np.searchsorted(self.hashes, flat[maybe])
        ok = (at < len(self.hashes)) & (self.hashes[np.minimum(at, len(self.hashes) - 1)] == flat[maybe]) if len(self.hashes) else np.zeros(len(maybe), bool)
        word = maybe[ok] // features.shape[1]
        return text_of[word], at[ok], word

    def stats(self, features: np.ndarray, text_of: np.ndarray, n: int) -> np.ndarray:
        """log sum, largest weight and density of each text."""
        text, at, word = self.look_up(features, text_of)
        best = np.zeros(len(features))
        np.maximum.at(best, word, self.weights[at])
        total = np.bincount(text_of, best, minlength=n)
        largest = np.zeros(n)
        np.maximum.at(largest, text_of, best)
        size = np.maximum(np.bincount(text_of, minlength=n), 1)
        return np.stack([np.log1p(total), largest, np.log1p(100 * total / size)], axis=1)


class Model:
    def __init__(self, lexicon: Lexicon, weights: np.ndarray, rate: float):
        self.lexicon, self.weights, self.rate = lexicon, weights, rate

    def score(self, stats: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(stats), self.rate)
        z = stats @ self.weights[:-1] + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _map_stats(rows: DataFrame, lexicon: Lexicon, counts, keep: list[tuple[str, str]]) -> DataFrame:
    """The columns ``keep`` (name, type) and s0, s1, s2 of rows whose last column is the text."""

    def measure(batches):
        decoder = _decoder(counts)
        for batch in batches:
            data, offsets = text_bytes(batch.column(len(keep)))
            parts = [lexicon.stats(*slice_features(data, offsets[a : b + 1], decoder), b - a) for a, b in slices(offsets)]
            x = np.concatenate(parts) if parts else np.zeros((0, 3))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *[pa.array(np.ascontiguousarray(c)) for c in x.T]], names=[*[n for n, _ in keep], "s0", "s1", "s2"])

    return rows.mapInArrow(measure, ", ".join(f"`{n}` {t}" for n, t in keep) + ", s0 double, s1 double, s2 double")


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-2) -> np.ndarray:
    """Weights and intercept by Newton's method, for the few columns of the calibration."""
    x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    w = np.zeros(x.shape[1])
    ridge = penalty * np.eye(x.shape[1])
    ridge[-1, -1] = 1e-6
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge + 1e-9 * np.eye(len(w)), x.T @ (y - p) - ridge @ w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return w


def train(docs: DataFrame, labels: DataFrame, counts, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", most_toxic: int = MOST_TOXIC, most_clean: int = MOST_CLEAN) -> Model:
    """The model of a bounded sample of labelled rows (of ``labels``: those to learn from only)."""
    known = labels.where(F.col(doc_id).isNotNull() & F.col(label).isin(0, 1)).select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("y"))
    totals = {r.y: r["count"] for r in known.groupBy("y").count().collect()}
    rate = totals.get(1, 0) / sum(totals.values()) if totals else 0.5
    take = lambda y, n: hashed_sample(known.where(F.col("y") == y), "id", n, totals.get(y, 0))
    sample = materialize(take(1, most_toxic).union(take(0, most_clean)))
    chosen = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text")).join(F.broadcast(sample), "id")  # the sample's size is bounded
    part = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(4)) == 0
    rows = materialize(chosen.select(part.alias("held"), "y", "text").repartition(16))
    learn = rows.where("not held")
    sizes = {r.y: r["count"] for r in learn.groupBy("y").count().collect()}
    if len(sizes) < 2:
        return Model(Lexicon(np.zeros(0, np.uint64), np.zeros(0)), None, rate)

    def document_counts(only: Lexicon | None):
        def count(batches):
            decoder = _decoder(counts)
            total: list[np.ndarray] = []
            for batch in batches:
                data, offsets = text_bytes(batch.column(0))
                for a, b in slices(offsets):
                    f, of = slice_features(data, offsets[a : b + 1], decoder)
                    if only is None:
                        values = f.ravel()
                        owner = np.repeat(of, f.shape[1])
                    else:
                        owner, at, _ = only.look_up(f, of)
                        values = only.hashes[at]
                    order = np.lexsort((values, owner))
                    v, o = values[order], owner[order]
                    new = np.ones(len(v), dtype=bool)
                    new[1:] = (v[1:] != v[:-1]) | (o[1:] != o[:-1])
                    total.append(v[new])
            h, n = np.unique(np.concatenate(total) if total else np.zeros(0, np.uint64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n.astype(np.int64))], names=["h", "n"])

        return count

    toxic = learn.where("y = 1").select("text").mapInArrow(document_counts(None), "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_DOCS).toArrow()  # bounded by the sample
    hashes = toxic.column("h").to_numpy().view(np.uint64)
    hits = toxic.column("n").to_numpy()
    first = Lexicon(hashes, hits)
    clean = learn.where("y = 0").select("text").mapInArrow(document_counts(first), "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n")).toArrow()
    misses = np.zeros(len(first.hashes))
    if clean.num_rows:
        misses[np.searchsorted(first.hashes, clean.column("h").to_numpy().view(np.uint64))] = clean.column("n").to_numpy()
    odds = np.log((first.weights + 0.5) / (sizes[1] + 1)) - np.log((misses + 0.5) / (sizes[0] + 1))
    good = odds >= LEAST_LOG_ODDS
    lexicon = Lexicon(first.hashes[good], odds[good])
    held = _map_stats(rows.where("held").select("y", "text"), lexicon, counts, [("y", "int")]).toArrow()  # at most a quarter of the sample
    y = held.column("y").to_numpy().astype(np.float64)
    if len(set(y.tolist())) < 2:
        return Model(lexicon, None, rate)
    x = np.stack([held.column(f"s{j}").to_numpy() for j in range(3)], axis=1)
    w = logistic(x, y)
    share = min(max(y.mean(), 1e-6), 1 - 1e-6)
    w[-1] += np.log(rate / (1 - rate)) - np.log(share / (1 - share))  # the sample has more toxic rows than the labels
    return Model(lexicon, w, rate)


def score(docs: DataFrame, model: Model, counts, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """id, score and predicted of each row of ``docs``."""
    rows = docs.select(F.col(doc_id).alias("__id"), F.col(text).cast("string").alias("__text"))
    found = _map_stats(rows, model.lexicon, counts, [("__id", docs.schema[doc_id].dataType.simpleString())])
    if model.weights is None:
        p = F.lit(float(model.rate))
    else:
        z = sum((float(w) * F.col(f"s{j}") for j, w in enumerate(model.weights[:-1])), F.lit(float(model.weights[-1])))
        p = 1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(30.0)), F.lit(-30.0))))
    return found.select(F.col("__id").alias(doc_id), p.alias("score"), (p >= 0.5).cast("int").alias("predicted"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6: the toxicity of every document, learned from labels of four folds of five."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic").where(fold("doc_id", FOLDS) != HELD_OUT)
    counts = character_counts(docs, "text")
    found = score(docs, train(docs, labels, counts), counts)
    return found.select("doc_id", F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"), "score", "predicted")

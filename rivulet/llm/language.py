"""Language ID with error-correcting output codes (operator 9).

Each language has a codeword of bits. For each bit a binary classifier tells the
languages with a 1 from those with a 0: a naive Bayes over hashed n-grams of one
to three bytes of the lower-cased letters, learned from counts over all labelled
documents (one grouped sum, which the driver reads ``TOGETHER`` languages at a time and folds into two vectors a bit). A text
is decoded by loss: each bit's margin, in units of the margin that its own classes
show, costs exp(-margin) under a codeword's bit, weighted by how well the bit
separates its classes; the codeword of least cost wins. Texts whose runner-up
costs nearly as little are flagged ambiguous.

All languages are learned, however many there are. Few languages have the exhaustive code, all 2^(L-1) - 1 two-way splits, more than
six a dense random one of the most distant columns among a fixed number of draws.

Defined results: null and letterless texts are ``und`` with score 0, as is every
text if nothing is labelled; rows with a null id, text or language teach nothing
and are not held out if the id is null; repeated rows each count and are each
answered; columns beside id, text and language are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import materialize, slices, text_bytes

BUCKETS = 1 << 13
#: Languages whose counts the driver holds at once.
TOGETHER = 200
FOLDS, HELD_OUT = 4, 2
AMBIGUOUS = 0.25
SHARPNESS = 4.0

_LETTER = np.full(256, 0x20, dtype=np.uint8)
_LETTER[0x61:0x7B] = np.arange(0x61, 0x7B)
_LETTER[0x41:0x5B] = np.arange(0x61, 0x7B)
_LETTER[0x80:] = np.arange(0x80, 0x100)
_NONE = np.uint32(0xFFFFFFFF)


def histograms(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Counts of hashed one- to three-byte grams, one row a text."""
    n = len(offsets) - 1
    d = _LETTER[data[offsets[0] : offsets[-1]]].astype(np.uint32)
    text = np.repeat(np.arange(n), np.diff(offsets))
    out = np.zeros((n, BUCKETS), dtype=np.float32)
    code = d.copy()
    for size in (1, 2, 3):
        if size > 1:
            if len(d) < size:
                break
            code = (code[:-1] << np.uint32(8)) | d[size - 1 :]
        spaces = int.from_bytes(b" " * size, "big")
        ok = (text[: len(code)] == text[size - 1 :]) & (code != spaces)
        bucket = ((code + np.uint32(size)) * np.uint32(2654435761)) >> np.uint32(19)
        cell = text[: len(code)][ok] * BUCKETS + bucket[ok]
        out += np.bincount(cell, minlength=n * BUCKETS).reshape(n, BUCKETS)
    return out


def _pieces(data: np.ndarray, offsets: np.ndarray):
    for a, b in slices(offsets, 1 << 19):
        for c in range(a, b, 128):
            yield c, min(c + 128, b)


def fold(doc_id: str, folds: int):
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(folds))


def counts(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """lang, bucket and n, the n-gram counts of all rows with a language."""

    def count(batches):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column(1).to_pylist(), dtype=object)
            data, offsets = text_bytes(batch.column(0))
            for a, b in _pieces(data, offsets):
                h = histograms(data, offsets[a : b + 1])
                for name in set(langs[a:b]):
                    part = h[langs[a:b] == name].sum(axis=0, dtype=np.float64)
                    total[name] = total.get(name, 0) + part
        for name, sums in total.items():
            full = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(full), pa.string()), pa.array(full.astype(np.int32)), pa.array(sums[full].astype(np.int64))], names=["lang", "bucket", "n"])

    rows = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))
    return rows.mapInArrow(count, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def codewords(n: int) -> np.ndarray:
    """Bits (+1, -1) of n languages: every split of few, distant random ones of many."""
    if n <= 6:
        return np.array([[1 if (split >> i) & 1 else -1 for split in range(1, 2 ** (n - 1))] for i in range(n)]).reshape(n, -1)
    bits, rng, best = int(np.ceil(10 * np.log2(n))), np.random.default_rng(7), None
    for _ in range(200 if n <= 1000 else 5):
        code = rng.choice([-1, 1], size=(n, bits))
        # the nearest pair, some rows at a time
        near = bits
        for at in range(0, n, 1000):
            alike = (code[at : at + 1000] @ code.T).astype(np.int64)
            alike[np.arange(len(alike)), np.arange(at, at + len(alike))] = -bits
            near = min(near, (bits - int(alike.max())) // 2)
        if best is None or near > best[0]:
            best = (near, code)
    return best[1]


class Model:
    """languages, codewords, and the weights, offsets, scales and trust of each bit."""

    def __init__(self, languages: list[str], tables: np.ndarray | Iterable[np.ndarray]):
        """``tables``: the counts of the languages, a row each, in one or several parts in their order."""
        self.languages = languages
        self.code = codewords(len(languages))
        sums = {side: np.zeros((self.code.shape[1], BUCKETS)) for side in (1, -1)}
        at = 0
        for table in [tables] if isinstance(tables, np.ndarray) else tables:
            p = (table + 0.5) / (table + 0.5).sum(axis=1, keepdims=True)  # each language weighs the same
            for side, total in sums.items():
                total += (self.code[at : at + len(p)] == side).T.astype(np.float64) @ p
            at += len(p)
        log_odds, scale = [], []
        for bit, one, zero in zip(self.code.T, sums[1], sums[-1], strict=True):
            one, zero = one / (bit > 0).sum(), zero / (bit < 0).sum()
            w = np.log(one) - np.log(zero)
            middle = ((one + zero) / 2 * w).sum()
            log_odds.append(w - middle)
            scale.append(((one - zero) * w).sum() / 2)
        self.weights = np.array(log_odds, dtype=np.float32).T.reshape(BUCKETS, -1)
        self.scale = np.maximum(np.array(scale), 1e-9)
        self.trust = self.scale / self.scale.sum() if len(scale) else self.scale

    def decode(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(index of the language, score, ambiguous) of each histogram."""
        if len(self.languages) == 1:
            return np.zeros(len(h), np.int64), np.ones(len(h)), np.zeros(len(h), bool)
        total = np.maximum(h.sum(axis=1, dtype=np.float64), 1)
        margin = np.clip((h @ self.weights) / total[:, None] / self.scale, -3, 3)
        cost = np.stack([(np.exp(-margin * word) * self.trust).sum(axis=1) for word in self.code], axis=1)
        likely = np.exp(-SHARPNESS * (cost - cost.min(axis=1, keepdims=True)))
        likely /= likely.sum(axis=1, keepdims=True)
        order = np.sort(likely, axis=1)
        return cost.argmin(axis=1), likely.max(axis=1), order[:, -1] - order[:, -2] < AMBIGUOUS


def train(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model | None:
    """The model of all languages of ``docs``; None if no row has one."""
    found = materialize(counts(docs, text, lang))
    names = sorted(r.lang for r in found.select("lang").distinct().collect())  # a row a language
    if not names:
        return None

    def tables():
        for a in range(0, len(names), TOGETHER):
            part = names[a : a + TOGETHER]
            at = {name: i for i, name in enumerate(part)}
            own = found.where(F.col("lang").isin(part)).toArrow()
            sums = np.zeros((len(part), BUCKETS))
            sums[[at[x] for x in own.column("lang").to_pylist()], own.column("bucket").to_numpy()] = own.column("n").to_numpy()
            yield sums

    return Model(names, tables())


def identify(docs: DataFrame, model: Model | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """id, lang_pred, score and ambiguous of each row of ``docs``."""
    key_type = docs.schema[doc_id].dataType.simpleString()

    def predict(batches):
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            letters = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            for a, b in _pieces(data, offsets):
                best, score, unsure = model.decode(histograms(data, offsets[a : b + 1]))
                ok = letters[a:b]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        pa.array([model.languages[i] if k else "und" for i, k in zip(best, ok, strict=True)], pa.string()),
                        pa.array(np.where(ok, score, 0.0).astype(np.float64)),
                        pa.array(ok & unsure),
                    ],
                    names=[doc_id, "lang_pred", "score", "ambiguous"],
                )

    if model is None:
        return docs.select(doc_id, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(False).alias("ambiguous"))
    letter = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(F.col(doc_id), F.col(text).cast("string").alias("__text"), letter.alias("__letter"))
    return rows.mapInArrow(predict, f"`{doc_id}` {key_type}, lang_pred string, score double, ambiguous boolean")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9: the language of every document, learned from three folds of four."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    model = train(docs.where(F.col("doc_id").isNotNull() & (fold("doc_id", FOLDS) != HELD_OUT)))
    found = identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"), "lang_pred", "score", "ambiguous")

"""Quality classifier with hierarchical empirical Bayes (operator 10).

A logistic model on features of the text gives each document's evidence. Hosts,
and paths within hosts, have a rate of good documents of their own; the mean
evidence of a site estimates it and is shrunk towards the host's rate, and that
towards the global one, by as much as the spread between sites does not exceed
what chance alone gives (method of moments). A document's posterior is its own
evidence with the prior of its site, from which its own share has been taken out.
Site sums are two grouped aggregates; a handful of moments reaches the driver.

The model is fitted on at most ``MOST_LABELS`` labelled rows of each class, those
of smallest id hash.

Defined results: a null or empty text has no evidence and the prior of its site;
a null host or path is a site of its own; without labels, or with labels of one
class only, evidence is neutral and all documents are accepted (or, if all labels
say 0, still judged by nothing else than that rate); repeated rows count as often
as they occur; repeated or null labels count as often as they occur or not at all;
other columns pass through ``accepted`` untouched.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ._common import NONSPACE, Words, hashed_sample, materialize, numbered_columns, slices, text_bytes

MOST_LABELS = 20_000
#: A table of sites of at most so many rows is broadcast (below 10 MB); a larger one is joined by shuffle.
MOST_BROADCAST = 50_000
FEATURES = ["symbols", "bangs", "capitals", "digits", "repeats", "again", "length", "spread", "size"]

_kind = np.zeros(256, dtype=np.uint8)
_kind[0x30:0x3A] = 1  # digit
_kind[0x41:0x5B] = 2  # capital
_kind[0x61:0x7B] = 3
_kind[0x80:] = 3
for _c in b"#$%&*+/<=>@\\^_`{|}~[]":
    _kind[_c] = 4  # symbol
_kind[0x21] = 5


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of ``FEATURES`` a text, each about between 0 and 1."""
    w = Words(data, offsets, NONSPACE)
    n = len(w.counts)
    kinds = _kind[w.bytes]
    text = np.repeat(np.arange(n), np.diff(offsets))
    per = np.bincount(text * 6 + kinds, minlength=6 * n).reshape(n, 6).astype(np.float64)
    visible = np.maximum(np.add.reduce(per, axis=1), 1)
    words = np.maximum(w.counts, 1)
    same = (w.hashes[1:] == w.hashes[:-1]) & (w.text_of[1:] == w.text_of[:-1])
    repeats = np.bincount(w.text_of[1:][same], minlength=n) / words
    grams, at = w.grams(3)
    key = (w.text_of[at].astype(np.uint64) << np.uint64(44)) | (grams >> np.uint64(20))
    key.sort()
    old = key[1:] == key[:-1]
    again = np.bincount((key[1:][old] >> np.uint64(44)).astype(np.int64), minlength=n) / words
    lens = (w.ends - w.starts).astype(np.float64)
    mean = np.bincount(w.text_of, lens, minlength=n) / words
    spread = np.sqrt(np.maximum(np.bincount(w.text_of, lens * lens, minlength=n) / words - mean * mean, 0))
    return np.stack(
        [per[:, 4] / words, per[:, 5] / words, per[:, 2] / visible, per[:, 1] / visible, repeats, again, np.minimum(mean, 40) / 10, np.minimum(spread, 40) / 10, np.log1p(w.counts) / 10], axis=1
    ).clip(0, 5)


def with_features(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` and the columns __symbols, ... of its texts, appended in place (no shuffle)."""
    names = [f"__{f}" for f in FEATURES]
    at = docs.columns.index(text)

    def add(batches):
        for batch in batches:
            data, offsets = text_bytes(batch.column(at))
            parts = [features(data, offsets[a : b + 1]) for c, d in slices(offsets) for a, b in _few(c, d)]
            x = np.concatenate(parts) if parts else np.zeros((0, len(names)))
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(np.ascontiguousarray(c)) for c in x.T]], names=[*batch.schema.names, *names])

    schema = StructType([*docs.schema.fields, *[StructField(name, DoubleType()) for name in names]])
    return docs.mapInArrow(add, schema)


def _few(a: int, b: int, most: int = 4000):
    return [(c, min(c + most, b)) for c in range(a, b, most)]


class Evidence:
    """A fitted logistic model; ``logit`` is its expression over the feature columns."""

    def __init__(self, weights: np.ndarray, intercept: float, rate: float):
        self.weights, self.intercept, self.rate = weights, intercept, rate

    def logit(self):
        out = F.lit(float(self.intercept))
        for name, w in zip(FEATURES, self.weights, strict=True):
            out = out + float(w) * F.col(f"__{name}")
        blank = F.col("__size") == 0
        return F.when(blank, _logit(F.lit(self.rate))).otherwise(F.greatest(F.least(out, F.lit(12.0)), F.lit(-12.0)))


def _logit(p):
    p = F.greatest(F.least(p, F.lit(1 - 1e-6)), F.lit(1e-6))
    return F.log(p / (1 - p))


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", most: int = MOST_LABELS) -> Evidence:
    """The evidence model of at most ``most`` labelled documents of each class."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    known = labels.where(F.col(doc_id).isNotNull() & F.col(label).isin(0, 1)).select(F.col(doc_id).alias("__id"), F.col(label).cast("double").alias("__label"))
    counted = {r["__label"]: r["count"] for r in known.groupBy("__label").count().collect()}
    take = lambda y: hashed_sample(known.where(F.col("__label") == y), "__id", most, counted.get(y, 0))
    sample = materialize(take(1.0).union(take(0.0)))
    rate = counted.get(1.0, 0) / max(1, sum(counted.values())) if counted else 1.0
    rows = docs.select(F.col(doc_id).alias("__id"), F.col(text).cast("string").alias("__text")).join(F.broadcast(sample), "__id")  # at most 2 * most rows
    found = materialize(with_features(rows.select("__label", "__text"), "__text").drop("__text"))
    held = {r["__label"]: r["count"] for r in found.groupBy("__label").count().collect()}
    if len(held) < 2:
        return Evidence(np.zeros(len(FEATURES)), float(np.log(max(rate, 1e-6) / max(1 - rate, 1e-6))), rate)
    shares = {c: counted[c] / held[c] for c in held}  # a class cut by the bound keeps its weight
    weight = F.when(F.col("__label") == 1, F.lit(shares[1.0])).otherwise(F.lit(shares[0.0]))
    rows = VectorAssembler(inputCols=[f"__{f}" for f in FEATURES], outputCol="x").transform(found.withColumn("w", weight / (sum(counted.values()) / sum(held.values()))))
    model = LogisticRegression(featuresCol="x", labelCol="__label", weightCol="w", regParam=1e-4, maxIter=60).fit(rows)
    return Evidence(model.coefficients.toArray(), model.intercept, rate)


def _strength(sites: DataFrame, rate: float) -> float:
    """How many documents a site's prior counts for: p(1-p) over the variance between sites, less 1."""
    noise = rate * (1 - rate)
    row = sites.agg(
        (F.sum(F.col("n") * F.pow(F.col("s") / F.col("n") - F.col("parent"), 2)) / F.sum("n")).alias("spread"), (F.count("*") / F.sum("n")).alias("per_doc")
    ).first()
    if row.spread is None:
        return 100.0
    between = row.spread - noise * row.per_doc
    return float(np.clip(noise / between - 1, 2.0, 1e4)) if between > 0 else 1e4


def site_priors(scored: DataFrame, host: str, path: str) -> tuple[DataFrame, float, float, float]:
    """(sites, rate, host strength, path strength); sites has host, path, the sums of
    both levels, and ``__p`` summed from ``scored``."""
    sums = materialize(scored.groupBy(host, path).agg(F.count("*").alias("path_n"), F.sum("__p").alias("path_s")))
    total = sums.agg(F.sum("path_n").alias("n"), F.sum("path_s").alias("s")).first()
    rate = float(np.clip(total.s / total.n, 1e-6, 1 - 1e-6)) if total.n else 0.5
    hosts = materialize(sums.groupBy(host).agg(F.sum("path_n").alias("host_n"), F.sum("path_s").alias("host_s")))
    by_host = _strength(hosts.select(F.col("host_n").alias("n"), F.col("host_s").alias("s"), F.lit(rate).alias("parent")), rate)
    joined = sums.join(hosts.withColumnRenamed(host, "__h"), F.col(host).eqNullSafe(F.col("__h"))).drop("__h")
    mean = (F.col("host_s") + by_host * rate) / (F.col("host_n") + by_host)
    by_path = _strength(joined.select(F.col("path_n").alias("n"), F.col("path_s").alias("s"), mean.alias("parent")), rate)
    return materialize(joined), rate, by_host, by_path


def _posterior(rows: DataFrame, sites: DataFrame, host: str, path: str, rate: float, by_host: float, by_path: float, trained: float) -> DataFrame:
    """``rows`` (with __logit and __p) and __site, __posterior; without each row's own share in the site."""
    named = sites.withColumnsRenamed({host: "__h", path: "__q"} | {n: f"__{n}" for n in ("host_n", "host_s", "path_n", "path_s")})
    named = F.broadcast(named) if sites.count() <= MOST_BROADCAST else named
    joined = rows.join(named, F.col(host).eqNullSafe(F.col("__h")) & F.col(path).eqNullSafe(F.col("__q"))).drop("__h", "__q")
    p = F.col("__p")
    host_mean = (F.col("__host_s") - p + by_host * rate) / (F.col("__host_n") - 1 + by_host)
    site = (F.col("__path_s") - p + by_path * host_mean) / (F.col("__path_n") - 1 + by_path)
    post = 1 / (1 + F.exp(-(F.col("__logit") - _logit(F.lit(trained)) + _logit(site))))
    return joined.withColumn("__site", site).withColumn("__posterior", post).drop("__host_n", "__host_s", "__path_n", "__path_s")


def score(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source", path: str = "lang", label: str = "quality", keep_text: bool = True) -> DataFrame:
    """``docs`` with __logit, __p (evidence), __site (prior) and __posterior appended; no shuffle of texts
    unless the table of sites is too large to broadcast. Without ``keep_text`` the text is left out and
    its features are computed once; with it, once for the sites and once beside the text."""
    evidence = fit(docs, labels, doc_id, text, label)
    names = [f"__{f}" for f in FEATURES]
    logit = evidence.logit()
    if not keep_text:
        slim = with_features(docs.withColumn("__text", F.col(text).cast("string")).drop(text), "__text").withColumn("__logit", logit).drop("__text", *names)
        rows = materialize(slim.withColumn("__p", 1 / (1 + F.exp(-F.col("__logit")))))
        sites, rate, by_host, by_path = site_priors(rows, host, path)
        return _posterior(rows, sites, host, path, rate, by_host, by_path, evidence.rate)
    light = with_features(docs.select(F.col(host).alias("__host"), F.col(path).alias("__path"), F.col(text).cast("string").alias("__text")), "__text").select("__host", "__path", logit.alias("__logit"))
    light = light.withColumn("__p", 1 / (1 + F.exp(-F.col("__logit"))))
    sites, rate, by_host, by_path = site_priors(light, "__host", "__path")
    rows = with_features(docs.withColumn("__text", F.col(text).cast("string")), "__text").withColumn("__logit", logit).drop("__text", *names)
    rows = rows.withColumn("__p", 1 / (1 + F.exp(-F.col("__logit"))))
    return _posterior(rows, sites.withColumnsRenamed({"__host": "__site_host", "__path": "__site_path"}).withColumnsRenamed({"__site_host": host, "__site_path": path}), host, path, rate, by_host, by_path, evidence.rate)


def accepted(docs: DataFrame, labels: DataFrame, least: float = 0.5, **names) -> DataFrame:
    """The rows of ``docs`` whose posterior is ``least`` or more."""
    own = {"doc_id": "doc_id", "text": "text", "host": "source", "path": "lang"} | {k: v for k, v in names.items() if k in ("doc_id", "text", "host", "path")}
    # the labels' id is the documents' id by name
    plain, places = numbered_columns(docs, *own.values())
    named = labels.withColumnRenamed(own["doc_id"], places[0])
    scored = score(plain, named, **(names | dict(zip(own, places, strict=True))))
    return scored.where(F.col("__posterior") >= least).select(*plain.columns).toDF(*docs.columns)


def site_of(url):
    """(host, first path segment) of a URL column, for tables of pages."""
    bare = F.regexp_replace(F.col(url), r"^[a-zA-Z][a-zA-Z0-9+.-]*://", "")
    return F.lower(F.regexp_extract(bare, r"^([^/?#:]*)", 1)), F.regexp_extract(bare, r"^[^/?#]*/([^/?#]*)", 1)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10: evidence, site prior and posterior of every document. As documents have no URL, their source
    stands for the host and their language for the path."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source", "lang")
    out = score(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), keep_text=False)
    return out.select("doc_id", F.col("__p").alias("evidence"), F.col("__site").alias("site_prior"), F.col("__posterior").alias("score"), (F.col("__posterior") >= 0.5).alias("accepted"))

"""Importance resampling (operator 13) against plain arithmetic, its SQL and its edge cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from oracle import same
from rivulet.llm import resample

FOLDING = {c: c + 32 for c in range(65, 91)}


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(FOLDING))


def features(text, most):
    w = words(text)
    return [zlib.crc32(" ".join(w[i : i + k]).encode()) for k in range(1, most + 1) for i in range(len(w) - k + 1)]


def plain(docs, target, most=1, buckets=10000, percent=10, least=20, seed="2024"):
    have, want = Counter(), Counter()
    for _, t in docs:
        have.update(f % buckets for f in features(t, most))
    for t in target:
        want.update(f % buckets for f in features(t, most))
    s, t = have.total(), want.total()
    gain = [math.floor(1000 * math.log((want[b] + 1) * (s + buckets) / ((have[b] + 1) * (t + buckets)))) for b in range(buckets)]
    rows = []
    for i, text in docs:
        f = features(text, most)
        weight = sum(gain[x % buckets] for x in f)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(words(text)), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    order = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0]))
    for k, r in enumerate(order[: percent * len(order) // 100]):
        r[5] = k + 1
    return sorted(map(tuple, rows), key=repr)


def corpus(n, seed):
    r = random.Random(seed)
    some = ["Été", "x", "in", "data", "the", "A1", "naïve", "中文", "y" * 60, "z" * 300]
    return [(i, " ".join(r.choice(some) + r.choice(["", "-", ".", "\n"]) for _ in range(r.randrange(60)))) for i in range(n)]


@pytest.mark.parametrize("most", [1, 3])
def test_scores_are_plain_arithmetic(spark, most):
    docs = [*corpus(300, 1), (1000, None), (1001, ""), (1002, "..."), (None, "the data " * 30)]
    target = ["the data in data", None, "", "Été naïve x"]
    # clashing names beside id and text
    frame = spark.createDataFrame([(*d, 1, "q", 2.0) for d in docs], "doc_id long, text string, rank int, at string, weight double").repartition(5)
    items = spark.createDataFrame([(t, 3) for t in target], "text string, counts int")
    got = resample.scores(frame, items, most_words=most, buckets=500, percent=20)
    assert got.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain(docs, target, most, 500, 20)
    drawn = resample.draw(frame, items, most_words=most, buckets=500, percent=20)
    assert drawn.columns == frame.columns
    assert sorted(map(str, (r.doc_id for r in drawn.collect()))) == sorted(str(r[0]) for r in plain(docs, target, most, 500, 20) if r[5])


@pytest.mark.parametrize("most", [1, 2, 4])
def test_long_texts_in_pieces(spark, monkeypatch, most):
    monkeypatch.setattr(resample, "SLICE_BYTES", 40)
    text = "the data, in A1 naïve " * 20 + "w" * 200 + "... " * 50 + "end of it"
    data = np.frombuffer(text.encode(), np.uint8)
    parts = list(resample._parts(data, np.array([0, len(data)]), most))
    assert len(parts) > 5
    found = Counter()
    for _, own, cut in parts:
        w = resample.Words(data, own, resample.ALNUM, hashes=False)
        for bucket, _ in resample._features(w, most, 1 << 20, int(np.searchsorted(w.starts, cut - own[0]))):
            found.update(bucket.tolist())
    assert found == Counter(f % (1 << 20) for f in features(text, most))


def test_ties_repeats_and_empty_tables(spark):
    docs = [(3, "the data " * 15)] * 3 + [(4, "the data " * 15)]
    frame, items = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([("the",)], "text string")
    got = resample.scores(frame, items, percent=50).collect()
    assert len(got) == 4 and sorted(r.rank for r in got if r.rank) == [1, 2]
    assert len({r.score for r in got if r.doc_id == 3}) == 1
    assert resample.scores(frame.limit(0), items).count() == 0
    empty = resample.scores(frame, items.limit(0)).collect()
    assert sorted((tuple(r) for r in empty), key=repr) == plain(docs, [])


def test_ranks_run_over_partitions(spark):
    rows = spark.range(5000).selectExpr("id", "20 + id % 3 AS n_words", "id % 7 AS score").repartition(9)
    got = resample.ranked(rows, 30, 21).where("rank is not null").orderBy("rank").collect()
    want = sorted((i for i in range(5000) if i % 3), key=lambda i: (-(i % 7), i))[: 30 * sum(i % 3 > 0 for i in range(5000)) // 100]
    assert [r.id for r in got] == want and [r["rank"] for r in got] == list(range(1, len(want) + 1))


def test_query(spark, sf):
    assert same(spark, sf, resample.query, resample.ORACLE_SQL)

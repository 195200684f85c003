"""Packing (operator 11) against the public library, brute force and the least number of sequences."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from rivulet.llm import packing


@pytest.fixture(scope="module")
def coder():
    return packing.Encoder(packing.vocabulary())


def encoded(coder, texts):
    out = []
    for _, ids, bounds in coder.texts(pa.array(texts, pa.string())):
        out += [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    return out


def by_library(coder, texts):
    return [e.ids for e in coder.library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_words_are_the_librarys(coder):
    r = random.Random(7)
    signs = " \t\n\r'abcdelmrstv  '''19.,!?é 　​́中٣\x1c\x85\U0001f600ᲉⅧ½ǅ"
    texts = ["".join(r.choice(signs) for _ in range(r.randrange(30))) for _ in range(4000)]
    texts += ["it's we're they'll I'd 'tis 'sabc ''s '' 's's  'll", "don't\n\n  x  ", "", None, "<|endoftext|> a<|endoftext|>", "a" * 5000]
    assert encoded(coder, texts) == by_library(coder, texts)


def test_long_texts_and_forgotten_words(coder, monkeypatch):
    monkeypatch.setattr(packing, "SLICE", 50)
    monkeypatch.setattr(packing, "MOST_WORDS", 20)
    texts = ["x y " * 100 + "'s" + " z" * 50, "'" * 300, "ab cd. " * 90, None, " ".join(f"w{i}" for i in range(300))]
    assert encoded(coder, texts) == by_library(coder, texts)


def test_clashing_hashes_go_to_the_library(monkeypatch):
    own = packing.Encoder(packing.vocabulary())
    real = own._hashes
    monkeypatch.setattr(own, "_hashes", lambda codes, starts: (real(codes, starts)[0] & np.uint64(3), real(codes, starts)[1]))
    texts = ["one two three four five", "six seven eight", "nine one ten"]
    assert encoded(own, texts) == by_library(own, texts)


def filled(plan, counts, cap):
    """The plan's patterns hold all pieces once and fit."""
    used = Counter()
    for n, pattern in plan.patterns:
        assert n > 0 and sum(x * k for x, k in pattern.items()) <= cap
        for x, k in pattern.items():
            used[x] += n * k
    return used == Counter({x: n for x, n in counts.items() if n})


@pytest.mark.parametrize("seed", range(25))
def test_plans_hold_all_pieces_once(seed):
    r = random.Random(seed)
    cap = r.choice([1, 2, 7, 30, 200])
    counts = {x: r.randrange(1, 40) for x in r.sample(range(1, cap + 1), r.randrange(0, cap + 1))}
    found = packing.plan(counts, cap)
    assert filled(found, counts, cap)
    assert found.sequences >= -(-sum(x * n for x, n in counts.items()) // cap)


def test_exact_complements_beat_best_fit():
    least = lambda counts, cap: -(-sum(x * n for x, n in counts.items()) // cap)
    better = 0
    for seed in range(40):
        r = random.Random(seed)
        counts = {x: r.randrange(1, 5) for x in r.sample(range(1, 60), 30)}
        left = np.zeros(101, np.int64)
        left[list(counts)] = list(counts.values())
        found, plain = packing.plan(counts, 100), packing.Plan(packing._best_fit(left))
        assert filled(plain, counts, 100) and least(counts, 100) <= found.sequences <= plain.sequences
        better += found.sequences < plain.sequences
    assert better
    left = np.zeros(2049, np.int64)
    left[[1024, 600, 300, 124]] = 1
    assert packing._Sums(left).exact(1024) == {1024: 1, 600: 1, 300: 1, 124: 1}
    assert packing.plan({}, 10).sequences == 0


def test_plans_do_not_grow_with_the_corpus():
    r = random.Random(1)
    counts = {x: r.randrange(1, 50) for x in range(1, 2049)}
    small, large = packing.plan(counts), packing.plan({x: n * 1_000_003 for x, n in counts.items()})
    assert filled(large, {x: n * 1_000_003 for x, n in counts.items()}, 2048)
    assert len(large.patterns) < 20_000
    least = -(-sum(x * n for x, n in counts.items()) // 2048)
    assert small.sequences <= least * 1.02


def test_packing_against_brute_force(spark, coder):
    r = random.Random(3)
    texts = [None, "", "a b c", "a b c", *[" ".join(r.choice(["tea", "stone", "river's", "42"]) for _ in range(r.randrange(200))) for _ in range(60)], "long " * 300, "x " * 100]
    rows = [(i if i != 5 else None, t, 1, "p", 2) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length int, part string, piece int").repartition(3)
    found = packing.pack(docs, cap=64, with_ids=True)
    got = found.collect()
    want = {i if i != 5 else None: [*ids, 0] for i, ids in enumerate(by_library(coder, texts))}
    pieces, places = defaultdict(dict), defaultdict(list)
    for row in got:
        pieces[row.doc_id][row.piece] = row
        places[row.sequence_id].append((row.offset, row.length))
    assert set(pieces) == set(want)
    for i, ids in want.items():
        own = [pieces[i][k] for k in range(len(pieces[i]))]
        assert [x for p in own for x in p.ids] == ids
        assert all(p.length == 64 for p in own[1:]) and own[0].length <= 64
        for p in own:
            assert p.ids == ids[p.start : p.start + p.length] and p.ids_crc32 == zlib.crc32(np.array(p.ids, "<u4").tobytes())
    for at in places.values():
        ends = [0, *np.cumsum([n for _, n in sorted(at)]).tolist()]
        assert [o for o, _ in sorted(at)] == ends[:-1] and ends[-1] <= 64
    total = sum(map(len, want.values()))
    assert len(places) <= -(-total // 64) + 1
    rebuilt = {r.sequence_id: r.input_ids for r in packing.sequences(found).collect()}
    assert sum(map(len, rebuilt.values())) == total
    one = got[0]
    assert rebuilt[one.sequence_id][one.offset : one.offset + one.length] == one.ids
    assert packing.pack(docs.limit(0)).count() == 0


def test_query_packs_whole_table(spark, sf):
    got = packing.query(spark, sf)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    rows = got.collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id").collect()}
    least = -(-sum(r.length for r in rows) // packing.CAP)
    assert len({r.sequence_id for r in rows}) <= least + 1

"""Each operator against brute force, its SQL, an exact round trip or held-out labels, and its edge cases."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from oracle import same
from rivulet.llm import decontaminate, extract, language, near_dedup, quality, registry, sentencepieces, substring_dedup, topk, toxicity, warc
from rivulet.llm._common import ALNUM, FOLD, Words, maybe_members, row_key, text_bytes, winnow, without
from rivulet.llm.graph import components, merged

FOLDING = {c: c + 32 for c in range(65, 91)}


def alnum(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(FOLDING))


def prose(n, seed, vocabulary=4000):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))


def docs_of(spark, texts, extra=True):
    rows = [(i, t, "x", "y") for i, t in texts]
    df = spark.createDataFrame(rows, "doc_id long, text string, _key string, h string")
    return df if extra else df.select("doc_id", "text")


# ----------------------------------------------------------------------- helpers


def test_words_and_winnowing_guarantee():
    texts = ["Ab cÉ-9", "", None, "x" * 50 + " y", prose(300, 1)]
    data, offsets = text_bytes(pa.array(texts))
    words = Words(data, offsets, ALNUM)
    assert words.counts.tolist() == [len(alnum(t)) for t in texts]
    grams, at = words.grams(5)
    keep = winnow(grams, words.text_of[at], 6)
    gaps = np.diff(np.flatnonzero(words.text_of[at[keep]] == 4))
    assert len(gaps) and max(np.diff(at[keep][words.text_of[at[keep]] == 4])) <= 6
    assert FOLD[ord("Q")] == ord("q")


def test_components_and_merge(spark):
    edges = [(i, i + 1) for i in range(0, 40) if i % 7 != 6] + [(100, 3), (5, 5)]
    found = {r.node: r.comp for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found[100] == found[3] == 0
    assert found[41 - 1] == 35
    more = merged(spark.createDataFrame(list(found.items()), "node long, comp long"), spark.createDataFrame([(40, 100), (7, 500)], "a long, b long"))
    got = {r.node: r.comp for r in more.collect()}
    assert got[40] == got[100] == got[0]
    assert got[7] == got[500]
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_without_is_exact(spark):
    df = spark.range(2000).withColumn("k", F.xxhash64("id"))
    gone = df.where("id % 5 = 0").select("k")
    assert without(df, F.col("k"), gone).count() == 1600
    assert maybe_members(df, F.col("k"), gone).where("id % 5 = 0 and not __maybe").count() == 0


# --------------------------------------------------------------- 1 decontamination


def brute_contamination(docs, items, span=10):
    wins = defaultdict(set)
    for i, t in items:
        w = alnum(t)
        if w:
            for p in range(max(len(w) - span, 0) + 1):
                wins[tuple(w[p : p + span])].add(str(i))
    out = {}
    for d, t in docs:
        w, hit, ids = alnum(t), set(), set()
        for m in {len(k) for k in wins}:
            for p in range(len(w) - m + 1):
                if tuple(w[p : p + m]) in wins:
                    hit |= set(range(p, p + m))
                    ids |= wins[tuple(w[p : p + m])]
        out[d] = (len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit))
    return out


def test_decontamination(spark):
    item = prose(30, 5)
    words = item.split()
    items = [(1, item), (2, item), (10, "short one"), (11, " ".join(words[3:12])), (3, None), (4, "!!"), (5, "rep " * 30)]
    docs = [(1, "a " + item + " b"), (2, " ".join(words[5:15])), (3, " ".join(words[5:14])), (4, None), (5, ""), (6, "Short, ONE"), (7, "rep " * 12), (8, prose(400, 9) + " " + " ".join(words[0:10]) + " " + " ".join(words[20:30]) + " " + prose(50, 3)), (9, "rep " * 9)]
    out = decontaminate.contamination(docs_of(spark, docs), spark.createDataFrame([(i, t, 0) for i, t in items], "item_id int, text string, cls int"))
    got = {r.doc_id: (r.n_words, r.n_hit, len(r["items"]), hashlib.sha256(",".join(r["items"]).encode()).hexdigest(), r.contaminated) for r in out.collect()}
    assert got == brute_contamination(docs, items)
    kept = decontaminate.decontaminate(docs_of(spark, docs), spark.createDataFrame(items, "item_id int, text string"))
    assert {r.doc_id for r in kept.collect()} == {d for d, v in got.items() if not v[4]}
    assert kept.columns == ["doc_id", "text", "_key", "h"]


def test_common_phrases_bring_no_rows_together(spark):
    """300 documents and 300 items share five words, and one pair a run of twelve."""
    phrase, run = "five words that all share", prose(12, 9)
    around = lambda i: f"{prose(9, 5000 + i)} {phrase} {prose(9, 9000 + i)}"
    docs = [(i, around(i)) for i in range(300)] + [(1000, f"{prose(8, 1)} {run} {phrase} {prose(9, 2)}")]
    items = [(i, around(i + 4000)) for i in range(300)] + [(1000, f"{prose(8, 3)} {run} {phrase} {prose(9, 4)}")]
    frame = spark.createDataFrame(items, "item_id int, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, len(r["items"]), hashlib.sha256(",".join(r["items"]).encode()).hexdigest(), r.contaminated) for r in decontaminate.contamination(docs_of(spark, docs), frame).collect()}
    assert got == brute_contamination(docs, items) and got[1000][1] == 17
    _, spans, _ = decontaminate.hits(docs_of(spark, docs), frame)
    plan = spans._jdf.queryExecution()
    spans.collect()
    rows = [int(x) for x in re.findall(r"number of output rows: (\d+)", plan.executedPlan().toString())]
    assert spans.count() <= 600 and all(n <= 600 for n in rows)


def test_decontamination_empty_tables(spark):
    items = spark.createDataFrame([(1, "a b")], "item_id int, text string")
    docs = docs_of(spark, [(1, "a b"), (1, "a b")])
    assert decontaminate.contamination(docs.limit(0), items).count() == 0
    assert [r.contaminated for r in decontaminate.contamination(docs, items.limit(0)).collect()] == [False, False]
    assert [r.n_hit for r in decontaminate.contamination(docs, items).collect()] == [2, 2]


def test_items_without_ids_hit(spark):
    items = spark.createDataFrame([(None, "a b"), (None, "c d"), (4, "c d")], "item_id int, text string")
    docs = docs_of(spark, [(1, "x a b"), (2, "c d a b"), (3, "y")])
    got = {r.doc_id: (r.n_hit, r["items"], r.contaminated) for r in decontaminate.contamination(docs, items).collect()}
    assert got == {1: (2, [None], True), 2: (4, ["4", None], True), 3: (0, [], False)}
    assert [r.doc_id for r in decontaminate.decontaminate(docs, items).collect()] == [3]


# -------------------------------------------------------------- 2 substring dedup


def test_repeated_passages(spark):
    p = prose(70, 11).split()
    fuzzy = [w if i % 17 else "edited" for i, w in enumerate(p)]
    del fuzzy[30]
    docs = [(1, prose(200, 1) + " " + " ".join(p) + " " + prose(100, 2)), (2, prose(150, 3) + " " + " ".join(p)), (3, " ".join(fuzzy) + " " + prose(90, 4)), (4, prose(300, 5)), (5, None), (6, ""), (7, prose(20, 1))]
    rows = substring_dedup.passages(docs_of(spark, docs)).collect()
    spans = [(r.after - r.first, r.matched) for r in rows]
    assert len(rows) == 3  # each pair of the three holders
    assert all(n >= 50 and m >= 0.8 * n for n, m in spans)
    cut = {r.doc_id: r.text for r in substring_dedup.cut(docs_of(spark, docs)).collect()}
    assert set(cut) == {1, 2, 3, 4, 5, 6, 7}
    assert cut[4] == docs[3][1]
    assert cut[5] is None
    assert sum(" ".join(p[5:25]) in (t or "") for t in cut.values()) == 1


def test_whole_copies_go_and_repeated_rows_stay(spark):
    text = prose(120, 8)
    df = spark.createDataFrame([(1, text, 9), (2, text, 9), (3, prose(80, 9), 9), (3, prose(80, 9), 9)], "doc_id long, text string, n_chars int")
    out = substring_dedup.cut(df).collect()
    assert sorted(r.doc_id for r in out if r.doc_id != 3) in ([1], [2])
    assert sum(r.doc_id == 3 for r in out) == 2
    assert substring_dedup.cut(df.limit(0)).count() == 0


def uncovered_windows(docs, rows, size=50):
    """Windows of ``size`` words that a document of smaller key holds and no passage covers."""
    texts = {r.key: alnum(r.text) for r in docs.select(substring_dedup.row_key("doc_id", "text").alias("key"), "text").collect()}
    first = {}
    for key in sorted(texts):
        for j in range(len(texts[key]) - size + 1):
            first.setdefault(tuple(texts[key][j : j + size]), key)
    spans = defaultdict(list)
    for r in rows:
        assert r.other != r.key and texts[r.key] and r.after - r.first >= size
        spans[r.key].append((r.first, r.after))
    return [(key, j) for key, w in texts.items() for j in range(len(w) - size + 1) if first[tuple(w[j : j + size])] != key and not any(a <= j and j + size <= b for a, b in spans[key])]


def test_exact_repeats_whose_parts_occur_elsewhere(spark):
    p, line = prose(60, 21).split(), prose(12, 22)
    rows = [(i, f"{prose(30, 40 + i)} {' '.join(p)} {prose(30, 60 + i)}") for i in range(2)]
    rows += [(10 + i, f"{prose(9, 80 + i)} {' '.join(p[30 * (i % 2):][:30])} {prose(9, 120 + i)}") for i in range(30)]
    rows += [(50 + i, f"{prose(20, 200 + i)} {' '.join([line] * 6)} {prose(20, 210 + i)}") for i in range(2)]
    rows += [(60 + i, f"{prose(20, 220 + i)} {' '.join(prose(300, 23).split()[4 * i:][:50])} {prose(20, 230 + i)}") for i in range(6)]
    rows += [(70 + i, " ".join(prose(300, 24).split()[:50])) for i in range(3)]
    docs = docs_of(spark, rows, extra=False)
    found = substring_dedup.passages(docs).collect()
    assert uncovered_windows(docs, found) == []
    assert found
    texts = {r.key: alnum(r.text) for r in docs.select(substring_dedup.row_key("doc_id", "text").alias("key"), "text").collect()}
    for r in found:
        if r.matched == r.after - r.first == r.o_after - r.o_first:
            assert texts[r.key][r.first : r.after] == texts[r.other][r.o_first : r.o_after]


def test_two_lone_seeds_on_different_diagonals_are_chained(spark):
    rows = [(1, 2, 10, 50, 0), (1, 2, 22, 63, 0), (1, 3, 10, 50, 0)]
    found = substring_dedup._chained(spark.createDataFrame(rows, "key long, other long, pos int, o_pos int, reach byte")).collect()
    assert [(r.key, r.other, r.first, r.after, r.o_first, r.o_after) for r in found] == [(1, 2, 10, 27, 50, 68)]


def test_recall_on_edited_passages(spark):
    """Passages of 70 words of which a tenth differ in the end, in documents that also hold short common lines."""
    r = random.Random(12)
    lines = [prose(9, 500 + i) for i in range(5)]
    rows, planted = [], []
    for i in range(40):
        p = prose(70, 600 + i).split()
        for j in range(2):
            words = [w if r.random() > 0.03 else f"e{r.randrange(10**6)}" for w in p]
            words = [w for w in words if r.random() > 0.015]
            rows.append((2 * i + j, f"{prose(60, 700 + 2 * i + j)} {r.choice(lines)} {' '.join(words)} {r.choice(lines)} {prose(40, 900 + 2 * i + j)}"))
        planted.append({2 * i, 2 * i + 1})
    docs = docs_of(spark, rows, extra=False)
    ids = {x.key: x.doc_id for x in docs.select(row_key("doc_id", "text").alias("key"), "doc_id").collect()}
    found = [{ids[x.key], ids[x.other]} for x in substring_dedup.passages(docs).collect()]
    assert sum(p in found for p in planted) >= 0.9 * len(planted)
    assert all(f in planted for f in found)


def test_passages_whose_seeds_are_first_held_elsewhere(spark):
    """Edited copies of which every third word run also stands in documents of its own."""
    p = prose(80, 31).split()
    one, two = list(p), list(p)
    for i in (13, 40, 66):
        one[i] = f"x{i}"
    rows = [(i, f"{prose(20, 300 + i)} {' '.join(p[8 * i : 8 * i + 14])} {prose(20, 340 + i)}") for i in range(9)] + [(100, " ".join(one)), (101, " ".join(two))]
    docs = docs_of(spark, rows, extra=False)
    ids = {x.key: x.doc_id for x in docs.select(row_key("doc_id", "text").alias("key"), "doc_id").collect()}
    found = [{ids[x.key], ids[x.other]} for x in substring_dedup.passages(docs).collect()]
    assert {100, 101} in found
    assert all(f == {100, 101} for f in found)


def test_recall_among_many_other_holders(spark):
    """Passages of 100 words that differ in 6 of 100, each beside 20 documents that hold 30 words of it."""
    r, rows, planted = random.Random(5), [], []
    for i in range(30):
        p = prose(100, 600 + i).split()
        for _ in range(2):
            words = [w if r.random() > 0.03 else f"e{r.randrange(10**6)}" for w in p]
            rows.append(f"{prose(60, 7000 + len(rows))} {' '.join(words)} {prose(40, 9000 + len(rows))}")
        planted.append(frozenset((len(rows) - 2, len(rows) - 1)))
        for _ in range(20):
            a = r.randrange(70)
            rows.append(f"{prose(30, 20000 + len(rows))} {' '.join(p[a : a + 30])} {prose(30, 40000 + len(rows))}")
    docs = docs_of(spark, list(enumerate(rows)), extra=False)
    ids = {x.key: x.doc_id for x in docs.select(row_key("doc_id", "text").alias("key"), "doc_id").collect()}
    found = {frozenset((ids[x.key], ids[x.other])) for x in substring_dedup.passages(docs).collect()}
    assert sum(p in found for p in planted) >= 0.9 * len(planted) and found <= set(planted)


def test_crowded_seeds_meet_all_their_holders(spark):
    """Two edited copies of a passage all of whose seeds stand in 30 documents of smaller and 30 of larger key, 14 words each."""
    p = prose(120, 88).split()
    one = [w if i % 20 != 3 else f"x{i}" for i, w in enumerate(p)]
    two = [w if i % 20 != 14 else f"y{i}" for i, w in enumerate(p)]
    rows = [(i, f"{prose(20, 300 + i)} {' '.join(p[2 * (i % 60) : 2 * (i % 60) + 14])} {prose(20, 700 + i)}") for i in range(300)]
    texts = [(1000 + i, f"{prose(30, 1100 + i)} {' '.join((one, two)[i % 2])} {prose(30, 1200 + i)}") for i in range(8)]
    keys = {x.doc_id: x.key for x in docs_of(spark, rows, extra=False).select(row_key("doc_id", "text").alias("key"), "doc_id").collect()}
    own = sorted((x.key, x.doc_id) for x in docs_of(spark, texts, extra=False).select(row_key("doc_id", "text").alias("key"), "doc_id").collect())
    # The pair of an edited copy of either kind whose keys lie nearest the middle of all holders.
    middle = sorted(keys.values())[len(keys) // 2]
    a = min((x for x in own if x[1] % 2 == 0), key=lambda x: abs(x[0] - middle))[1]
    b = min((x for x in own if x[1] % 2), key=lambda x: abs(x[0] - middle))[1]
    docs = docs_of(spark, rows + [t for t in texts if t[0] in (a, b)], extra=False)
    ids = {x.key: x.doc_id for x in docs.select(row_key("doc_id", "text").alias("key"), "doc_id").collect()}
    found = [(x.after - x.first, {ids[x.key], ids[x.other]}) for x in substring_dedup.passages(docs).collect()]
    assert max((n for n, f in found if f == {a, b}), default=0) >= 110
    assert all(f == {a, b} for _, f in found)


def test_runs_of_twelve_words_share_a_seed(spark):
    run = prose(12, 77)
    for n in range(20):
        rows = [(1, f"{prose(20, n)} {run} {prose(20, n + 100)}"), (2, f"{prose(30, n + 200)} {run} {prose(9, n + 300)}")]
        data, offsets = text_bytes(pa.array([t for _, t in rows]))
        words = Words(data, offsets, ALNUM)
        grams, at = words.grams(substring_dedup.K)
        of = words.text_of[at]
        keep = winnow(grams, of, substring_dedup.WINDOW)
        assert set(grams[keep[of[keep] == 0]].tolist()) & set(grams[keep[of[keep] == 1]].tolist())


def test_windows_of_seeds_and_where_shared_windows_can_lie():
    r = random.Random(8)
    texts = [" ".join(r.choice("abcdefgh") for _ in range(r.randrange(0, 90))) for _ in range(60)]
    data, offsets = text_bytes(pa.array(texts))
    words = Words(data, offsets, ALNUM)
    grams, at = words.grams(substring_dedup.K)
    of, size = words.text_of[at], substring_dedup.WINDOW
    keep = winnow(grams, of, size)
    reach = substring_dedup._reach(grams, of, keep)
    chosen = {int(k): (int(k) - int(x) // 8, int(k) - int(x) % 8) for k, x in zip(keep, reach, strict=True)}
    for t in range(len(texts)):
        own = np.flatnonzero(of == t)
        for s in range(own[0], max(own[-1] - size + 1, own[0]) + 1) if len(own) else ():
            part = grams[s : min(s + size, own[-1] + 1)]
            best = s + max(i for i in range(len(part)) if part[i] == part.min())
            assert chosen[best][0] <= s <= chosen[best][1]
    # all seeds that a window of 30 words chooses by itself are matched: then it lies in a stretch
    for t in range(len(texts)):
        own = keep[of[keep] == t]
        first = np.flatnonzero(of == t)[0] if (of == t).any() else 0
        matched = np.array([r.random() < 0.9 for _ in own], dtype=bool)
        pos, held = own - first, reach[of[keep] == t]
        found = list(substring_dedup.stretches(pos[matched], held[matched], 30))
        for p in range(len(texts[t].split()) - 29):
            starts = range(p, p + 30 - substring_dedup.K - size + 2)
            whole = all(m for k, x, m in zip(pos, held, matched, strict=True) if any(k - x // 8 <= s <= k - x % 8 for s in starts))
            assert whole == any(a <= p and p + 30 <= b for a, b in found)


def test_columns_may_have_any_names(spark):
    """Columns beside those that a stage reads pass through, whatever they are called."""
    passage = prose(80, 1)
    texts = [passage, passage + " more of it", prose(90, 2), prose(60, 3) + " " + passage, prose(70, 5), None]
    names = "__maybe __cell __b __w __gone __key __runs __own __changed __text __p __logit path_n path_s host_n host_s c0 c1 cls h key _key n_words first input_ids".split()
    rows = [(i, t, "h", "p", *range(len(names))) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, " + ", ".join(f"`{n}` long" for n in names))
    items = spark.createDataFrame([(1, prose(70, 5))], "item_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(6)], "doc_id long, quality int, toxic int")
    stages = {
        "near": near_dedup.deduplicate(docs),
        "substring": substring_dedup.cut(docs),
        "items": decontaminate.decontaminate(docs, items),
        "quality": quality.accepted(docs, labels, least=0.0),
    }
    for name, out in stages.items():
        assert out.columns == docs.columns, name
        for row in out.collect():
            assert tuple(row)[4:] == tuple(range(len(names))), name
    assert {r.doc_id for r in stages["items"].collect()} == {0, 1, 2, 3, 5}
    assert {r.doc_id for r in stages["near"].collect()} == {0, 2, 3, 4, 5}
    coded = sentencepieces.encode(docs)
    assert coded.columns == [*[c for c in docs.columns if c != "input_ids"], "input_ids"]
    assert [list(r.input_ids) for r in coded.orderBy("doc_id").collect()] == library_ids(texts)


def test_bit_filters_lose_no_member(spark):
    values = np.random.default_rng(1).integers(-(1 << 63), 1 << 63, 5000)
    held = substring_dedup.bit_filter(spark.createDataFrame([(int(v),) for v in values], "h long"), "h")
    assert held.may_hold(values.view(np.uint64)).all()
    assert held.may_hold(np.arange(100000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).mean() < 0.05


def test_chaining_is_optimal_under_the_gap_limit():
    def total(path, s, o, z):
        gaps = [(s[b] - s[a] - z[a], o[b] - o[a] - z[a]) for a, b in zip(path, path[1:], strict=False)]
        if any(not 0 <= x <= substring_dedup.MOST_GAP for g in gaps for x in g):
            return -1e9
        return sum(z[i] for i in path) - substring_dedup.GAP_COST * sum(g + h for g, h in gaps)

    r = random.Random(5)
    for _ in range(200):
        n = r.randrange(2, 9)
        s = np.array(sorted(r.sample(range(120), n)))
        o = np.array([r.randrange(120) for _ in range(n)])
        z = np.array([r.choice([5, 5, 8, 60]) for _ in range(n)])
        best = max(total([i for i in range(n) if mask >> i & 1], s, o, z) for mask in range(1, 1 << n))
        assert abs(total(substring_dedup.chains(s, o, z)[0], s, o, z) - best) < 1e-9
    # A long passage out of reach does not hide the near fragments that follow it.
    s, o, z = np.array([0, 230, 240, 250]), np.array([0, 235, 246, 257]), np.array([200, 5, 5, 5])
    assert [1, 2, 3] in substring_dedup.chains(s, o, z)
    assert [1, 2] in substring_dedup.chains(np.array([0, 260, 270]), np.array([0, 260, 270]), np.array([200, 5, 40]))
    for _ in range(20):  # the trees against a plain search
        n = r.randrange(20, 120)
        s, o = np.array(sorted(r.sample(range(600), n))), np.array([r.randrange(600) for _ in range(n)])
        z = np.array([r.choice([5, 6, 9]) for _ in range(n)])
        score = [float(x) for x in z]
        for j in range(n):
            for i in range(n):
                g, h = s[j] - s[i] - z[i], o[j] - o[i] - z[i]
                if 0 <= g <= substring_dedup.MOST_GAP and 0 <= h <= substring_dedup.MOST_GAP:
                    score[j] = max(score[j], z[j] + score[i] - substring_dedup.GAP_COST * (g + h))
        assert abs(total(substring_dedup.chains(s, o, z)[0], s, o, z) - max(score)) < 1e-9


# ------------------------------------------------------------------------ 3 WARC


def test_warc_round_trip(spark, tmp_path):
    rows = [(1, "u", "x" * 50000), (2, "u2", "x" * 50000), (2, "u2", "x" * 50000), (3, "u3", None), (4, "u4", ""), (None, "n", "yé"), (5, None, "z\r\n\r\n" * 9000), (5, None, "z\r\n\r\n" * 9000), (6, "v", "0\r\n\r\n")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, digest int")
    warc.write(df, str(tmp_path / "w"))
    back = warc.read(spark, str(tmp_path / "w")).cache()
    assert back.where("error is not null").count() == 0
    got = Counter((r.page, bytes(r.payload).decode()) for r in back.where("kind = 'response'").collect())
    assert got == Counter({("2", "x" * 50000): 2, ("4", ""): 1, (None, "yé"): 1, ("5", "z\r\n\r\n" * 9000): 2, ("6", "0\r\n\r\n"): 1})
    revisits = {(r.page, r.refers_to, r.payload_bytes) for r in warc.resolve(back).where("kind = 'revisit'").collect()}
    assert revisits == {("1", "2", 50000), ("3", "4", 0)}


@pytest.mark.parametrize("segment", [3, 7, 16])
def test_line_ends_at_every_cut_come_back(spark, tmp_path, segment):
    r = random.Random(segment)
    texts = ["".join(r.choice("\r\n\r\nx") for _ in range(r.randrange(40))) for _ in range(250)]
    texts += ["\r\n" * n for n in range(12)] + ["x" * n + "\r\n\r\n\r\n" for n in range(20)]
    df = spark.createDataFrame(list(enumerate(texts)), "page_id long, html string").selectExpr("page_id", "'u' AS url", "html").repartition(3)
    warc.write(df, str(tmp_path / "w"), segment=segment, chunk=5, least=1000)
    back = warc.read(spark, str(tmp_path / "w")).collect()
    assert not [r.error for r in back if r.error]
    assert sorted((int(r.page), bytes(r.payload).decode()) for r in back) == list(enumerate(texts))


def test_long_pages_of_line_ends(spark, tmp_path):
    r = random.Random(4)
    lines = lambda n: "".join(r.choice(["\r\n", "\r\n\r\n", "<p>", "word ", "\r", "\n"]) for _ in range(n))
    texts = [lines(r.randrange(8_000, 25_000)) for _ in range(100)] + [lines(r.randrange(100)) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "page_id long, html string").selectExpr("page_id", "'u' AS url", "html")
    warc.write(df, str(tmp_path / "w"), least=1_000_000)
    back = warc.read(spark, str(tmp_path / "w")).collect()
    assert not [r.error for r in back if r.error]
    assert sorted((int(r.page), bytes(r.payload).decode()) for r in back) == list(enumerate(texts))


def test_warc_query_removes_its_archives_and_takes_an_empty_table(spark, sf, tmp_path):
    from pathlib import Path

    folder = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    assert warc.query(spark, sf).count() and not list(folder.glob("warc-*"))
    spark.read.parquet(f"{sf}/pages.parquet").limit(0).write.parquet(f"{tmp_path}/pages.parquet")
    assert warc.query(spark, str(tmp_path)).count() == 0


def test_warc_damage_is_reported(spark, tmp_path):
    import glob
    import gzip

    df = spark.createDataFrame([(1, "u", "a" * 40000), (2, "v", "b")], "page_id long, url string, html string").coalesce(1)
    warc.write(df, str(tmp_path / "w"))
    path, = glob.glob(f"{tmp_path}/w/*.gz")
    raw = gzip.open(path).read()
    records = raw.split(b"WARC/1.1\r\n")[1:]
    lost = [r for r in records if b"WARC-Segment-Number: 2" not in r]
    changed = [r.replace(b"\r\nb\r\n", b"\r\nc\r\n") for r in lost]
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "x.warc.gz").write_bytes(gzip.compress(b"".join(b"WARC/1.1\r\n" + r for r in changed)))
    errors = {r.page: r.error for r in warc.read(spark, str(tmp_path / "d")).collect()}
    assert errors == {"1": "segments", "2": "digest", None: "archive: records are missing"}


def test_damaged_archives_give_error_rows(spark, tmp_path):
    import glob
    import gzip

    df = spark.createDataFrame([(i, "u", f"page {i} " + "\r\n\r\nx" * 20) for i in range(40)], "page_id long, url string, html string").coalesce(1)
    warc.write(df, str(tmp_path / "w"))
    path, = glob.glob(f"{tmp_path}/w/*.gz")
    raw = gzip.open(path).read()
    records = [b"WARC/1.1\r\n" + r for r in raw.split(b"WARC/1.1\r\n")[2:-1]]
    info = b"WARC/1.1\r\nWARC-Type: warcinfo\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    archives = {
        "a": gzip.compress(info) + b"".join(gzip.compress(r) for r in records),  # a member a record
        "b": gzip.compress(b"garbage" + records[0] + records[1]),
        "c": gzip.compress(records[2] + records[3].replace(b"Content-Length", b"Content-Size") + records[4]),
        "d": open(path, "rb").read()[:-40],
        "e": b"no gzip at all",
        "f": gzip.compress(records[5][:-30]),
        "g": b"",
    }
    for name, content in archives.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "x.warc.gz").write_bytes(content)
    found = {n: warc.read(spark, str(tmp_path / n)).collect() for n in archives}
    good = {n: sum(r.error is None for r in rows) for n, rows in found.items()}
    bad = {n: [r.error for r in rows if r.error] for n, rows in found.items()}
    assert good == {"a": 40, "b": 1, "c": 2, "d": good["d"], "e": 0, "f": 0, "g": 0}
    assert good["d"] <= 40
    assert bad == {"a": [], "b": ["archive: no record head"], "c": ["archive: no length"], "d": bad["d"], "e": ["archive: no records"], "f": ["archive: cut off"], "g": []}
    assert bad["d"] == ["archive: cut off"]


# ------------------------------------------------------------------ 4 extraction


def test_extraction(spark):
    page = '<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href="/x">Menu</a></li></ul></nav><div class="ad">Buy now, of the and.</div><article><h1>Head&amp;line</h1><p><b>First\n  words, of a story.<br><p>Second &copy; paragraph, which is longer than the first.</p></article><footer>&copy; x.example</footer></body></html>'
    rows = [(1, "u", page), (2, None, None), (3, "v", ""), (4, "w", "<div><p>"), (5, "x", page[: page.index("longer") + 3]), (1, "u", page), (6, "y", "<" * 500)]
    df = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, text string")
    out = sorted(map(tuple, extract.extract(df).select("page_id", "text").collect()))
    want = "Head&line First words, of a story. Second © paragraph, which is longer than the first."
    assert out[0] == out[1] == (1, want)
    assert [t for _, t in out[2:5]] == ["", "", ""]
    assert out[5] == (5, want[: want.index("longer") + 3])
    assert extract.extract(df.limit(0)).count() == 0


def test_heads_without_an_end_tag_and_formulas():
    article = "<article><h1>Headline of it</h1><p>First words, of a story that goes on for a while, as stories do.</p><p>The law is <math><mi>E</mi><mo>=</mo><mi>m</mi><annotation>E=m</annotation></math>, and that is all of it, they say.</p></article>"
    want = "Headline of it First words, of a story that goes on for a while, as stories do. The law is E=m, and that is all of it, they say."
    for head in ("<head><title>T</title>{}</head><body>", "<head><title>T</title>{}<body>", "<head><title>T</title>{}", ""):
        page = "<html>" + head.format("<meta charset=x><style>p{}</style><template><p>No</p></template>") + article
        assert extract.main_texts([page], extract.default_model()) == [want], head
    assert extract.Page("<head><title>T</title> plain text").runs == [(0, "plain text")]


@pytest.mark.parametrize("raw", ["<script>for(i=0;i<n;i++){}</script>", "<script><!-- x=1 </script>", """<script>document.write("<a href='x")</script>""", "<style>a<b{}</style>", "<textarea><!-- <p </textarea>", "<SCRIPT>if (a<b && c>d) '<!--'</SCRIPT>"])
def test_raw_elements_end_at_their_end_tag(raw):
    words = "The council met on Monday, and spoke of the bridge for two hours. It will be mended in spring, the mayor said."
    page = f"<html><head>{raw}</head><body>{raw}<nav><ul><li><a href='/'>Home</a></li><li><a href='/n'>News</a></li></ul></nav>{raw}<article><h1>The bridge</h1>{raw}<p>{words}</p>{raw}<p>{words}</p></article>{raw}<footer>&copy; x.example</footer>{raw}</body></html>"
    assert extract.main_texts([page], extract.default_model()) == [f"The bridge {words} {words}"]


def test_pages_of_few_blocks_and_odd_attributes():
    pages = {
        "<p class=x'>First words of it, here. </p><p>Second ones, too.</p>": "First words of it, here. Second ones, too.",
        '<p title="a > b" data-x=\'"\' hidden=">">Words of the first part, as they are.</p><p "odd>And more of it.</p>': "Words of the first part, as they are. And more of it.",
        "Plain text without markup, which is all there is.": "Plain text without markup, which is all there is.",
        "<div><div>Some text, which is all there is.</div></div>": "Some text, which is all there is.",
        "<html><body><h1>Head</h1><p class=x'>First part, of a story. </p><p>Second part, of it.</p></body></html>": "Head First part, of a story. Second part, of it.",
        "<body><a href=/>Home</a> | <a href=/n>News</a></body>": "",
        "<body>Some words first, in the body. <p>Then a paragraph, of a few words more, in it.</p></body>": "Some words first, in the body. Then a paragraph, of a few words more, in it.",
        "<article><p>One <b>two <i>three</b> four</i>, as it goes.</p><p>Five.</p></article>": "One two three four, as it goes. Five.",
    }
    assert extract.main_texts(list(pages), extract.default_model()) == list(pages.values())
    long = "<article>" + "<p>A paragraph of words, again and again.</p>" * 20000 + "</article>"
    assert extract.main_texts([long], extract.default_model())[0] == " ".join(["A paragraph of words, again and again."] * 20000)


def test_messages_give_exact_marginals():
    model = extract.default_model()
    forest = extract.Forest([extract.Page(extract.labelled_pages.PAGES[1])])
    n = len(forest.kinds)
    keep = list(range(min(n, 12)))
    sub = extract.Forest([extract.Page("<nav><ul><li><a>x</a></li></ul></nav><article><p>Some words, here.</p><p>More.</p></article><footer>f</footer>")])
    n = len(sub.kinds)
    unary = np.zeros((n, 2))
    unary[:, 1] = sub.features() @ model.weights[:-1] + model.weights[-1]
    unary[0] += model.root
    total = np.zeros((n, 2))
    for mask in range(1 << n):
        y = [mask >> i & 1 for i in range(n)]
        p = np.exp(sum(unary[i, y[i]] + (model.pair[sub.kinds[i], y[sub.parent[i]], y[i]] if sub.parent[i] >= 0 else 0) for i in range(n)))
        for i in range(n):
            total[i, y[i]] += p
    assert np.allclose(model.marginals(sub), total[:, 1] / total.sum(axis=1))
    assert keep


def test_left_out_pages():
    wrong = runs = 0
    pages = extract.labelled_pages.PAGES
    for k in range(len(pages)):
        model = extract.Model.train(pages[:k] + pages[k + 1 :])
        forest = extract.Forest([extract.Page(pages[k], labels=True)])
        guess = model.marginals(forest) > 0.5
        wrong += ((guess != forest.label) & (forest.own > 0)).sum()
        runs += (forest.own > 0).sum()
    assert wrong <= 0.05 * runs


# ------------------------------------------------------------------------ 5 top-k


def test_topk_edges(spark):
    r = np.random.default_rng(1)
    x = [[float(v) for v in row] for row in r.normal(size=(300, 8))]
    x[10:60] = [x[5]] * 50
    rows = [(i, v) for i, v in enumerate(x)] + [(1000, None), (1050, []), (1100, [1.0, None]), (1150, [float("nan")] * 8), (None, x[0]), (0, x[0]), (2000, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, node int")
    got = defaultdict(list)
    for g in topk.search(df, df.where("vec_id % 50 = 0"), page=16, routers=8).orderBy("query_id", "rank").collect():
        got[g.query_id].append((g.rank, g.vec_id, g.score))
    ok = {i: np.floor(256 * np.pad(v, (0, 8 - len(v)))) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all()}
    want = {}
    for q in ok:
        if q % 50 == 0:
            best = sorted((-int(ok[q] @ v), i) for i, v in ok.items() if i != q)[:5]
            want[q] = [(k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert dict(got) == want
    assert topk.search(df.limit(0), df.limit(0)).count() == 0
    assert topk.search(df.where("vec_id = 0"), df.where("vec_id = 0")).count() == 0


def test_large_components_are_exact(spark):
    r = np.random.default_rng(2)
    rows = [(0, [1.0, 0.0]), (1, [1e8, 0.0]), (2, [0.5, 0.0]), (3, [-1e8, 3.0]), (50, [3e5 + 1, 5.0]), (51, [3e5, 5.0]), (52, [3e5 + 1, 5.25])]
    rows += [(100 + i, [float(x) for x in r.normal(size=2) * 10.0 ** r.integers(0, 6)]) for i in range(200)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = defaultdict(list)
    for g in topk.search(df, df.where("vec_id % 50 = 0"), page=16).orderBy("query_id", "rank").collect():
        got[g.query_id].append((g.vec_id, g.score))
    ints = {i: [int(np.floor(256 * x)) for x in v] for i, v in rows}
    for q in ints:
        if q % 50 == 0:
            every = sorted((-sum(a * b for a, b in zip(ints[q], v, strict=True)), i) for i, v in ints.items() if i != q)[:5]
            assert got[q] == [(i, -s) for s, i in every]
    assert got[0][0] == (1, 6553600000000)
    assert got[50][0][1] > 2**53
    short = topk.search(spark.createDataFrame([(7, [1e300]), (8, [1.0])], df.schema), df.where("vec_id = 50")).collect()
    assert [tuple(x) for x in short] == [(50, 1, 8, ints[50][0] * 256)]


def test_vectors_beyond_64_bits(spark):
    rows = [(0, [1.0, 2.0]), (50, [2.0**55, 1.0]), (100, [-(2.0**54), 2.0**54]), (1, [2.0**54, 2.0**54]), (2, [-(2.0**54), 2.0**54]), (3, [1e300, 0.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for x in topk.search(vectors, vectors.where("vec_id % 50 = 0"), k=2).collect():
        got.setdefault(x.query_id, []).append((x.rank, x.vec_id, x.score))
    # what has no 64-bit form takes no part; a score beyond is the largest one
    assert set(got) == {0, 100}
    assert sorted(got[100]) == [(1, 0, 2**63 - 1), (2, 2, 2**63 - 1)]
    assert sorted(got[0]) == [(1, 1, 2**63 - 1), (2, 2, 2**63 - 1)]


# --------------------------------------------------------------------- 6 toxicity


def test_restoration(spark):
    text = "you stupid clown and an idiot said the moron to the loser "
    counts = toxicity.character_counts(docs_of(spark, [(i, text * 20) for i in range(5)]), "text")
    found = toxicity.restore(docs_of(spark, [(1, "St@pid? id1ot, c l o w n m.o.r.o.n looooser 42 it's"), (2, None), (3, "")]).withColumn("restored", F.lit(0)).drop("restored"), counts).orderBy("doc_id").collect()
    assert found[0].restored.split()[1:5] == ["idiot", "clown", "moron", "loser"]
    assert [r.restored for r in found[1:]] == ["", ""]


def test_hidden_words_come_back(spark):
    text = "you are an idiot and that shit is a moron of an ass in the heat of it all "
    counts = toxicity.character_counts(docs_of(spark, [(i, text * 30) for i in range(4)]), "text")
    hidden = ["5h17", "1d10t", "a$$", "m 0 r o n", "y o u i d i o t", "sh!t", "m0r0n", "i-d-i-o-t", "shiiiiit"]
    df = docs_of(spark, list(enumerate(hidden)), extra=False)
    out = {r.text: r.restored for r in toxicity.restore(df, counts).collect()}
    assert out == {"5h17": "shit", "1d10t": "idiot", "a$$": "ass", "m 0 r o n": "moron", "y o u i d i o t": "you idiot", "sh!t": "shit", "m0r0n": "moron", "i-d-i-o-t": "idiot", "shiiiiit": "shit"}
    plain = docs_of(spark, [(1, "a 12 b2 word. (word) 1 2 3 4 ... ?? x!"), (2, "x" * 50000 + "0" * 50000)], extra=False)
    rows = toxicity.restore(plain, counts).orderBy("doc_id").collect()
    assert [w for w in rows[0].restored.split() if w != "cword"] == [w for w in rows[0].text.split() if w != "(word)"]
    assert len(rows[1].restored) <= 100000


def test_readings_are_the_likeliest_of_all():
    r = random.Random(4)
    text = " ".join(r.choice(["stupid", "idiot", "moron", "loser", "fool", "ass", "see", "sail"]) for _ in range(3000)).encode()
    codes, n = np.unique(toxicity._trigrams(np.frombuffer(text, np.uint8), np.array([0, len(text)])), return_counts=True)
    decoder = toxicity.Decoder((codes, n))

    def cost(letters, arcs):
        before, total = 0, arcs
        for x in letters:
            step, before = decoder.step(before, x)
            total += step
        return total + decoder.step(before, " ")[0]

    def readings(token, i, letters, arcs):
        if i == len(token):
            yield cost(letters, arcs), "".join(letters)
            return
        end = next((k for k in range(i, len(token)) if token[k] != token[i]), len(token))
        for j, x, extra in decoder.arcs(token, i, end):
            yield from readings(token, j, [*letters, x] if x else letters, arcs + extra)

    for token in ["st0p1d", "1d10t", "l00ser", "a$$", "m.o.r.0.n", "fooool", "**s", "s@|l", "a\x1f5\x1f5", "€1+"]:
        best = min(readings(token, 0, [], 0.0))
        mine = decoder.read(token)
        assert abs(best[0] - min(c for c, t in readings(token, 0, [], 0.0) if t == mine)) < 1e-6, token


def test_toxicity_of_held_out_labels(spark, sf):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    out = [r for r in registry.queries()["op6_toxicity"](spark, sf).where("held_out").collect() if labels.get(r.doc_id) is not None]
    assert np.mean([r.predicted == labels[r.doc_id] for r in out]) > 0.9


def test_toxicity_learns_and_takes_edges(spark):
    docs = [(i, prose(60, i) + (" stup1d wretch " if i % 3 == 0 else " fine day ")) for i in range(300)] + [(900, None), (901, ""), (None, "wretch"), (902, "a " * 5000)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(300)] + [(None, 1), (5, None)], "doc_id long, toxic int").withColumns({"text": F.lit("x"), "y": F.lit(0), "id": F.lit(1)})
    df = docs_of(spark, docs)
    counts = toxicity.character_counts(df, "text")
    model = toxicity.train(df, labels, counts)
    out = {r.doc_id: r.score for r in toxicity.score(df, model, counts).collect()}
    assert len(out) == len(docs)
    assert all((out[i] >= 0.5) == (i % 3 == 0) for i in range(300))
    assert out[900] == out[901] < 0.5
    empty = toxicity.train(df, labels.limit(0), counts)
    assert {r.score for r in toxicity.score(df, empty, counts).collect()} == {0.5}
    assert toxicity.score(df.limit(0), model, counts).count() == 0


# ---------------------------------------------------------------- 7 sentencepiece

AWKWARD = ["Hello  wörld\n a\t漢字x 😀 ", "", None, " ", "   ", "a", "▁x ▁▁y", "\0a\0", "x" * 3000, "日本語" * 50 + "̀z", "def f(x):\n        return  x  ==  1", "é" * 40]


def library_ids(texts):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=sentencepieces.MODEL)
    return [model.encode(t or "") for t in texts]


def test_pieces_equal_the_library(spark):
    r = random.Random(1)
    letters = "abcdefgthe ingouré  ñ日0123.,\n-=_😀̀\""
    texts = AWKWARD + ["".join(r.choice(letters) for _ in range(r.randint(0, 60))) for _ in range(2000)]
    df = docs_of(spark, list(enumerate(texts)))
    encoded = sentencepieces.encode(df)
    assert encoded.columns == [*df.columns, "input_ids"]
    rows = sentencepieces.decode(encoded).orderBy("doc_id").collect()
    assert [list(x.input_ids) for x in rows] == library_ids(texts)
    assert [x.decoded for x in rows] == [(t or "").replace("▁", " ") for t in texts]
    assert sentencepieces.encode(df.limit(0)).count() == 0


def test_long_words_and_forgetting(spark):
    r = random.Random(3)
    texts = ["".join(r.choice("abcdefghijklmnopqrstuvwxyzé日") for _ in range(n)) for n in (600, 5000, 30000)] + ["ab" * 40000, "x" * 60000]
    vocabulary = sentencepieces.Vocabulary(sentencepieces.MODEL)
    encoder = sentencepieces.Encoder(vocabulary)
    data, offsets = text_bytes(pa.array(texts))
    want = library_ids(texts)
    for _ in range(2):
        ids, bounds = encoder.encode(data, offsets)
        assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:], strict=False)] == want
    encoder.known_check[:] = 1  # as if other words had the same hashes
    ids, bounds = encoder.encode(data, offsets)
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:], strict=False)] == want
    assert encoder.salt == 1


def test_blocks_of_the_encoder(monkeypatch):
    """Words and parts of long words that are matched in many blocks, multi-byte characters across their ends."""
    monkeypatch.setattr(sentencepieces, "BLOCK", 101)
    r = random.Random(5)
    texts = ["".join(r.choice("abcdeé日😀") for _ in range(n)) for n in (300, 700, 1500)] + ["the " * 200, " ".join(str(i * 7919) for i in range(300)), "", "inter" * 300]
    data, offsets = text_bytes(pa.array(texts))
    ids, bounds = sentencepieces.Encoder(sentencepieces.Vocabulary(sentencepieces.MODEL)).encode(data, offsets)
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:], strict=False)] == library_ids(texts)


def test_pieces_query(spark, sf):
    out = {r.doc_id: r for r in registry.queries()["op7_sentencepiece"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    for d, ids in zip(docs, library_ids([d.text for d in docs]), strict=True):
        assert out[d.doc_id].n_pieces == len(ids)
        assert out[d.doc_id].ids_sha256 == hashlib.sha256(np.array(ids, dtype="<i4").tobytes()).hexdigest()
        assert out[d.doc_id].round_trip


# -------------------------------------------------------------------- 8 near dedup


def brute_near(docs, k, share):
    sets = {}
    for i, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(FOLDING))
        sets[i] = frozenset(tuple(w[j : j + k]) for j in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])
    top = {i: i for i in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i in sets:
        for j in sets:
            if j < i and sets[i] and 100 * len(sets[i] & sets[j]) >= share * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                top[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in sets}


def edited(words, n, seed):
    r = random.Random(seed)
    out = list(words)
    for _ in range(n):
        out[r.randrange(len(out))] = f"e{r.randrange(10**6)}"
    return " ".join(out)


@pytest.mark.parametrize(("k", "share"), [(3, 85), (5, 80)])
def test_near_duplicates(spark, k, share):
    base = prose(150, 1).split()
    docs = [(i, edited(base, i % 12, i)) for i in range(120)] + [(200 + i, prose(60, i + 50)) for i in range(30)] + [(300, None), (301, ""), (302, "hi"), (303, "Hi"), (304, "hi there"), (305, " \t\n")]
    for few in (near_dedup.FEW, 0):
        out = near_dedup.near_duplicates(docs_of(spark, docs), k=k, share=share, few=few)
        assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in out.collect()} == brute_near(docs, k, share)


def test_prefix_filtering_loses_no_link(spark):
    r = random.Random(9)
    sets = {}
    for i in range(60):
        old = sets[r.choice(list(sets))] if sets and r.random() < 0.7 else None
        sets[i] = frozenset(r.sample(sorted(old), int(len(old) * r.uniform(0.85, 1)))) | {r.randrange(400) for _ in range(r.randrange(4))} if old else frozenset(r.sample(range(400), r.randrange(1, 60)))
    nodes = spark.createDataFrame([(i, i) for i in sets], "node long, comp long")
    maps = near_dedup.bitmaps(np.array([x for s in sets.values() for x in sorted(s)], np.uint64), np.concatenate([[0], np.cumsum([len(s) for s in sets.values()])]))
    held = spark.createDataFrame([(i, len(s), sorted(s), m) for (i, s), m in zip(sets.items(), maps.tolist(), strict=True)], "node long, n long, s array<long>, bits array<long>")
    found = {(p.a, p.b) for p in near_dedup._by_prefix(nodes, held, 85).distinct().collect()}
    links = {(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])}
    assert links and links <= found
    assert len(found) < 4 * len(links)
    assert {(p.a, p.b) for p in near_dedup._verified(spark.createDataFrame(list(found), "a long, b long"), held, 85).collect()} == links


def test_row_keys_tell_nulls_apart(spark):
    df = spark.createDataFrame([("t", None), (None, "t"), (None, None), ("t", "t")], "a string, b string")
    assert df.select(row_key("a", "b").alias("k")).distinct().count() == 4


def test_near_dedup_rows(spark):
    base = prose(60, 2)
    df = docs_of(spark, [(1, base), (2, base), (2, base), (3, None), (4, ""), (4, ""), (5, "hi"), (5, "hi"), (6, "hi"), (7, "other words"), (None, base)])
    kept = sorted(r.doc_id for r in near_dedup.deduplicate(df).collect())
    assert kept == [1, 3, 4, 4, 5, 7]
    assert near_dedup.deduplicate(df.limit(0)).count() == 0
    assert near_dedup.deduplicate(df).columns == df.columns


def test_groups_without_ids_keep_one(spark):
    base = prose(60, 2)
    rows = [(None, base), (None, base + " end"), (None, "alone in its group"), (None, "alone in its group"), (None, None), (7, prose(50, 3)), (None, prose(50, 3))]
    kept = [(r.doc_id, r.text) for r in near_dedup.deduplicate(docs_of(spark, rows)).collect()]
    assert len(kept) == 4
    assert {(None, "alone in its group"), (None, None), (7, prose(50, 3))} < set(kept)
    assert sum(i is None and (t or "").startswith(base) for i, t in kept) == 1


def test_sketches_fill_and_estimate():
    r = np.random.default_rng(1)
    common, a, b = (r.integers(1, 1 << 52, n, dtype=np.uint64) for n in (800, 100, 100))
    sets = [np.concatenate([common, a]), np.concatenate([common, b]), common[:1], common[:0]]
    s = near_dedup.sketches(np.concatenate(sets), np.concatenate([[0], np.cumsum([len(x) for x in sets])]))
    assert s.shape == (3, near_dedup.SIZE)
    assert (s != 0).all()
    assert abs((s[0] == s[1]).mean() - 0.8) < 0.12


# ---------------------------------------------------------------------- 9 language


def test_language(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    out = registry.queries()["op9_language"](spark, sf).where("held_out").collect()
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in out]) > 0.93
    model = language.train(docs.select("text", "lang"))
    edge = language.identify(docs_of(spark, [(1, None), (2, ""), (3, "12 !?"), (None, "der die das und ist"), (4, "ß"), (5, "x" * 100000)]), model).collect()
    assert [r.lang_pred for r in edge[:3]] == ["und"] * 3
    assert [r.score for r in edge[:3]] == [0.0] * 3
    assert all(0 <= r.score <= 1 for r in edge)
    assert language.train(docs.select("text", "lang").limit(0)) is None
    assert {r.lang_pred for r in language.identify(docs_of(spark, [(1, "words")]), None).collect()} == {"und"}


def test_codewords_are_apart():
    for n in (2, 4, 6, 9):
        code = language.codewords(n)
        assert len({tuple(c) for c in code.tolist()}) == n
    assert min((language.codewords(9)[i] != language.codewords(9)[j]).sum() for i in range(9) for j in range(i)) >= 5


def test_decoding_by_all_codewords():
    r = np.random.default_rng(6)
    for n in (3, 5, 8):
        table = r.integers(0, 50, size=(n, language.BUCKETS)).astype(float)
        model = language.Model([f"l{i}" for i in range(n)], table)
        h = np.concatenate([table[:2] + r.integers(0, 20, size=(2, language.BUCKETS)), r.integers(0, 5, size=(4, language.BUCKETS))]).astype(np.float32)
        p = [[(x + 0.5) / (sum(row) + 0.5 * len(row)) for x in row] for row in table.tolist()]
        best, score, unsure = model.decode(h)
        for k in range(len(h)):
            total, costs = float(h[k].sum()), []
            bits = []
            for b in range(model.code.shape[1]):
                groups = [[p[i] for i in range(n) if model.code[i][b] == s] for s in (1, -1)]
                one, zero = (np.mean(g, axis=0) for g in groups)
                w = np.log(one) - np.log(zero)
                scale = float(((one - zero) * w).sum() / 2)
                bits.append((float((h[k] * (w - ((one + zero) / 2 * w).sum())).sum()) / total / scale, scale))
            for word in model.code:
                costs.append(sum(s * np.exp(-np.clip(m, -3, 3) * c) for (m, s), c in zip(bits, word, strict=True)) / sum(s for _, s in bits))
            likely = np.exp(-language.SHARPNESS * (np.array(costs) - min(costs)))
            likely /= likely.sum()
            top = np.sort(likely)[::-1]
            assert abs(score[k] - top[0]) < 1e-3
            assert top[0] - top[1] < 1e-3 or best[k] == int(likely.argmax())
            assert abs(top[0] - top[1] - language.AMBIGUOUS) < 2e-3 or unsure[k] == (top[0] - top[1] < language.AMBIGUOUS)


def test_all_languages_are_learned(spark, monkeypatch):
    monkeypatch.setattr(language, "TOGETHER", 100)
    r = random.Random(6)
    own = {f"l{i}": "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(12)) for i in range(410)}
    df = spark.createDataFrame([(i, " ".join(r.choice(w) + w[r.randrange(9) :] for _ in range(40)), n) for i, (n, w) in enumerate(own.items())], "doc_id long, text string, lang string")
    model = language.train(df)
    assert sorted(model.languages) == sorted(own)
    told = {x.doc_id: x.lang_pred for x in language.identify(df, model).collect()}
    assert sum(told[i] == n for i, n in enumerate(own)) > 0.9 * len(own)
    # in parts the sums are the same
    table = np.random.default_rng(1).integers(0, 50, (7, language.BUCKETS))
    names = [f"l{i}" for i in range(7)]
    whole, parts = language.Model(names, table), language.Model(names, iter([table[:3], table[3:]]))
    assert np.allclose(whole.weights, parts.weights) and np.allclose(whole.scale, parts.scale)


def test_rare_languages_are_learned_too(spark):
    df = spark.createDataFrame([(i, "der und die das" if i % 3 else "the and of to", "de" if i % 3 else "en", 1) for i in range(30)] + [(99, "zz", "rare", 1)], "doc_id long, text string, lang string, bucket int")
    assert language.train(df).languages == sorted({r.lang for r in df.where("lang is not null and text is not null").collect()})
    assert {r.lang_pred for r in language.identify(df.where("doc_id = 0"), language.train(df)).collect()} == {"en"}


# ---------------------------------------------------------------------- 10 quality


def test_quality(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    kept = {r.doc_id for r in quality.accepted(docs, labels).collect()}
    truth = {r.doc_id: r.quality for r in labels.collect()}
    assert np.mean([(d in kept) == bool(q) for d, q in truth.items()]) > 0.95
    assert quality.accepted(docs, labels).columns == docs.columns
    assert quality.accepted(docs, labels.limit(0)).count() == docs.count()
    odd = spark.createDataFrame([(1, None, None, None), (2, "", "s", "p"), (2, "", "s", "p"), (3, "### " * 2000, "s", None)], "doc_id long, text string, source string, lang string")
    assert quality.score(odd, labels).count() == 4
    assert quality.accepted(odd.limit(0), labels).count() == 0


def test_quality_of_held_out_labels(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 0
    scored = quality.score(docs, labels.where(~out).withColumns({"text": F.lit("x"), "lang": F.lit("y")}), keep_text=False)
    truth = {r.doc_id: r.quality for r in labels.where(out).collect()}
    got = {r.doc_id: r["__posterior"] >= 0.5 for r in scored.select("doc_id", "__posterior").collect()}
    assert np.mean([got[d] == bool(q) for d, q in truth.items()]) > 0.93


def test_posteriors_by_plain_arithmetic(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    rows = [r.asDict() for r in quality.score(docs, labels, keep_text=False).select("source", "lang", "__p", "__logit", "__site", "__posterior").collect()]
    again = [r.asDict() for r in quality.score(docs, labels).select("__site", "__posterior").collect()]
    assert np.allclose(sorted(r["__posterior"] for r in rows), sorted(r["__posterior"] for r in again))
    hosts, paths = defaultdict(list), defaultdict(list)
    for r in rows:
        hosts[r["source"]].append(r["__p"])
        paths[r["source"], r["lang"]].append(r["__p"])
    total = [r["__p"] for r in rows]
    rate = sum(total) / len(total)

    def strength(groups, parent):
        n = sum(map(len, groups.values()))
        spread = sum(len(g) * (sum(g) / len(g) - parent(k)) ** 2 for k, g in groups.items()) / n
        between = spread - rate * (1 - rate) * len(groups) / n
        return min(max(rate * (1 - rate) / between - 1, 2.0), 1e4) if between > 0 else 1e4

    by_host = strength(hosts, lambda k: rate)
    mean = lambda h, less=0.0, n=0: (sum(hosts[h]) - less + by_host * rate) / (len(hosts[h]) - n + by_host)
    by_path = strength(paths, lambda k: mean(k[0]))
    trained = np.mean([r.quality for r in labels.where("quality is not null").collect()])
    for r in rows[:200]:
        p, own = r["__p"], paths[r["source"], r["lang"]]
        site = (sum(own) - p + by_path * mean(r["source"], p, 1)) / (len(own) - 1 + by_path)
        z = r["__logit"] - np.log(trained / (1 - trained)) + np.log(site / (1 - site))
        assert abs(site - r["__site"]) < 1e-6
        assert abs(1 / (1 + np.exp(-z)) - r["__posterior"]) < 1e-6


def test_sparse_sites_shrink(spark):
    rows = [("a", "x", 0.9)] * 200 + [("b", "x", 0.1)] * 200 + [("c", "x", 0.1)]
    sites, rate, by_host, by_path = quality.site_priors(spark.createDataFrame(rows, "h string, p string, __p double"), "h", "p")
    means = {r.h: (r.host_s + by_host * rate) / (r.host_n + by_host) for r in sites.collect()}
    assert means["a"] > 0.85
    assert means["b"] < 0.15
    assert means["b"] < means["c"] < rate
    host, path = quality.site_of("u")
    assert tuple(spark.createDataFrame([("https://A.example:80/en/x?y",)], "u string").select(host, path).first()) == ("a.example", "en")


# -------------------------------------------------------------------- registered SQL


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_registered_sql(spark, sf, name):
    assert same(spark, sf, registry.queries()[name], registry.oracle_sql()[name])


def test_sentencepiece_pairs_walk_through_their_states_as_merging_does(monkeypatch):
    v = sentencepieces.Vocabulary(sentencepieces.MODEL)
    rng = np.random.default_rng(3)
    edges = np.array(v.edges)
    short = edges[np.array([len(v.pieces[i]) <= 3 for i in v.edges])]
    a = np.concatenate([rng.choice(edges, 6000), rng.choice(short, 6000), rng.choice(short, 3000)])
    b = np.concatenate([rng.choice(edges, 6000), rng.choice(short, 6000), rng.choice(edges, 3000)])
    wanted = [v.merge(v.pieces[x] + v.pieces[y]) == [v.pieces[x], v.pieces[y]] for x, y in zip(a, b, strict=True)]
    assert v.stand(a, b).tolist() == wanted and 0 < sum(wanted) < len(wanted)
    # Pairs that share a place of a small memory push each other out and stay right.
    monkeypatch.setattr(sentencepieces, "MOST_PAIRS", 8)
    e = sentencepieces.Encoder(v)
    assert e.compatible(a[:500], b[:500]).tolist() == wanted[:500] == e.compatible(a[:500], b[:500]).tolist()
    # No pair of a short word is merged by itself.
    monkeypatch.setattr(v, "merge", None)
    raw = np.frombuffer("words of ordinary length, naïve façade 汉字".encode(), np.uint8)
    ids, _ = e.encode(raw, np.array([0, len(raw)]))
    import sentencepiece

    assert ids.tolist() == sentencepiece.SentencePieceProcessor(model_file=sentencepieces.MODEL).encode(raw.tobytes().decode())


def test_seeds_count_at_all_places_of_both_documents(spark):
    """An edited passage whose runs stand scattered in both documents before the passage itself."""
    p = prose(100, 91).split()
    one = [w if i % 15 != 7 else f"x{i}" for i, w in enumerate(p)]
    runs = lambda n: " ".join(" ".join(p[i : i + 14]) + " " + prose(60, n + i) for i in range(86, -1, -2))
    docs = docs_of(spark, [(1, f"{runs(2000)} {' '.join(p)} {prose(20, 94)}"), (2, f"{runs(3000)} {' '.join(one)} {prose(20, 95)}")], extra=False)
    found = substring_dedup.passages(docs).collect()
    assert any(r.after - r.first >= 90 and r.matched >= 0.9 * (r.after - r.first) for r in found)


def test_fragments_of_all_places_made_in_parts():
    r = np.random.default_rng(4)
    for n in (0, 3, 60):
        pos, o_pos = np.arange(n) * 2, np.arange(n + 9) * 2
        seeds, o_seeds = r.integers(0, 3, n), r.integers(0, 3, n + 9)
        i, j = np.nonzero(seeds[:, None] == o_seeds[None, :])
        wanted = sorted(zip(*(x.tolist() for x in substring_dedup.fragments(pos[i], o_pos[j])), strict=True)) if len(i) else []
        for most in (5, 100, 1 << 20):
            assert sorted(zip(*(x.tolist() for x in substring_dedup.all_fragments(pos, seeds, o_pos, o_seeds, most)), strict=True)) == wanted


def test_shuffle_files_of_a_checkpoint_go_with_it(spark):
    from rivulet.llm import _common

    before = spark.conf.get(_common.CLEANUP, None)
    df = spark.range(1000).repartition(3, "id").groupBy((F.col("id") % 7).alias("k")).count()
    out = _common.materialize(df)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, df.collect())) and spark.conf.get(_common.CLEANUP, None) == before


def test_passages_of_texts_that_repeat_themselves_lie_in_no_other_of_the_pair(spark):
    """Every place of a repeated line is in a passage, and chains between its many equal places give no row each."""
    line, other = prose(26, 41), prose(4, 42)
    docs = [(1, " ".join([line, other] * 20)), (2, " ".join(f"{line} {prose(3, 4300 + i)}" for i in range(15)))]
    found = substring_dedup.passages(docs_of(spark, docs, extra=False)).collect()
    assert sum(r.after - r.first for r in found) >= 400
    spans = sorted((r.first, r.after) for r in found)
    assert all(a < b and x < y for (a, x), (b, y) in zip(spans, spans[1:], strict=False))


def test_ends_of_possible_passages_lose_none():
    """Two texts of few words, one made of the other by edits: each span that agrees as a passage must is within the bounds."""

    def common(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            last = row[:]
            for j, y in enumerate(b):
                row[j + 1] = max(last[j + 1], row[j], last[j] + (x == y))
        return row[-1]

    r, seen = random.Random(9), 0
    for _ in range(60):
        b = [r.randrange(6) for _ in range(r.randrange(8, 22))]
        a = [r.randrange(6, 40) for _ in range(r.randrange(6))] + [x if r.random() > 0.1 else r.randrange(40) for x in b if r.random() > 0.06] + [r.randrange(6, 40) for _ in range(6)]
        ends = substring_dedup.passage_ends(np.array(a, np.int32), np.array(b, np.int32), 8, 0.8)
        for s in range(len(a)):
            for e in range(s + 8, len(a) + 1):
                if any(common(a[s:e], b[o:p]) >= 0.8 * max(e - s, p - o) for o in range(len(b)) for p in range(o + 6, min(len(b), o + 2 * (e - s)) + 1) if p - o <= 1.25 * (e - s)):
                    seen += 1
                    assert ends[s] >= e
    assert seen > 50
    assert (substring_dedup.passage_ends(np.arange(90, dtype=np.int32), np.arange(30, 60, dtype=np.int32), 50, 0.8) == -1).all()


def test_links_that_the_same_documents_hold_make_their_pairs_once(spark):
    there = [(l, o) for l in range(6) for o in range(20)] + [(9, 3), (9, 50), (11, 50)]
    left = [(l, k) for l in (*range(6), 9) for k in range(20) if l < 9 or k == 3] + [(9, 50), (11, 50)]
    pairs = {(k, o) for l, k in left for m, o in there if l == m and o < k}
    left, there = (spark.createDataFrame(rows, schema) for rows, schema in ((left, "l long, key long"), (there, "l long, other long")))
    met = substring_dedup._one_of_alike(left, there).join(there, "l").where("other < key").select("key", "other").collect()
    assert len(met) == len(pairs) and {tuple(r) for r in met} == pairs


def rows_made(spark, act):
    """The most rows that a join, a generator or Python made in the queries that ``act`` runs."""
    store = spark._jsparkSession.sharedState().statusStore()
    listed = lambda x: [x.apply(i) for i in range(x.size())]
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    before = {e.executionId() for e in listed(store.executionsList())}
    act()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    most = {}
    for k in {e.executionId() for e in listed(store.executionsList())} - before:
        values = store.executionMetrics(k)
        for node in listed(store.planGraph(k).allNodes().toSeq()):
            if re.search("Join|Generate|Arrow", node.name()):
                for m in listed(node.metrics().toSeq()):
                    if m.name() == "number of output rows" and values.contains(m.accumulatorId()):
                        most[node.name()] = max(most.get(node.name(), 0), int(values.apply(m.accumulatorId()).replace(",", "")))
    return most


def test_documents_of_a_crowd_make_no_row_a_pair(spark):
    """500 documents share a line of 30 words and no passage, two of them an edited one."""
    line, p = prose(30, 51), prose(60, 52).split()
    texts = [f"{prose(20, 5200 + i)} {line} {prose(20, 6200 + i)}" for i in range(500)]
    texts += [f"{prose(20, 7200 + i)} {line} {' '.join(w if j % 19 != 6 * i + 3 else f'x{j}' for j, w in enumerate(p))} {prose(20, 7300 + i)}" for i in range(2)]
    docs, found = docs_of(spark, list(enumerate(texts)), extra=False), []
    most = rows_made(spark, lambda: found.extend(substring_dedup.passages(docs).collect()))
    assert {frozenset((r.key, r.other)) for r in found} == {frozenset(r.key for r in docs.where("doc_id >= 500").select(row_key("doc_id", "text").alias("key")).collect())}
    assert most and max(most.values()) <= 40 * len(texts)


def test_passages_do_not_depend_on_blocks(spark, monkeypatch):
    """Documents of three lines each, of which some are edited copies, in blocks of a few and all in one."""
    r = random.Random(3)
    lines = [prose(16, 800 + i) for i in range(5)]
    own = [prose(45, 820 + i).split() for i in range(4)]
    texts = [" ".join([prose(10, 900 + i), *r.sample(lines, 3), " ".join(w if r.random() > 0.05 else f"x{i}" for w in own[i % 4]), *r.sample(lines, 2), prose(10, 990 + i)]) for i in range(40)]
    docs, found = docs_of(spark, list(enumerate(texts)), extra=False), []
    for askers, holders, table in ((256, 1024, 1 << 23), (3, 5, 256)):
        for name, value in (("ASKERS", askers), ("HOLDERS", holders), ("TABLE", table)):
            monkeypatch.setattr(substring_dedup, name, value)
        found.append(sorted(map(tuple, substring_dedup.passages(docs).collect())))
    assert found[0] == found[1] and len(found[0]) > 40


def test_agreement_by_words_is_that_of_passage_ends():
    r = np.random.default_rng(6)
    for n in (30, 50, 51, 200):
        own = np.arange(n, dtype=np.int32)
        others = [r.choice(n, int(n * share), replace=False).astype(np.int32) for share in r.uniform(0.5, 1, 60)]
        hit = np.array([np.isin(own, o) for o in others])
        total = np.concatenate([np.zeros((60, 1)), np.cumsum(hit - 0.8, axis=1)], axis=1)
        wanted = [any(t[j] - t[i] >= -1e-6 for i in range(n) for j in range(i + 50, n + 1)) for t in total]
        assert substring_dedup._agree(hit, 50, 0.8).tolist() == wanted


def test_topk_of_many_pages_and_buckets(spark, monkeypatch):
    """Vectors of 2, 4 and 8 bytes a component, all scores of some queries negative, in small pages, buckets and blocks."""
    r = np.random.default_rng(12)
    x = np.concatenate([-np.abs(r.normal(size=(500, 6))), r.normal(size=(60, 6)) * 300, r.normal(size=(5, 6)) * 1e8])
    x[::50] = np.abs(x[::50]) / 1e3
    df = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    ints = [[int(c) for c in row] for row in np.floor(256 * x)]
    want = {}
    for q in range(0, len(x), 50):
        every = sorted((-sum(a * b for a, b in zip(ints[q], v, strict=True)), i) for i, v in enumerate(ints) if i != q)
        want[q] = [(i, -s) for s, i in every[:5]]
    monkeypatch.setattr(topk, "BLOCK", 3)
    for bucket in (16, 1 << 15):
        monkeypatch.setattr(topk, "BUCKET", bucket)
        got = defaultdict(list)
        for g in topk.search(df, df.where("vec_id % 50 = 0"), page=8, routers=4).orderBy("query_id", "rank").collect():
            got[g.query_id].append((g.vec_id, g.score))
        assert dict(got) == want


def test_a_page_is_no_row_of_each_block_of_queries(spark, monkeypatch):
    r = np.random.default_rng(13)
    x = r.normal(size=(1500, 4))
    df = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    monkeypatch.setattr(topk, "BLOCK", 4)
    sizes = []
    most = rows_made(spark, lambda: sizes.append(topk.search(df, df, page=64, routers=16).count()))
    assert sizes == [7500] and max(n for name, n in most.items() if "Join" in name) <= 3000

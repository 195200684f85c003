"""Conversation repair (operator 12) against all repairs by enumeration, its SQL and its edge cases."""

import hashlib
import random
import re
import zlib
from functools import cache

import pytest

from oracle import same
from rivulet.llm import conversations

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    """Faults, cost, edits and repaired lines of one conversation, rows (turn, role, text) in order, by all edits."""
    seen, faults = set(), []
    for _, role, text in rows:
        body = text.rstrip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))

    @cache
    def best(i, state):
        """(cost, edits, lines) from row i on; state: the last initial, or nothing."""
        ways = []
        nexts = {"": "u", "s": "u", "u": "a", "a": "u"}
        if i == len(rows) and state in ("", "a"):
            ways.append((0, "", ()))
        for added in (1, 2):  # more insertions only repeat the state
            role = nexts[state]
            roles = [role, nexts[role]][:added]
            tail = roll(i, roles[-1])
            ways.append((5 * added + tail[0], "I" * added + tail[1], tuple(f"{'user' if x == 'u' else 'assistant'}:" for x in roles) + tail[2]))
        own = roll(i, state)
        ways.append(own)
        return min(w for w in ways if w[0] < 10**6) if any(w[0] < 10**6 for w in ways) else (10**6, "", ())

    @cache
    def roll(i, state):
        """The same without an insertion before row i."""
        if i == len(rows):
            return (0, "", ()) if state in ("", "a") else (10**6, "", ())
        _, role, text = rows[i]
        late = best(i + 1, state)
        ways = [(2 + late[0], "D" + late[1], late[2])]
        if faults[i] not in ("blank", "duplicate"):
            extra = 5 if faults[i] == "truncated" else 0
            for cost, letter, name in ((0, "K", role), (1, "R", "user"), (1, "R", "assistant")):
                first = name[:1]
                if (first == "s" and state == "") or (first == "u" and state != "u") or (first == "a" and state == "u"):
                    late = best(i + 1, first)
                    ways.append((cost + extra + late[0], letter + late[1], (f"{name}:{text}", *late[2])))
        return min(ways)

    cost, edits, lines = best(0, "")
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:], strict=False)]
    turns = [t for t, _, _ in rows if t is not None]
    return {
        "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        **{k: faults.count(k) for k in ("blank", "duplicate", "truncated")},
        "illegal": sum(p not in ("su", "ua", "au") for p in pairs),
        "cost": cost,
        "audit": edits,
        "repaired": list(lines),
    }


def ordered(rows):
    return sorted(((t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


def check(found, by_id):
    got = {r.conv_id: r.asDict() for r in found.collect()}
    assert set(got) == set(by_id)
    for i, rows in by_id.items():
        want = brute(ordered(rows))
        own = got[i] | {"repaired": [f"{t.role}:{t.text}" for t in got[i]["repaired"]]}
        own.pop("conv_id")
        assert own == want, rows
        assert re.fullmatch("(s?(ua)+)?", "".join(t[:1] for t in own["repaired"]))


def random_conversations(seed, n, longest):
    r = random.Random(seed)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None]
    texts = ["Yes.", "No!", "Why?", "cut off", "", " \t\n", None, "end. ", "Fine.", "é?", "."]
    return {i: [(r.choice([*range(9), None]) if r.random() < 0.3 else k, r.choice(roles), r.choice(texts) if r.random() < 0.6 else f"Text {i} {k}.") for k in range(r.randrange(1, longest))] for i in range(n)}


def frame(spark, by_id):
    rows = [(i, *r) for i, own in by_id.items() for r in own]
    random.Random(5).shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA)


def test_repairs_are_the_cheapest(spark):
    by_id = random_conversations(1, 300, 12)
    by_id[None] = [(0, "user", "A."), (1, "user", "A."), (1, "assistant", "B.")]
    check(conversations.repair(frame(spark, by_id)), by_id)


@pytest.mark.parametrize("block", [1, 2, 5])
def test_blocks_give_the_same(spark, block):
    by_id = random_conversations(2, 80, 14)
    check(conversations.repair(frame(spark, by_id), block=block), by_id)


def test_long_conversation(spark):
    rows = [(1, k, "user" if k % 2 == 0 else "assistant", f"Turn {k}.") for k in range(6000)]
    rows[2999] = (1, 2999, "user", "Turn 2999.")
    got = conversations.repair(spark.createDataFrame(rows, SCHEMA)).collect()[0]
    assert (got.cost, got.audit) == (1, "K" * 2999 + "R" + "K" * 3000) and len(got.repaired) == 6000


def test_damage_and_digest(spark):
    r = random.Random(9)
    rows = [(i, k, r.choice(["user", "assistant", "system", None]), r.choice(["One. Two!", "Three?", None, "four"])) for i in range(120) for k in range(r.randrange(1, 6))]
    rows += [(500, None, "user", "Null turn."), (501, None, None, None)]
    rows.append((next(i for i in range(1000, 2000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0), 0, "user", "Dropped."))
    by_id = {i: [] for i, *_ in rows}
    for i, turn, role, text in rows:
        kind = zlib.crc32(f"{i}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        by_id[i] += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    assert any(not own for own in by_id.values()) and {0, 1, 2, 3, 4} <= {zlib.crc32(f"{i}:{t}".encode()) % 20 for i, t, *_ in rows}
    damaged = conversations.damaged(spark.createDataFrame([(*x, True, "z") for x in rows], SCHEMA + ", dropped boolean, place string"))
    check(conversations.repair(damaged), by_id)


def test_query(spark, sf, tmp_path):
    assert same(spark, sf, conversations.query, conversations.ORACLE_SQL)
    rows = [(7, 0, "user", "Hi."), (7, 1, "assistant", "Yes."), (8, None, None, None)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    assert same(spark, str(tmp_path), conversations.query, conversations.ORACLE_SQL)
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/none/conversations.parquet")
    assert conversations.query(spark, f"{tmp_path}/none").count() == 0


def test_empty_conversation_has_the_empty_digest(spark, tmp_path):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    spark.createDataFrame([(gone, 0, "user", "Hi.")], SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    row = conversations.query(spark, str(tmp_path)).collect()[0]
    assert (row.gaps, row.blank, row.duplicate, row.truncated, row.illegal, row.cost, row.audit) == (0, 0, 0, 0, 0, 0, "")
    assert row.repaired_sha256 == hashlib.sha256(b"").hexdigest()


def test_no_python_in_the_plan(spark, sf):
    plan = conversations.query(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange hashpartitioning") == 1

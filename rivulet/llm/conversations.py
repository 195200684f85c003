"""Repair of the turn structure of conversations (operator 12).

A conversation is right if the initials of its roles read ``(s?(ua)+)?``: nothing, or a system turn and pairs
of user and assistant turns. Windows over the conversation give each turn its fault: blank (nothing but white
space), duplicate (role and text seen earlier) or truncated (no full stop, exclamation or question mark at the
end). The turns are collected in order and folded by ``aggregate()``, all in Spark's own expressions: the
fold carries four structs (cost, edits), one for each state: nothing yet, after system, after user, after
assistant. Each step first lets turns be inserted, then keeps, reroles or deletes the turn;
``least`` takes the cheaper struct, and among equal costs the edits that come first in ASCII.

That is exact: of two ways to the same state of equal cost neither's edits are the beginning of the other's (only
insertions could follow, and they cost), so what comes later never changes their order.

An edit is one letter: D delete, I and J insert user and assistant, K keep, R and S rerole to user and assistant;
the role of an insertion or rerole follows from the state, so these letters sort as the initials D, I, K, R do.

Long conversations are folded in blocks of ``BLOCK`` turns from each of the four states, and blocks are joined by the
same rule, so that letters are not copied for each turn anew. Texts of turns that must go are not
collected. One shuffle by conversation serves the windows and the collecting; a conversation is one row in the end,
whose repaired text must be hashed as a whole, so a conversation has to fit a row (2 GB of text that stays).

Defined results: null roles and texts are one space (so a null text is blank); null turns come first and leave no
gap; rows of equal turn are ordered by role and text; equal rows are duplicates; rows with a null id are one
conversation; a conversation of no turns at all has zeros and is empty; no rows give no rows; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Costs of the edits; an undeleted truncated turn costs ``TRUNCATED`` more.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
BLOCK = 512
_FAR = 1 << 40
_SPACE = " \t\n\x0b\x0c\r"
_STATES = ["nothing", "system", "user", "assistant"]


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _way(cost, edits) -> Column:
    return F.struct(cost.cast("bigint").alias("cost"), edits.cast("string").alias("edits"))


def _then(way: Column, cost, edit) -> Column:
    return _way(way["cost"] + cost, F.concat(way["edits"], edit))


def _states(*ways: Column) -> Column:
    return F.struct(*[w.alias(name) for name, w in zip(_STATES, ways, strict=True)])


def _start(state: int) -> Column:
    return _states(*[_way(F.lit(0 if i == state else _FAR), F.lit("")) for i in range(4)])


def _inserted(x: Column) -> Column:
    """States after any insertions that pay: a user turn, an assistant turn, or both."""
    five = F.lit(INSERT)
    user = F.least(x["user"], *[_then(x[s], five, F.lit("I")) for s in ("nothing", "system", "assistant")])
    return _let(user, lambda u: _states(x["nothing"], x["system"], u, F.least(x["assistant"], _then(u, five, F.lit("J")))))


def _turn(before: Column, turn: Column) -> Column:
    """States after a turn."""
    extra = F.when(turn["fault"] == 3, F.lit(TRUNCATED)).otherwise(F.lit(0))

    def after(x: Column) -> Column:
        gone = [_then(x[s], F.lit(DELETE), F.lit("D")) for s in _STATES]
        open_ = F.least(x["nothing"], x["system"], x["assistant"])
        system = _then(x["nothing"], extra, F.lit("K"))
        stays = [turn["initial"] == "u", turn["initial"] == "a"]
        user, assistant = (_then(w, extra + F.when(k, F.lit(0)).otherwise(F.lit(REROLE)), F.when(k, F.lit("K")).otherwise(F.lit(letter))) for w, k, letter in zip([open_, x["user"]], stays, "RS", strict=True))
        kept = _states(gone[0], F.when(turn["initial"] == "s", F.least(gone[1], system)).otherwise(gone[1]), F.least(gone[2], user), F.least(gone[3], assistant))
        return F.when(turn["fault"].isin(1, 2), _states(*gone)).otherwise(kept)

    return _let(_inserted(before), after)


def _joined(before: Column, block: Column) -> Column:
    """States after a block, whose states from each of the four are ``block``."""
    ways = [[_then(before[s], block[i][e]["cost"], block[i][e]["edits"]) for i, s in enumerate(_STATES)] for e in _STATES]
    return _states(*[reduce(F.least, w) for w in ways])


def cheapest(turns: Column, block: int = BLOCK) -> Column:
    """struct(cost, edits) of the cheapest repair of an array of struct(initial, fault)."""

    def fold(part: Column, start: Column) -> Column:
        return F.aggregate(part, start, _turn)

    def blocks() -> Column:
        places = F.sequence(F.lit(block + 1), F.size(turns), F.lit(block))
        tables = F.transform(places, lambda at: _let(F.slice(turns, at, F.lit(block)), lambda part: F.array(*[fold(part, _start(s)) for s in range(4)])))
        return F.aggregate(tables, fold(F.slice(turns, 1, block), _start(0)), _joined)

    last = F.when(F.size(turns) <= block, fold(turns, _start(0))).otherwise(blocks())
    return _let(_let(last, _inserted), lambda x: F.least(x["nothing"], x["assistant"]))


def damaged(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, turn, role, text and dropped, with faults put in by CRC-32 of ``conv_id:turn`` modulo 20: 0 drops
    the turn (a row that says so stays), 1 empties it, 2 takes its ``.!?``, 3 repeats it, 4 makes it the user's."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", part(conv_id), part(turn)).cast("binary")) % 20
    marked = rows.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), part(role).alias("role"), part(text).alias("text"), kind.alias("kind"))
    out = marked.withColumn("role", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")))
    out = out.withColumn("text", F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")))
    times = F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    dropped = F.col("kind") == 0
    return out.withColumn("time", F.explode(times)).select("conv_id", "turn", *[F.when(~dropped, F.col(c)).alias(c) for c in ("role", "text")], dropped.alias("dropped"))


def faults(rows: DataFrame) -> DataFrame:
    """``rows`` (as ``damaged`` gives them) with place in the conversation, initial, fault (0 none, 1 blank, 2 duplicate,
    3 truncated), fresh (first row of its turn) and illegal (wrong after the row before)."""
    # the first window's shuffle by conversation serves all that follows; dropped rows come last
    line = Window.partitionBy("conv_id").orderBy("dropped", F.asc_nulls_first("turn"), "role", "text")
    same = Window.partitionBy("conv_id", "role", "text").orderBy("place")
    trimmed = F.btrim("text", F.lit(_SPACE))
    out = rows.withColumn("place", F.row_number().over(line)).withColumn("initial", F.substring("role", 1, 1))
    pair = F.concat(F.lag("initial").over(line), F.col("initial"))
    out = out.withColumns({"illegal": F.coalesce(~pair.isin("su", "ua", "au"), F.lit(False)), "fresh": F.coalesce(F.col("turn") != F.lag("turn").over(line), F.col("turn").isNotNull())})
    fault = F.when(trimmed == "", 1).when(F.row_number().over(same) > 1, 2).when(~F.right(trimmed, F.lit(1)).isin(".", "!", "?"), 3).otherwise(0)
    return out.withColumn("fault", fault)


def repaired(turns: Column, edits: Column) -> Column:
    """The turns, struct(role, text), after the edits."""
    turn = lambda role, text: F.struct(role.cast("string").alias("role"), text.cast("string").alias("text"))

    def added(letters: Column) -> Column:
        one = F.filter(F.split(letters, ""), lambda c: c != "")
        return F.transform(one, lambda c: turn(F.when(c == "I", "user").otherwise("assistant"), F.lit("")))

    def after(t: Column, letters: Column) -> Column:
        last = F.right(letters, F.lit(1))
        role = F.when(last == "K", t["role"]).when(last == "R", "user").otherwise("assistant")
        own = F.filter(F.array(turn(role, t["text"])), lambda _: last != "D")
        return F.when(F.length(letters) == 1, own).otherwise(F.concat(added(F.regexp_replace(letters, "[DKRS]", "")), own))

    each = F.zip_with(turns, F.regexp_extract_all(edits, F.lit("([IJ]*[DKRS])"), 1), after)
    return F.concat(F.flatten(each), added(F.regexp_extract(edits, "([IJ]*)$", 1)))


def repair(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit (initials of the edits) and
    repaired (array of role and text) of each conversation of ``rows``: conv_id, turn, role, text, and
    dropped, which is true for rows that only name their conversation."""
    if "dropped" not in rows.columns:
        space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
        rows = rows.select("conv_id", "turn", space("role"), space("text"), F.lit(False).alias("dropped"))
    live = ~F.col("dropped")
    number = lambda c, name: F.coalesce(F.sum(F.when(live & c, 1)), F.lit(0)).cast("bigint").alias(name)
    kept = F.when(~F.col("fault").isin(1, 2), F.col("text"))
    turn = F.struct("place", "initial", "fault", "role", kept.alias("text"))
    edge = lambda f: f(F.when(live, F.col("turn")))
    found = faults(rows).groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.when(live, turn))).alias("turns"),
        edge(F.max).alias("last"),
        edge(F.min).alias("first"),
        number(F.col("fresh"), "turn_count"),
        number(F.col("fault") == 1, "blank"),
        number(F.col("fault") == 2, "duplicate"),
        number(F.col("fault") == 3, "truncated"),
        number(F.col("illegal"), "illegal"),
    )
    found = found.withColumn("way", cheapest(F.col("turns"), block))
    gaps = F.coalesce(F.col("last") - F.col("first") + 1 - F.col("turn_count"), F.lit(0)).cast("bigint")
    return found.select("conv_id", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", F.col("way.cost").alias("cost"), F.translate("way.edits", "JS", "IR").alias("audit"), repaired(F.col("turns"), F.col("way.edits")).alias("repaired"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op12: every damaged conversation's faults, cheapest repair and digest of the repaired turns."""
    found = repair(damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet")))
    lines = F.array_join(F.transform("repaired", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    return found.select(*[c for c in found.columns if c != "repaired"], F.sha2(lines, 256).alias("repaired_sha256"))


#: The same by a recursive table that carries (cost, audit, text) of the four states turn by turn.
ORACLE_SQL = r"""
WITH RECURSIVE bits AS (
  SELECT i, CAST(i AS BIGINT) AS v, 0 AS step FROM range(256) r(i)
  UNION ALL SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, step + 1 FROM bits WHERE step < 8),
crc AS (SELECT list(v ORDER BY i) AS t FROM bits WHERE step = 8),
named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
kinds AS (
  SELECT k, xor(list_reduce(list_transform(range(0, strlen(k)), lambda i: CAST('0x' || substr(hex(k), 2 * i + 1, 2) AS BIGINT)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 20 AS kind
  FROM (SELECT DISTINCT k FROM named), crc),
live AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM (SELECT *, unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS time FROM named JOIN kinds USING (k)) WHERE kind <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place, substr(role, 1, 1) AS ini, regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS body FROM live),
flagged AS (
  SELECT *, lag(ini) OVER (PARTITION BY conv_id ORDER BY place) || ini AS pair,
    CASE WHEN body = '' THEN 1 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 THEN 2 WHEN NOT regexp_matches(right(body, 1), '[.!?]') THEN 3 ELSE 0 END AS fault FROM placed),
facts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate,
    count(*) FILTER (fault = 3) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, max(place) AS n FROM flagged GROUP BY conv_id),
walk AS (
  SELECT conv_id, 0::BIGINT AS place, {'c': 0, 'p': '', 't': ''} AS e, {'c': 1000000000, 'p': '', 't': ''} AS s, {'c': 1000000000, 'p': '', 't': ''} AS u, {'c': 1000000000, 'p': '', 't': ''} AS a FROM facts
  UNION ALL
  SELECT conv_id, place,
    {'c': e.c + 2, 'p': e.p || 'D', 't': e.t},
    CASE WHEN ini = 's' AND fault NOT IN (1, 2) THEN list_min([{'c': s.c + 2, 'p': s.p || 'D', 't': s.t}, {'c': e.c + x, 'p': e.p || 'K', 't': e.t || role || ':' || text || chr(10)}]) ELSE {'c': s.c + 2, 'p': s.p || 'D', 't': s.t} END,
    CASE WHEN fault IN (1, 2) THEN {'c': u.c + 2, 'p': u.p || 'D', 't': u.t}
      ELSE list_min([{'c': u.c + 2, 'p': u.p || 'D', 't': u.t}, {'c': o.c + x + CAST(ini <> 'u' AS INT), 'p': o.p || CASE WHEN ini = 'u' THEN 'K' ELSE 'R' END, 't': o.t || CASE WHEN ini = 'u' THEN role ELSE 'user' END || ':' || text || chr(10)}]) END,
    CASE WHEN fault IN (1, 2) THEN {'c': a.c + 2, 'p': a.p || 'D', 't': a.t}
      ELSE list_min([{'c': a.c + 2, 'p': a.p || 'D', 't': a.t}, {'c': u.c + x + CAST(ini <> 'a' AS INT), 'p': u.p || CASE WHEN ini = 'a' THEN 'K' ELSE 'R' END, 't': u.t || CASE WHEN ini = 'a' THEN role ELSE 'assistant' END || ':' || text || chr(10)}]) END
  FROM (
    SELECT *, list_min([e, s, a]) AS o FROM (
      SELECT conv_id, place, ini, fault, role, text, x, e, s, u, list_min([a, {'c': u.c + 5, 'p': u.p || 'I', 't': u.t || 'assistant:' || chr(10)}]) AS a FROM (
        SELECT w.conv_id, f.place, ini, fault, role, text, CASE WHEN fault = 3 THEN 5 ELSE 0 END AS x, e, s, a,
          list_min([u, {'c': e.c + 5, 'p': e.p || 'I', 't': e.t || 'user:' || chr(10)}, {'c': s.c + 5, 'p': s.p || 'I', 't': s.t || 'user:' || chr(10)}, {'c': a.c + 5, 'p': a.p || 'I', 't': a.t || 'user:' || chr(10)}]) AS u
        FROM walk w JOIN flagged f ON w.conv_id IS NOT DISTINCT FROM f.conv_id AND f.place = w.place + 1)))),
ends AS (
  SELECT w.conv_id, list_min([e, a, {'c': u.c + 5, 'p': u.p || 'I', 't': u.t || 'assistant:' || chr(10)}, {'c': s.c + 10, 'p': s.p || 'II', 't': s.t || 'user:' || chr(10) || 'assistant:' || chr(10)}]) AS b
  FROM walk w JOIN facts f ON w.conv_id IS NOT DISTINCT FROM f.conv_id AND w.place = f.n)
SELECT c.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  CAST(coalesce(b.c, 0) AS BIGINT) AS cost, coalesce(b.p, '') AS audit, sha256(CASE WHEN coalesce(b.t, '') = '' THEN '' ELSE left(b.t, -1) END) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN facts f ON c.conv_id IS NOT DISTINCT FROM f.conv_id LEFT JOIN ends n ON c.conv_id IS NOT DISTINCT FROM n.conv_id
"""

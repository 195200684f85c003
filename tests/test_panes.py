"""Early panes against the whole window's join and aggregate, in several orders of arrival."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from rivulet.operators import sinks, windows
from rivulet.operators.joins import windowed_left_join
from rivulet.streaming import panes, runner

LEFT = "k string, n long, x int, at timestamp"
RIGHT = "k string, n long, y string, at timestamp"


def side(spark, rows, names):
    df = spark.createDataFrame(rows, f"k string, n long, {names} string, t string")
    kind = "int" if names == "x" else "string"
    return df.select("k", "n", F.col(names).cast(kind).alias(names), F.to_timestamp("t").alias("at"))


def put(spark, folder, rows, names):
    side(spark, rows, names).coalesce(1).write.mode("append").parquet(str(folder))


def panes_of(spark, tmp_path, lateness="0 seconds", size="60 seconds"):
    """All rows that come out, each with the number of its micro-batch, and the query's last progress."""
    read = lambda name, schema: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / name))
    found = []
    joined = panes.early_left_join(read("l", LEFT), read("r", RIGHT), ["k", "n"], "at", "at", size, lateness)
    query = runner.start(joined, str(tmp_path / "cp"), lambda df, i: found.extend((i, r) for r in df.collect()), once=True)
    assert query.awaitTermination(240)
    assert query.exception() is None
    return found, query.lastProgress


def minute(n, second=5):
    return f"2025-01-18 15:{n:02d}:{second:02d}"


END = ("end", 0, None, "2025-01-18 18:00:00")


def whole(spark, left, right):
    rows = windowed_left_join(side(spark, left, "x"), side(spark, right, "y"), ["k", "n"], "at", "at").collect()
    return sorted((r.k, r.n, r.x, str(r["at"]), r.y) for r in rows)


def key(r):
    return (str(r[0]), r[1] is None, r[1] or 0, r[2] is None, r[2] or 0, r[3], r[4] is None, r[4] or "")


def test_one_pane_equals_the_whole_window(spark, tmp_path):
    r = random.Random(1)
    make = lambda n, names: [(r.choice("abc"), r.randrange(2), str(i), minute(r.randrange(4), r.randrange(60))) for i in range(n)]
    left, right = make(60, "x"), make(25, "y")
    put(spark, tmp_path / "l", left, "x")
    put(spark, tmp_path / "r", right, "y")
    put(spark, tmp_path / "l", [END], "x")
    put(spark, tmp_path / "r", [END], "y")
    found, last = panes_of(spark, tmp_path)
    got = sorted(((x.k, x.n, x.x, str(x["at"]), x.y) for _, x in found if x.k != "end"), key=key)
    assert got == sorted(whole(spark, left, right), key=key)
    assert {x.pane for _, x in found} == {panes.EARLY, panes.ON_TIME}
    assert {i for i, x in found if x.pane == panes.EARLY and x.k != "end"} == {0}
    # what is left in the state is the last window's
    assert sum(o.numRowsTotal for o in last.stateOperators) <= 6


def test_panes_give_no_pair_twice_and_lose_none(spark, tmp_path):
    r = random.Random(2)
    left = [(r.choice("ab"), 0, str(i), minute(r.randrange(2), r.randrange(60))) for i in range(40)]
    right = [(r.choice("abc"), 0, str(i), minute(r.randrange(2), r.randrange(60))) for i in range(30)]
    for i in range(0, 40, 10):
        put(spark, tmp_path / "l", left[i : i + 10], "x")
        put(spark, tmp_path / "r", right[i * 3 // 4 : i * 3 // 4 + 7] if i < 30 else right[21:], "y")
    right = right[:7] + right[7:14] + right[15:22] + right[21:]  # as they were put
    for _ in range(2):
        put(spark, tmp_path / "l", [END], "x")
        put(spark, tmp_path / "r", [END], "y")
    # a lateness of an hour keeps both windows open until the end rows
    found, _ = panes_of(spark, tmp_path, lateness="1 hour")
    got = sorted(((x.k, x.n, x.x, str(x["at"]), x.y) for _, x in found if x.k != "end"), key=key)
    assert got == sorted(whole(spark, left, right), key=key)
    assert len({i for i, x in found if x.pane == panes.EARLY and x.k != "end"}) >= 4


def test_late_rows_are_given_back(spark, tmp_path):
    put(spark, tmp_path / "l", [("a", 1, "1", minute(1)), (None, 1, "2", minute(1)), ("b", 1, "3", minute(1))], "x")
    put(spark, tmp_path / "r", [("a", 1, "p", minute(1)), (None, 1, "q", minute(1))], "y")
    for _ in range(2):
        put(spark, tmp_path / "l", [END], "x")
        put(spark, tmp_path / "r", [END], "y")
    put(spark, tmp_path / "l", [("a", 1, "9", minute(1)), ("z", 1, "8", minute(2))], "x")
    put(spark, tmp_path / "r", [("b", 1, "late", minute(1))], "y")
    found, _ = panes_of(spark, tmp_path)
    rows = sorted(((x.pane, x.k, x.x, x.y) for _, x in found if x.k != "end"), key=str)
    assert rows == sorted([("early", "a", 1, "p"), ("on time", None, 2, None), ("on time", "b", 3, None), ("late left", "a", 9, None), ("late left", "z", 8, None), ("late right", "b", None, "late")], key=str)


def test_paned_pairs_of_a_batch(spark):
    left = side(spark, [("a", 0, "1", minute(1)), ("a", 0, "2", minute(1)), ("b", 0, "3", minute(1))], "x").withColumn("pane", F.col("x") % 2)
    right = side(spark, [("a", 0, "p", minute(1, 50)), ("a", 0, "q", minute(2))], "y").withColumn("pane", F.lit(0))
    got = panes.paned_pairs(left, right, ["k", "n"], "at", "at", "pane").collect()
    assert sorted((r.k, r.x, r.y, r.pane) for r in got if r.y) == [("a", 1, "p", 1), ("a", 2, "p", 0)]
    assert [(r.k, r.x, r.pane) for r in got if not r.y] == [("b", 3, None)]


def events(spark, rows):
    return spark.createDataFrame(rows, "k string, v int, t string").select("k", "v", F.to_timestamp("t").alias("at"))


@pytest.mark.parametrize("order", list(itertools.permutations(range(3))))
def test_panes_in_any_order_end_alike(spark, tmp_path, order):
    rows = [[("a", 1, minute(1)), ("b", 5, minute(1))], [("a", 2, minute(1))], [("b", 1, minute(1)), ("c", 7, minute(2))]]
    for number in [*order, order[0]]:  # one pane comes again
        so_far = events(spark, [r for pane in rows[: number + 1] for r in pane]).groupBy("k").agg(F.sum("v").alias("s"))
        touched = {r[0] for r in rows[number]}
        panes.replace_panes(so_far.where(F.col("k").isin(*touched)), str(tmp_path / "t"), ["k"], number)
    got = {(r.k, r.s) for r in sinks.read_keyed(spark, str(tmp_path / "t")).collect()}
    assert got == {("a", 3), ("b", 6), ("c", 7)}


def test_accumulating_stream_ends_as_the_batch(spark, tmp_path):
    r = random.Random(3)
    parts = [[(r.choice("abc"), r.randrange(100), minute(r.randrange(3), r.randrange(60))) for _ in range(20)] for _ in range(4)]
    for part in parts:
        events(spark, part).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    whole_window = lambda df: windows.watermark(df, "at", "1 hour").groupBy(windows.tumbling("at", "60 seconds").alias("w"), "k").agg(F.sum("v").alias("s"), F.count("*").alias("n")).select("k", F.col("w.start").alias("start"), "s", "n")
    source = spark.readStream.schema("k string, v int, at timestamp").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = panes.accumulate(whole_window(source), str(tmp_path / "t"), ["k", "start"], str(tmp_path / "cp"), once=True)
    assert query.awaitTermination(240)
    got = sinks.read_keyed(spark, str(tmp_path / "t"))
    want = whole_window(events(spark, [r for part in parts for r in part]))
    assert sorted(map(tuple, got.drop("pane").collect())) == sorted(map(tuple, want.collect()))
    assert got.select("pane").distinct().count() > 1


def test_accumulated_panes_are_running_totals(spark):
    rows = spark.createDataFrame([("a", 1, 5), ("a", 1, 2), ("a", 3, 1), ("b", 2, 9)], "k string, pane int, v int")
    each = panes.discarded(rows, ["k"], "pane", F.sum("v").alias("s"), F.max("v").alias("most"))
    got = panes.accumulated(each, ["k"], "pane", s=F.sum, most=F.max)
    assert sorted(map(tuple, got.collect())) == [("a", 1, 7, 5), ("a", 3, 8, 5), ("b", 2, 9, 9)]

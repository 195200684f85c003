"""Delivery against collectors that fail, crash and remember; pacing against the clock."""

import base64
import gzip
import json
import os
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rivulet.operators import delivery


def collector(folder, fails=None, remembers=True):
    """A collector in files: ``fails`` is a file whose number of status is the answer; bodies are taken once a key."""

    def send(body, key):
        status = int(open(fails).read()) if fails and os.path.exists(fails) else 200
        with open(f"{folder}/calls", "a") as f:
            f.write(f"{key} {status}\n")
        if status == 200 and not (remembers and os.path.exists(f"{folder}/{key}")):
            name = key if remembers else f"{key}-{time.monotonic_ns()}"
            with open(f"{folder}/{name}", "wb") as f:
                f.write(body)
        return status

    return send


def taken(folder):
    out = []
    for name in os.listdir(folder):
        if name != "calls":
            text, at = gzip.decompress(open(f"{folder}/{name}", "rb").read()).decode(), 0
            while at < len(text):
                event, at = json.JSONDecoder().raw_decode(text, at)
                out.append(event["event"])
    return out


def events(spark, names):
    return spark.createDataFrame([(json.dumps({"event": n}),) for n in names], "value string").coalesce(2)


QUICK = delivery.Backoff(first=0.001, most=0.002)


def test_waits_grow_and_are_cut(spark):
    b = delivery.Backoff(first=1, factor=3, most=20, jitter=0.5)
    assert [b.seconds(n, 0.0) for n in (1, 2, 3, 4)] == [1, 3, 9, 20]
    assert b.seconds(3, 0.5) == 6.75
    waits, answers = [], iter([503, None, 429, 200])
    body = delivery.attempt(b"x", lambda _: next(answers), delivery.Backoff(first=1, jitter=0, sleep=waits.append), tries=5)
    assert waits == [1, 2, 4] and body[3:] == (200, "ok")
    calls = []
    assert delivery.attempt(b"x", lambda b: calls.append(b) or 400, QUICK, 5)[3:] == (400, "dead") and len(calls) == 1

    def broken(_):
        raise OSError("no route")

    assert delivery.attempt(b"x", broken, QUICK, 2)[3:] == (None, "retry")
    assert gzip.decompress(base64.b64decode(body[0])) == b"x"


@pytest.fixture
def places(tmp_path):
    (tmp_path / "c").mkdir()
    return {"report": str(tmp_path / "report"), "queue": str(tmp_path / "queue"), "dead": str(tmp_path / "dead")}, str(tmp_path / "c"), str(tmp_path / "status")


def dead_of(spark, places):
    return [json.loads(r.value)["event"] for r in spark.read.parquet(places["dead"]).collect()]


def test_a_collector_that_fails_for_three_batches(spark, places):
    where, folder, status = places
    send, sent = collector(folder, status), []
    for number in range(5):
        open(status, "w").write("503" if number < 3 else "200")
        names = [f"{number}-{i}" for i in range(7)]
        sent += names
        delivery.deliver(events(spark, names), send, **where, batch_id=number, backoff=QUICK, batch=3, tries=2, attempts=9, seconds=0.0)
        waits = delivery.waiting(spark, where["queue"]).count()
        assert waits == (7 * (number + 1) if number < 3 else 0)
    assert sorted(taken(folder)) == sorted(sent)
    assert dead_of(spark, where) == []
    assert len([n for n in os.listdir(where["queue"]) if n.startswith("batch_id")]) <= 4


def test_events_are_dead_after_so_many_batches(spark, places):
    where, folder, status = places
    open(status, "w").write("503")
    send = collector(folder, status)
    for number in range(4):
        delivery.deliver(events(spark, ["a", "b"] if number == 0 else []), send, **where, batch_id=number, backoff=QUICK, tries=1, attempts=3, seconds=0.0)
    assert sorted(dead_of(spark, where)) == ["a", "b"] and delivery.waiting(spark, where["queue"]).isEmpty()
    letters = spark.read.parquet(where["dead"]).collect()
    assert {(r.status, r.attempts, r.batch_id) for r in letters} == {(503, 3, 2)}
    open(status, "w").write("400")
    delivery.deliver(events(spark, ["c"]), send, **where, batch_id=4, backoff=QUICK)
    assert sorted(dead_of(spark, where)) == ["a", "b", "c"]


def test_events_wait_until_they_are_due(spark, places):
    where, folder, status = places
    send = collector(folder, status)
    open(status, "w").write("503")
    slow = delivery.Backoff(first=0.001, most=3600, jitter=0.0)
    delivery.deliver(events(spark, ["a"]), send, **where, batch_id=0, backoff=slow, tries=1, seconds=1000)
    open(status, "w").write("200")
    delivery.deliver(events(spark, ["b"]), send, **where, batch_id=1, backoff=slow, tries=1, seconds=1000)
    assert taken(folder) == ["b"]
    left = delivery.waiting(spark, where["queue"]).select("failures", ((F.unix_timestamp("due") - F.unix_timestamp(F.current_timestamp())).between(900, 1000)).alias("later")).collect()
    assert [tuple(r) for r in left] == [(1, True)]


def test_a_finished_batch_posts_nothing_again(spark, places):
    where, folder, _ = places
    send = collector(folder, remembers=False)
    for _ in range(3):
        delivery.deliver(events(spark, ["a", "b", "c"]), send, **where, batch_id=0, batch=2)
    assert sorted(taken(folder)) == ["a", "b", "c"]


def test_an_unfinished_report_is_no_report(spark, places):
    where, folder, _ = places
    send = collector(folder)
    os.makedirs(f"{where['report']}/batch_id=0/_temporary/0")  # the writer of the report was killed
    delivery.deliver(events(spark, ["a", "b"]), send, **where, batch_id=0)
    assert sorted(taken(folder)) == ["a", "b"]


@pytest.mark.parametrize("step", ["report", "queue", "dead"])
def test_a_crash_between_post_and_commit(spark, places, step, monkeypatch):
    where, folder, status = places
    open(status, "w").write("503")
    send = collector(folder, status)
    delivery.deliver(events(spark, ["old"]), send, **where, batch_id=0, backoff=QUICK, tries=1, seconds=0.0)
    open(status, "w").write("200")
    real = {"report": delivery.left_over, "queue": delivery.undeliverable, "dead": delivery._remove}[step]

    def crash(*_, **__):
        raise KeyboardInterrupt

    monkeypatch.setattr(delivery, real.__name__, crash)
    if step != "dead":
        with pytest.raises(KeyboardInterrupt):
            delivery.deliver(events(spark, ["new"]), send, **where, batch_id=1, backoff=QUICK, tries=1, seconds=0.0)
    if step == "report":  # the report did not come to its end either, and everything is posted again under the same keys
        os.remove(f"{where['report']}/batch_id=1/_SUCCESS")
    monkeypatch.undo()
    delivery.deliver(events(spark, ["new"]), send, **where, batch_id=1, backoff=QUICK, tries=1, seconds=0.0)
    assert Counter(taken(folder)) == Counter(["old", "new"])
    assert delivery.waiting(spark, where["queue"]).isEmpty() and dead_of(spark, where) == []


def test_delivery_of_a_stream(spark, places, tmp_path):
    from rivulet.streaming import runner

    where, folder, _ = places
    for k in range(3):
        events(spark, [f"{k}{i}" for i in range(5)]).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    source = spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    send = collector(folder)
    query = runner.start(source, str(tmp_path / "cp"), lambda rows, n: delivery.deliver(rows, send, **where, batch_id=n), once=True)
    assert query.awaitTermination(240)
    assert sorted(taken(folder)) == sorted(f"{k}{i}" for k in range(3) for i in range(5))


@pytest.mark.parametrize(("rate", "lanes"), [(100, 1), (300, 2)])
def test_pace(spark, rate, lanes):
    df = spark.range(0, int(rate * 3), 1, 6)
    delivery.paced(spark.range(10), 1000).count()  # warm
    began = time.monotonic()
    assert delivery.paced(df, rate, lanes).write.format("noop").mode("overwrite").save() is None
    took = time.monotonic() - began
    assert 2.7 <= took <= 4.5  # three seconds, a start and the first slice


def test_token_bucket_keeps_the_rate():
    now, waits = [0.0], []

    def sleep(s):
        waits.append(s)
        now[0] += s

    bucket = delivery.TokenBucket(50, 10, clock=lambda: now[0], sleep=sleep)
    for _ in range(100):
        bucket.take(10)
        now[0] += 0.01  # work between
    assert abs(1000 / now[0] - 50) / 50 < 0.1
    assert delivery.admission(200, 10) == {"maxOffsetsPerTrigger": "2000"}

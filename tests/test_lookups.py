"""Live lookups: changes are seen, calls are few, and a client that hangs or fails is dealt with as configured."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from rivulet.operators import lookups
from rivulet.streaming import runner


def store(folder, rows):
    """A store in a file, which counts the keys that it is asked for; a key ``slow`` hangs, ``bad`` fails."""
    path = f"{folder}/rows.json"
    with open(f"{path}.new", "w") as f:
        json.dump(rows, f)
    os.replace(f"{path}.new", path)

    def connect():
        class Store:
            def get_many(self, keys):
                with open(f"{folder}/asked", "a") as f:
                    f.writelines(f"{k}\n" for k in keys)
                if "slow" in keys:
                    time.sleep(5)
                if "bad" in keys:
                    raise OSError("gone")
                known = json.load(open(path))
                return {k: known[k] for k in keys if k in known}

        return Store()

    return connect


def asked(folder):
    return open(f"{folder}/asked").read().split() if os.path.exists(f"{folder}/asked") else []


SCHEMA = "model string, year int"


def test_hits_and_misses(spark, tmp_path):
    connect = store(tmp_path, {"a": {"model": "A", "year": 2}, "b": {"model": "B", "other": 1}})
    events = spark.createDataFrame([(k, i) for i, k in enumerate(["a", "b", "c", None, "a"] * 50)], "k string, n int").coalesce(1)
    got = lookups.lookup(events, connect, "k", SCHEMA)
    rows = {(r.k, r.model, r.year, r.lookup) for r in got.collect()}
    assert rows == {("a", "A", 2, "hit"), ("b", "B", None, "hit"), ("c", None, None, "miss"), (None, None, None, "miss")}
    assert sorted(asked(tmp_path)) == ["a", "b", "c"]  # each distinct key once
    assert lookups.lookup(events, connect, "k", SCHEMA, misses="drop").count() == 150
    with pytest.raises(Exception, match="100 lookups without a row"):
        lookups.lookup(events, connect, "k", SCHEMA, misses="raise").collect()
    assert lookups.lookup(events.limit(0), connect, "k", SCHEMA).columns == ["k", "n", "model", "year", "lookup"]
    with pytest.raises(ValueError, match="stand twice"):
        lookups.lookup(events, connect, "k", "n int")


def test_a_client_that_hangs_or_fails(spark, tmp_path):
    connect = store(tmp_path, {"a": {"model": "A"}, "slow": {"model": "S"}})
    events = lambda *keys: spark.createDataFrame([(k,) for k in keys], "k string").coalesce(1)
    ask = lambda df, **o: {(r.k, r.model, r.lookup) for r in lookups.lookup(df, connect, "k", SCHEMA, timeout=0.5, batch=1, **o).collect()}
    assert ask(events("a", "slow", "bad", "a"), failures="keep") == {("a", "A", "hit"), ("slow", None, "timeout"), ("bad", None, "failed")}
    assert ask(events("a", "slow", "bad"), failures="drop") == {("a", "A", "hit")}
    with pytest.raises(Exception, match="1 lookups without a row, first that of 'slow'"):
        ask(events("a", "slow"))
    # what failed is asked for again by the next batch, what was a miss is remembered
    worker = lookups.Worker(connect, 0.5, 10, 10, 60)
    assert worker.find(["bad"])["bad"][0] == "failed" and worker.find(["x"])["x"][0] == "miss"
    before = len(asked(tmp_path))
    assert worker.find(["x", "bad"])["x"][0] == "miss" and asked(tmp_path)[before:] == ["bad"]


def test_cache_is_bounded_and_ages():
    now = [0.0]
    cache = lookups.Cache(2, 10, clock=lambda: now[0])
    for k in "abc":
        cache.put(k, {"k": k})
    assert cache.get("a") == (False, None) and cache.get("b") == (True, {"k": "b"})
    cache.put("d", None)  # c was asked for longest ago
    assert cache.get("c")[0] is False and cache.get("d") == (True, None)
    now[0] = 10.0
    assert cache.get("b")[0] is False


def test_a_change_between_micro_batches_is_seen(spark, tmp_path):
    for _ in range(2):
        spark.createDataFrame([("a",), ("a",)], "k string").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    connect = store(tmp_path, {"a": {"model": "old"}})
    source = spark.readStream.schema("k string").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    found = []

    def each(rows, number):
        found.extend((number, r.model) for r in rows.collect())
        store(tmp_path, {"a": {"model": "new"}})

    query = runner.start(lookups.lookup(source, connect, "k", SCHEMA, age=0), str(tmp_path / "cp"), each, once=True)
    assert query.awaitTermination(120)
    assert found == [(0, "old")] * 2 + [(1, "new")] * 2
    assert asked(tmp_path) == ["a", "a"]


def test_vehicles_are_enriched_live(spark, tmp_path):
    from rivulet.plans import iot

    connect = store(tmp_path, {"1": {"last_service_date": "2025-01-01", "maintenance_type": "oil", "model": "M"}})
    metrics = spark.createDataFrame([("1", 80.0, 0.1, 500), ("2", 60.0, 0.2, 700)], "vehicle_id string, max_temperature double, max_vibration double, avg_mileage long").withColumn("max_timestamp", F.to_timestamp(F.lit("2025-01-18 15:00:00")))
    got = {r.vehicle_id: (r.model, r.last_service_date) for r in iot.enriched_live(metrics, connect).collect()}
    assert got == {"1": ("M", "2025-01-01")}
    kept = {r.vehicle_id: r.enrichment_miss for r in iot.enriched_live(metrics, connect, keep_misses=True).collect()}
    assert kept == {"1": False, "2": True}

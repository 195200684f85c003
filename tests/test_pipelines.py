"""Hand-derived results of the pipelines on small samples, batch against stream, and bad input."""

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rivulet.functions import schemas
from rivulet.operators import inference, jsonio, sinks, windows
from rivulet.operators.aggregates import vehicle_metrics
from rivulet.plans import cdp, clickstream, cli, etl, iot, logs, predictions
from rivulet.sources.messages import as_messages, from_queue, queue_options, read_csv, read_json_lines, read_messages
from rivulet.streaming import runner, stateful

T0 = "2025-01-18 15:56:41"


def messages(spark, objects, time=T0):
    rows = [(x if isinstance(x, str) else json.dumps(x), time) for x in objects]
    df = spark.createDataFrame(rows, "v string, t string")
    return as_messages(df, F.col("v"), F.to_timestamp("t"))


def transactions():
    return [{"household_key": "1", "transaction_id": "27", "product_id": p, "coupon_disc": "0"} for p in ("941769", "910635")]


def coupons():
    return [{"household_key": "1", "transaction_id": "27", "coupon_upc": c} for c in ("10000085364", "51700010076")] + [{"household_key": "13", "transaction_id": "28", "coupon_upc": "9"}]


def test_cdp_all_combinations(spark):
    out = cdp.build(messages(spark, transactions()), messages(spark, coupons())).collect()
    assert {(r.product_id, r.coupon_upc) for r in out} == {(p, c) for p in ("941769", "910635") for c in ("10000085364", "51700010076")}
    assert {r.coupon_discount for r in out} == {"0"}


def test_cdp_other_window_gives_nulls(spark):
    out = cdp.build(messages(spark, transactions()), messages(spark, coupons(), "2025-01-18 16:10:00")).collect()
    assert [(r.product_id, r.coupon_upc) for r in sorted(out)] == [("910635", None), ("941769", None)]


VEHICLES = [("1000", 80, 0.1, 500), ("1001", 60, 0.2, 700), ("1002", 60, 0.9, 900)]


def vehicle_messages(spark, extra=()):
    rows = [{"vehicle_id": v, "timestamp": "2025-01-18T15:56:41Z", "temperature": t, "rpm": 1, "vibration": b, "fuel_level": 3, "mileage": m} for v, t, b, m in VEHICLES]
    return messages(spark, [*rows, *extra])


def dimension(spark):
    return spark.createDataFrame([(v, d, "oil", "Velora", "Cargo 9") for v, d in (("1000", "2025-01-01"), ("1001", "2024-01-01"), ("1002", "2025-01-01"))], schemas.MAINTENANCE)


def test_iot_metrics_and_rule(spark):
    out = {r.vehicle_id: r for r in iot.build(vehicle_messages(spark, ["{broken", {"vehicle_id": "9"}]), dimension(spark)).collect()}
    assert set(out) == {"1000", "1001", "1002"}
    assert [out[k].needs_maintenance for k in sorted(out)] == [1, 1, 1]
    assert out["1000"].max_temperature == 80
    assert str(out["1000"].latest_timestamp) == T0


def test_iot_miss(spark):
    parsed = iot.parse(vehicle_messages(spark)).good
    found = iot.enriched(vehicle_metrics(parsed), dimension(spark).where("vehicle_id = '1000'"), keep_misses=True)
    assert {(r.vehicle_id, r.enrichment_miss) for r in found.collect()} == {("1000", False), ("1001", True), ("1002", True)}


def test_every_vehicle_message_is_an_event_or_an_error(spark):
    found = iot.parse(vehicle_messages(spark, ["{broken", {"vehicle_id": "9"}, {"timestamp": "2025-01-18T15:56:41Z"}, "[1]", ""]))
    assert found.good.count() == 3
    assert sorted(r.error_message for r in found.errors.collect()) == ["missing or malformed: timestamp", "missing: vehicle_id", *["not a JSON object"] * 3]


def test_malformed_transactions_are_errors(spark):
    found = cdp.parse(messages(spark, [*transactions(), "{bad", '{"day": 1}', '{"transaction_id": "5", "day": NaN, "product_id": "x: NaN"}\n', ""]), schemas.TRANSACTION)
    assert {(r.transaction_id, r.day, r.product_id) for r in found.good.collect()} == {("27", None, "941769"), ("27", None, "910635"), ("5", None, "x: NaN")}
    assert sorted(r.error_message for r in found.errors.collect()) == ["JsonParseError", "JsonParseError", "missing: transaction_id"]


def test_event_time_is_strict_and_utc(spark):
    df = spark.createDataFrame([("2025-01-18T15:56:41Z",), ("2025-01-18T15:56:41.5Z",), ("x",)], "t string")
    assert [str(r.event_time) for r in windows.event_time(df, "t").collect()] == [T0]


TAXI = {"ride_id": "a", "point_idx": "3", "latitude": 1, "longitude": "2.5", "timestamp": "2025-01-18T15:56:41Z", "meter_reading": 1.5, "meter_increment": "0.1", "ride_status": "enroute", "passenger_count": 2, "unknown": {"x": 1}}


def test_taxi_good_and_bad(spark):
    bad = ["", "3", "[1]", '{"ride_id"', TAXI | {"point_idx": "3.0"}, TAXI | {"point_idx": 3000000000}, {k: v for k, v in TAXI.items() if k != "latitude"}]
    out = etl.build(messages(spark, [TAXI, *bad]))
    good = out.good.collect()
    assert [(g.ride_id, g.point_idx, g.longitude) for g in good] == [("a", 3, 2.5)]
    assert out.good.columns == schemas.TAXI_EVENT.names
    errors = {r.input_data: r.error_message for r in out.errors.collect()}
    assert len(errors) == len(bad)
    assert errors["3"] == "not a JSON object"
    assert any(m == "missing or malformed: latitude" for m in errors.values())


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.text(max_size=30), st.dictionaries(st.sampled_from(list(TAXI)), st.one_of(st.none(), st.integers(), st.text(max_size=5), st.floats(allow_nan=False)), max_size=9).map(json.dumps)), min_size=1, max_size=8))
def test_every_message_is_good_or_bad(spark, texts):
    texts = [t.encode("utf-8", "replace").decode() for t in texts]
    out = etl.build(messages(spark, texts))
    assert out.good.count() + out.errors.count() == len(texts)


def test_nested_schema(spark):
    schema = schemas.T.StructType.fromDDL("a struct<b: array<int>, c: boolean>, d array<struct<e: double>>")
    row = spark.createDataFrame([('{"a": {"b": ["1", 2, "x"], "c": "TRUE", "z": 0}, "d": [{"e": "1.5"}]}',)], "v string").select(jsonio.sanitize(F.col("v"), schema).alias("r")).first().r
    assert (row.a.b, row.a.c, row.d[0].e) == ([1, 2, None], True, 1.5)


def test_upsert_and_replica(spark, tmp_path):
    rows = lambda r: spark.createDataFrame(r, "k int, ts int, v string")
    table = str(tmp_path / "t")
    sinks.upsert(rows([(1, 1, "a"), (2, 1, "b"), (1, 2, "c")]), table, ["k"], ["ts"])
    for _ in range(2):  # a batch that is run again changes nothing
        sinks.upsert(rows([(2, 5, "z"), (3, 1, "n"), (1, 0, "late")]), table, ["k"], ["ts"])
    assert {(r.k, r.v) for r in sinks.read_keyed(spark, table).collect()} == {(1, "c"), (2, "z"), (3, "n")}
    log = lambda r: spark.createDataFrame(r, "k int, ts int, v string, mod_type string")
    replica = str(tmp_path / "r")
    sinks.apply_changes(log([(1, 1, "a", "INSERT"), (1, 3, "a", "DELETE"), (2, 1, "b", "INSERT"), (2, 3, "B", "UPDATE")]), replica, ["k"], ["ts"])
    sinks.apply_changes(log([(2, 4, "B", "DELETE"), (5, 1, "e", "INSERT"), (1, 2, "old", "UPDATE")]), replica, ["k"], ["ts"])
    assert {(r.k, r.v) for r in sinks.read_keyed(spark, replica).collect()} == {(5, "e")}


def test_an_upsert_leaves_other_buckets_alone(spark, tmp_path):
    table = str(tmp_path / "t")
    sinks.upsert(spark.range(200).selectExpr("id as k", "1 as ts"), table, ["k"], ["ts"], buckets=8)
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("*.parquet")}
    sinks.upsert(spark.createDataFrame([(7, 2)], "k long, ts int"), table, ["k"], ["ts"], buckets=8)
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("*.parquet")}
    assert len(set(before.items()) & set(after.items())) >= 7
    assert {(r.k, r.ts) for r in sinks.read_keyed(spark, table).collect()} == {(k, 2 if k == 7 else 1) for k in range(200)}


def test_a_table_keeps_its_layout(spark, tmp_path):
    table = str(tmp_path / "t")
    rows = spark.range(50).selectExpr("id as k", "1 as ts")
    sinks.upsert(rows, table, ["k"], ["ts"], buckets=8)
    sinks.upsert(rows.selectExpr("k", "2 as ts"), table, ["k"], ["ts"])  # by the table's own number
    assert {(r.k, r.ts) for r in sinks.read_keyed(spark, table).collect()} == {(k, 2) for k in range(50)}
    with pytest.raises(ValueError, match="8 buckets"):
        sinks.upsert(rows, table, ["k"], ["ts"], buckets=16)
    with pytest.raises(ValueError, match="8 buckets"):
        sinks.upsert(rows, table, ["ts"], ["k"])
    assert sinks._layout(spark, str(tmp_path / "new"), ["k"], None, rows) == 64


def test_old_tombstones_are_forgotten(spark, tmp_path):
    table = str(tmp_path / "t")
    log = lambda r: spark.createDataFrame(r, "k int, ts int, mod_type string")
    sinks.apply_changes(log([(k, k, "DELETE" if k % 2 else "INSERT") for k in range(40)]), table, ["k"], ["ts"], buckets=4)
    assert sinks.forget_deleted(spark, table, F.col("ts") < 20) > 0
    left = {(r.k, r.mod_type) for r in spark.read.parquet(table).collect()}
    assert left == {(k, "DELETE" if k % 2 else "INSERT") for k in range(40) if k >= 20 or k % 2 == 0}
    assert sinks.forget_deleted(spark, table, F.col("ts") < 20) == 0
    assert sinks.read_keyed(spark, table).count() == 20


def test_a_destination_for_each_row(spark, tmp_path):
    sinks.route(spark.range(10), F.when(F.col("id") > 6, "big").otherwise("small"), str(tmp_path / "r"))
    assert {(r.destination, r["count"]) for r in spark.read.parquet(str(tmp_path / "r")).groupBy("destination").count().collect()} == {("big", 3), ("small", 7)}


def test_json_lines_round_trip(spark, tmp_path):
    from rivulet.sources.synthetic import maintenance

    sinks.append_json_lines(maintenance(spark, 50), str(tmp_path / "j"))
    good, bad = read_json_lines(spark, str(tmp_path / "j"), schemas.MAINTENANCE)
    assert sorted(map(tuple, good.collect())) == sorted(map(tuple, maintenance(spark, 50).collect()))
    assert bad.count() == 0


def test_queue_options_and_records(spark):
    assert queue_options("kafka://a:1,b:2/clicks?group=g") == {"kafka.bootstrap.servers": "a:1,b:2", "subscribe": "clicks", "includeHeaders": "true", "kafka.group.id": "g"}
    assert "kafka.group.id" not in queue_options("kafka://a:1/clicks")
    assert sinks.publish_options("kafka://a:1,b:2/out") == {"kafka.bootstrap.servers": "a:1,b:2", "topic": "out"}
    raw = spark.createDataFrame([(b"x", [("k", b"1"), ("k", b"2")]), (b"y", None)], "value binary, headers array<struct<key: string, value: binary>>").withColumn("timestamp", F.to_timestamp(F.lit(T0)))
    assert [(bytes(r.value), r.attributes) for r in from_queue(raw).collect()] == [(b"x", {"k": "2"}), (b"y", {})]


def test_line_ends_around_objects(spark):
    texts = ['{"a":1}\n', '\n{"a":1}', '{"a":1}\r', '\t{"a":1} ', '{"a":1} x}', '{"a":1} {}', '{"a":1}],[{}', '{"a":1},"b":{}', '{"a":1,"a":2}', "\u00a0{}"]
    found = jsonio.parse_objects(messages(spark, texts)).select(F.col("error_tag").isNull().alias("ok")).collect()
    assert [r.ok for r in found] == [True] * 4 + [False] * 6
    mark = jsonio._MARK  # a message may hold what the parser is asked to find behind it
    texts = [f'{{"{mark}":"{mark}"}}', f'{{"a":1}},"{mark}"],[{{}}', f'{{"a":1}},"{mark}"', f'{{"a":[{{}},"{mark}"]}}']
    assert [r.error_tag is None for r in jsonio.parse_objects(messages(spark, texts)).collect()] == [True, False, False, True]


def test_clickstream_routes_everything(spark, tmp_path):
    good = {"prev": "a", "curr": "b", "type": "link", "n": "7", "more": 1}
    rows, letters = clickstream.parse(messages(spark, [good, good | {"n": "many"}, "{cut", {"prev": "x" * 300}]), cfg=clickstream.Config(most_bytes=200))
    assert [tuple(r) for r in rows.collect()] == [("a", "b", "link", 7)]
    assert sorted(r.errorMessage for r in letters.collect()) == ["JsonParseError", "TooBigRow", "n: not bigint"]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        clickstream.write_batch(messages(spark, [good]), str(tmp_path / "none"), str(tmp_path / "dead"))
    rows.limit(0).write.parquet(str(tmp_path / "table"))
    clickstream.write_batch(messages(spark, [good]), str(tmp_path / "table"), str(tmp_path / "dead"))
    assert spark.read.parquet(str(tmp_path / "table")).count() == 1


def test_counters_on_a_batch(spark):
    tagged = jsonio.parse_objects(messages(spark, ["{}", "x", "{" + " " * 50 + "}"]), most=40)
    assert tuple(jsonio.counters(tagged).first()) == (3, 1, 1, 1, 0)


def shout():
    class Shout:  # local, so that workers get it by value
        def generate(self, text, max_length):
            return text.upper()

        def predict(self, instances):
            return [i["id"] + 1 for i in instances]

    return Shout


def shouting(model_id):
    return inference.TemplateHandler(shout(), model_id)


def test_counters_of_a_stream_survive_a_restart(spark, tmp_path):
    from rivulet.streaming.counters import CounterLog, totals

    names = ["received_messages", "successful_messages", "json_parse_failed_messages", "too_big_messages", "failed_insert_messages"]
    log = CounterLog(spark, str(tmp_path / "log"))
    spark.streams.addListener(log)
    try:
        def run():
            source = read_messages(spark, f"parquet:{tmp_path / 'in'}", stream=True, maxFilesPerTrigger="1")
            tagged = jsonio.observe_counters(jsonio.parse_objects(source, most=40))
            query = runner.append_stream(tagged.select("value", "error_tag"), str(tmp_path / "out"), str(tmp_path / "cp"), once=True)
            assert query.awaitTermination(120)
            return str(query.id)

        for texts in (["{}", "x"], ["{" + " " * 50 + "}", "{}", "{}"]):
            put(spark, tmp_path / "in", texts, T0)
        first = run()
        put(spark, tmp_path / "in", ["[", '{"a": 1}'], T0)
        assert run() == first
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        import time

        for _ in range(50):
            found = totals(spark, str(tmp_path / "log"), *names).collect() if (tmp_path / "log").exists() else []
            if found and found[0].batches == 3:
                break
            time.sleep(0.2)
        whole = jsonio.counters(jsonio.parse_objects(read_messages(spark, f"parquet:{tmp_path / 'in'}"), most=40)).first()
        assert [tuple(r)[2:] for r in found] == [tuple(whole)] and whole.received_messages == 7
        log.put(first, 1, {n: getattr(found[0], n) * 0 + 3 for n in names})  # a batch that runs again replaces its numbers
        assert totals(spark, str(tmp_path / "log"), *names).first().batches == 3
    finally:
        spark.streams.removeListener(log)


def test_weights_are_mapped_and_shared(spark, tmp_path):
    import numpy as np

    from rivulet.operators import mapped

    weights = {"w": np.arange(3_000_000, dtype=np.float64).reshape(3, -1), "bias": np.array([2, 3], np.int16), "none": np.zeros((0, 4), np.float32)}
    mapped.write_arrays(weights, str(tmp_path / "a"))
    back = mapped.map_arrays(str(tmp_path / "a"))
    assert all(np.array_equal(back[n], a) and back[n].dtype == a.dtype and back[n].shape == a.shape for n, a in weights.items())
    assert back["w"].flags.aligned and not back["w"].flags.writeable
    name = mapped.ship(spark, weights, f"weights-{tmp_path.name}")

    def ask(batch, model):
        import os
        import re

        total = float(model["w"].sum())
        maps = open("/proc/self/smaps").read()
        part = maps[maps.index(name) :].split("VmFlags")[0]
        size = {k: int(v) for k, v in re.findall(r"(Rss|Anonymous):\s+(\d+)", part)}
        return [f"{os.getpid()} {total} {size['Rss'] > 20_000} {size['Anonymous']} {text}" for text in batch]

    handler = mapped.MappedHandler(name, lambda arrays: arrays, ask, "mapped")
    df = spark.range(400).selectExpr("cast(id as string) as value").repartition(8)
    rows = [r.inference.split() for r in inference.run_inference(df, handler).collect()]
    assert {tuple(r[1:4]) for r in rows} == {(str(float(weights["w"].sum())), "True", "0")}  # resident, and no page of it a worker's own
    assert sorted(int(r[4]) for r in rows) == list(range(400)) and len({r[0] for r in rows}) >= 1


def test_models_are_kept_by_handler(spark):
    df = messages(spark, ['{"id": 4}'])
    assert inference.run_inference(df, shouting("same")).first().inference == '{"ID": 4}'
    other = inference.EndpointHandler(shout(), "same", json_instances=True)
    assert inference.run_inference(df, other).first().inference == "5"


def picky(calls, bad):
    class Picky:  # counts its calls in a file
        def predict(self, instances):
            with open(calls, "a") as f:
                f.write(".")
            if set(instances) & bad:
                raise RuntimeError("refused")
            return [x.upper() for x in instances]

    return Picky


@pytest.mark.parametrize("bad", [set(), {"t500"}, {"t0", "t999", "t500"}])
def test_failing_examples_stand_alone(spark, tmp_path, bad):
    texts = [f"t{i}" for i in range(1000)]
    df = messages(spark, texts).coalesce(1)
    handler = inference.EndpointHandler(picky(f"{tmp_path}/calls", bad), "p")
    found = inference.tagged_inference(df, handler, batch=1000).collect()
    assert {(r.example, r.inference, r.error) for r in found} == {(t, None if t in bad else t.upper(), "RuntimeError: refused" if t in bad else None) for t in texts}
    assert len((tmp_path / "calls").read_text()) <= 1 + 2 * 10 * len(bad)
    good, wrong = inference.split_inference(inference.tagged_inference(df, handler))
    assert good.columns == ["example", "inference", "model_id"] and {r.input_data for r in wrong.collect()} == bad
    if bad:
        with pytest.raises(Exception, match="inference failed for t"):
            inference.run_inference(df, handler).collect()


def test_models_with_too_few_outputs_are_errors():
    class Short:
        model_id = "s"

        def run_inference(self, batch, model):
            return [x for x in batch if x != "b"]

    assert inference.answers(Short(), ["a", "b", "c"], None) == [("a", None), (None, "ValueError: 0 outputs for 1 examples"), ("c", None)]


def test_predictions(spark):
    handler = shouting("t")
    out = predictions.build(messages(spark, ["hello"]), handler).first().value
    assert out == "Input: \nhello, \n\n\nOutput: \nHELLO"
    features = spark.createDataFrame([(7, "red")], "id int, colour string")
    out = predictions.build(messages(spark, [{"id": 7}]), handler, features=features, key="id").first().value
    assert "red" in out


def test_model_learns_the_rule(spark, tmp_path):
    from rivulet.sources.synthetic import model_samples

    model, held = inference.MaintenanceModel.train(model_samples(spark, 2000))
    assert 300 < held.count() < 500
    scored = model.predict(held.withColumn("rule", F.col("needs_maintenance").cast("int")))
    right = scored.where("rule = needs_maintenance").count() / scored.count()
    assert right > 0.85
    model.save(str(tmp_path / "m"))
    again = inference.MaintenanceModel.load(str(tmp_path / "m"))
    assert again.predict(held).select("needs_maintenance").collect() == model.predict(held).select("needs_maintenance").collect()


def test_logs_batches_and_dead_letters(spark, tmp_path):
    lines = messages(spark, [f"line {i}" for i in range(25)]).coalesce(1)
    logs.deliver(lines, lambda body: 400 if b"" == body else 200, str(tmp_path / "d"), str(tmp_path / "r"), logs.Config(batch=10))
    report = spark.read.parquet(str(tmp_path / "r")).collect()
    assert sorted(len(r.events) for r in report) == [5, 10, 10]
    assert {e["event"] for r in report for e in sinks.unpack(r.body)} == {f"line {i}" for i in range(25)}
    for number in (0, 1, 1):  # the last is run again: neither posted nor written twice
        logs.deliver(lines, lambda body: 503, str(tmp_path / "d2"), str(tmp_path / "r2"), logs.Config(batch=10, tries=2), number)
    assert {(r.batch_id, r["count"]) for r in spark.read.parquet(str(tmp_path / "d2")).groupBy("batch_id").count().collect()} == {(0, 25), (1, 25)}


def test_readers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("household_key,day\n1,NaN\n2,5\n")
    rows = read_csv(spark, str(tmp_path / "a.csv"), schemas.T.StructType.fromDDL("household_key string, day string"))
    assert [tuple(r) for r in rows.collect()] == [("1", None), ("2", "5")]
    (tmp_path / "b.jsonl").write_text('{"vehicle_id": "1"}\nbad\n\n')
    good, bad = read_json_lines(spark, str(tmp_path / "b.jsonl"), schemas.MAINTENANCE)
    assert good.count() == 1
    assert [r.line for r in bad.collect()] == ["bad"]


def test_schema_descriptions():
    fields = [{"name": "a", "type": "STRING", "mode": "REQUIRED"}, {"name": "b", "type": "RECORD", "mode": "REPEATED", "fields": [{"name": "c", "type": "INT64"}]}]
    assert schemas.from_warehouse_json(json.dumps({"schema": fields})).simpleString() == "struct<a:string,b:array<struct<c:bigint>>>"
    assert schemas.from_warehouse_string(schemas.MAINTENANCE_ANALYTICS).names[-1] == "needs_maintenance"


# ------------------------------------------------------------------------ streams


def put(spark, folder, objects, time):
    messages(spark, objects, time).coalesce(1).write.mode("append").parquet(str(folder))


def test_metrics_stream_equals_batch(spark, tmp_path):
    source = tmp_path / "in"
    event = lambda v, t, temp: {"vehicle_id": v, "timestamp": t, "temperature": temp, "rpm": 1, "vibration": 0.5, "fuel_level": 1, "mileage": 10}
    put(spark, source, [event("1000", "2025-01-18T15:56:01Z", 50), event("1000", "2025-01-18T15:56:59Z", 70), event("1001", "2025-01-18T15:57:00Z", 60)], T0)
    put(spark, source, [event("1000", "2025-01-18T16:30:00Z", 1)], T0)  # moves the watermark on
    query = runner.append_stream(iot.build(read_messages(spark, f"parquet:{source}", stream=True, maxFilesPerTrigger="1"), dimension(spark)), str(tmp_path / "out"), str(tmp_path / "cp"), once=True)
    query.awaitTermination(120)
    batch = iot.build(read_messages(spark, f"parquet:{source}"), dimension(spark)).where("latest_timestamp < timestamp '2025-01-18 16:00:00'")
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect())) == sorted(map(tuple, batch.collect()))


def test_left_join_stream(spark, tmp_path):
    for name, objects in (("t", transactions()), ("c", coupons()[:1])):
        put(spark, tmp_path / name, objects, T0)
    for name in ("t", "c"):
        put(spark, tmp_path / name, [{"household_key": "0", "transaction_id": "0", "product_id": "0", "coupon_upc": "0"}], "2025-01-18 18:00:00")
    read = lambda n: read_messages(spark, f"parquet:{tmp_path / n}", stream=True, maxFilesPerTrigger="1")
    query = runner.append_stream(cdp.build(read("t"), read("c")), str(tmp_path / "out"), str(tmp_path / "cp"), once=True)
    query.awaitTermination(120)
    found = spark.read.parquet(str(tmp_path / "out")).where("transaction_id = '27'").collect()
    assert {(r.product_id, r.coupon_upc) for r in found} == {("941769", "10000085364"), ("910635", "10000085364")}


def test_stateful_processor(spark, tmp_path):
    rows = [("a", "2025-01-18 15:56:01", 50, 0.5, 10), ("a", "2025-01-18 15:56:30", 70, 0.1, 21)]
    schema = "vehicle_id string, event_time timestamp, temperature int, vibration double, mileage int"
    make = lambda r: spark.createDataFrame(r, "v string, t string, x int, b double, m int").select(F.col("v").alias("vehicle_id"), F.to_timestamp("t").alias("event_time"), F.col("x").alias("temperature"), F.col("b").alias("vibration"), F.col("m").alias("mileage"))
    make(rows).coalesce(1).write.parquet(str(tmp_path / "in"))
    make([("b", "2025-01-18 17:00:00", 1, 0.1, 1)]).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")).withWatermark("event_time", "0 seconds")
    found = []
    query = runner.start(stateful.stateful_metrics(source), str(tmp_path / "cp"), lambda df, _: found.extend(df.collect()), once=True)
    query.awaitTermination(180)
    assert [(r.vehicle_id, r.max_temperature, r.max_vibration, r.avg_mileage) for r in found] == [("a", 70.0, 0.5, 15)]


def test_command_line(spark, tmp_path):
    source = tmp_path / "in"
    put(spark, source, ["hello"], T0)
    args = cli.parser().parse_args(["generation", "--messages", f"parquet:{source}", "--responses", f"text:{tmp_path / 'out'}", "--model", "m", "--handler", "test_pipelines:shouting", "--checkpoint", str(tmp_path / "cp"), "--once"])
    for query in cli.launch(spark, args):
        query.awaitTermination(120)
    assert "HELLO" in spark.read.text(str(tmp_path / "out")).first().value
    with pytest.raises(ValueError, match="module:factory"):
        cli.factory("nothing")


def test_command_line_keeps_failing_examples_apart(spark, tmp_path):
    put(spark, tmp_path / "in", ["hello", "bad"], T0)
    args = cli.parser().parse_args(["generation", "--messages", f"parquet:{tmp_path / 'in'}", "--responses", f"text:{tmp_path / 'out'}", "--model", "m", "--handler", "test_pipelines:half_deaf", "--deadletter", str(tmp_path / "dead"), "--checkpoint", str(tmp_path / "cp"), "--once"])
    for query in cli.launch(spark, args):
        assert query.awaitTermination(120)
    assert "HELLO" in spark.read.text(str(tmp_path / "out")).first().value
    assert [(r.input_data, r.error_message) for r in spark.read.parquet(str(tmp_path / "dead")).collect()] == [("bad", "KeyError: 'bad'")]


def half_deaf(model_id):
    class Deaf:
        def generate(self, text, max_length):
            if text == "bad":
                raise KeyError(text)
            return text.upper()

    return inference.TemplateHandler(Deaf, model_id)


def test_command_line_early_panes(spark, tmp_path):
    for name, objects in (("t", transactions()), ("c", coupons()[:1])):
        put(spark, tmp_path / name, objects, T0)
    last = {"household_key": "0", "transaction_id": "0", "product_id": "0", "coupon_upc": "0"}
    for name in ("t", "c"):
        put(spark, tmp_path / name, [last], "2025-01-18 18:00:00")
    args = cli.parser().parse_args(["cdp", "--transactions", f"parquet:{tmp_path / 't'}", "--coupons", f"parquet:{tmp_path / 'c'}", "--table", str(tmp_path / "out"), "--errors", str(tmp_path / "e"), "--checkpoint", str(tmp_path / "cp"), "--early", "--once"])
    for query in cli.launch(spark, args):
        assert query.awaitTermination(240)
    found = spark.read.parquet(str(tmp_path / "out")).collect()
    assert {(r.product_id, r.coupon_upc) for r in found} == {("941769", "10000085364"), ("910635", "10000085364"), ("0", "0")}


def test_command_line_tables(spark, tmp_path):
    source = tmp_path / "in"
    put(spark, source, [TAXI, TAXI | {"point_idx": "x"}, "{cut", TAXI | {"ride_status": "new", "passenger_count": 3}], T0)
    args = cli.parser().parse_args(["etl", "--messages", f"parquet:{source}", "--table", str(tmp_path / "t"), "--errors", str(tmp_path / "e"), "--checkpoint", str(tmp_path / "cp"), "--once"])
    for query in cli.launch(spark, args):
        query.awaitTermination(120)
    assert [(r.ride_id, r.point_idx, r.passenger_count) for r in sinks.read_keyed(spark, str(tmp_path / "t")).collect()] == [("a", 3, 3)]
    assert spark.read.parquet(str(tmp_path / "e")).count() == 2
    clicks = tmp_path / "clicks"
    put(spark, clicks, [{"prev": "a", "curr": "b", "type": "link", "n": 7}, "{cut"], T0)
    options = ["clickstream", "--messages", f"parquet:{clicks}", "--table", str(tmp_path / "c"), "--deadletter", str(tmp_path / "d"), "--checkpoint", str(tmp_path / "cp2"), "--once"]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        cli.launch(spark, cli.parser().parse_args(options))
    spark.createDataFrame([], schemas.CLICKSTREAM).write.parquet(str(tmp_path / "c"))
    for query in cli.launch(spark, cli.parser().parse_args(options)):
        query.awaitTermination(120)
    assert spark.read.schema(schemas.DEAD_LETTER).parquet(str(tmp_path / "d")).count() == 1

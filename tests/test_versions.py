"""As-of enrichment against brute force, on a hot key and on streams."""

import random

from pyspark.sql import functions as F

from rivulet.operators import versions
from rivulet.streaming import runner


def frames(spark, e, v, ntz=False):
    kind = "timestamp_ntz" if ntz else "timestamp"
    time = lambda df: df.withColumn("t", F.col("t").cast(kind))
    return time(spark.createDataFrame(e, "k string, t string, id int, x int")), time(spark.createDataFrame(v, "k string, t string, x int, y string"))


def stamp(seconds):
    return f"2025-01-{18 + seconds // 86400:02d} {seconds // 3600 % 24:02d}:{seconds // 60 % 60:02d}:{seconds % 60:02d}"


def brute(e, v):
    out = []
    for k, t, i, x in e:
        old = [(vt, vx is not None, vx, vy) for vk, vt, vx, vy in v if vk is not None and vt is not None and vk == k and t is not None and vt <= t]
        best = max(old, key=lambda r: (r[0], r[1], r[2] or 0, r[3])) if old else None
        out.append((k, t, i, x, best[2] if best else None, best[3] if best else None, best[0] if best else None))
    return sorted(out, key=repr)


def test_as_of_equals_brute_force(spark):
    r = random.Random(5)
    keys = ["a", "a", "a", "b", "c", None]
    e = [(r.choice(keys), r.choice([None, *map(stamp, range(0, 200000, 977))]), i, i % 3) for i in range(400)]
    v = [(r.choice(keys), r.choice([None, *map(stamp, range(0, 200000, 977))]), r.choice([None, 1, 2]), f"y{i % 50}") for i in range(150)]
    e.append(e[0])
    for ntz in (False, True):
        events, dimension = frames(spark, e, v, ntz)
        for bucket in ("1 hour", "7 days", "30 seconds"):
            got = versions.as_of(events, dimension.withColumnRenamed("x", "vx"), "k", "t", bucket=bucket)
            assert got.columns == ["k", "t", "id", "x", "vx", "y", "version_time"]
            rows = [(x.k, x.t and str(x.t), x.id, x.x, x.vx, x.y, x.version_time and str(x.version_time)) for x in got.collect()]
            assert sorted(rows, key=repr) == brute(e, v), (ntz, bucket)
    empty = versions.as_of(events, dimension.limit(0).withColumnRenamed("x", "vx"), "k", "t")
    assert empty.count() == len(e) and empty.where("version_time is not null").isEmpty()
    assert versions.as_of(events.limit(0), dimension.withColumnRenamed("x", "vx"), "k", "t").isEmpty()


def test_hot_key_makes_no_product(spark):
    events = spark.range(100_000).select(F.lit("hot").alias("k"), F.timestamp_seconds(F.col("id") * 7).alias("t"), "id")
    dimension = spark.range(20_000).select(F.lit("hot").alias("k"), F.timestamp_seconds(F.col("id") * 35 + 3).alias("t"), F.col("id").alias("n"))
    found = versions.as_of(events, dimension, "k", "t", columns=["n"])
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    assert found.where(~F.col("n").eqNullSafe(F.when(F.col("id") * 7 >= 3, F.floor((F.col("id") * 7 - 3) / 35)))).isEmpty()
    assert found.count() == 100_000


def put(spark, folder, rows, schema):
    df = spark.createDataFrame(rows, schema)
    df.withColumn("t", F.to_timestamp("t")).coalesce(1).write.mode("append").parquet(str(folder))


def test_stream_takes_versions_that_arrived(spark, tmp_path):
    e, v = "k string, t string, id int", "k string, t string, x int, y string"
    put(spark, tmp_path / "v", [("a", stamp(10), 1, "p"), ("a", stamp(10), 2, "o"), ("a", stamp(50), 3, "q"), ("b", stamp(5), None, "n")], v)
    put(spark, tmp_path / "e", [("a", stamp(9), 1), ("a", stamp(49), 2), ("a", stamp(70), 3), ("b", stamp(5), 4), ("c", stamp(5), 5)], e)
    put(spark, tmp_path / "v", [("a", stamp(60), 4, "r"), ("z", stamp(90000), 1, "z")], v)
    put(spark, tmp_path / "e", [("a", stamp(70), 6), ("z", stamp(90000), 7)], e)
    put(spark, tmp_path / "v", [("a", stamp(61), 5, "s")], v)
    put(spark, tmp_path / "e", [("a", stamp(65), 8)], e)  # late, and yet answered by the newest version before the watermark
    read = lambda n, s: spark.readStream.schema(s.replace("t string", "t timestamp", 1)).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / n))
    found = []
    joined = versions.stream_as_of(read("e", e), read("v", v), "k", "t")
    query = runner.start(joined, str(tmp_path / "cp"), lambda df, i: found.extend(df.collect()), once=True)
    assert query.awaitTermination(240)
    got = {r.id: (r.x, r.y, r.version_time and str(r.version_time)) for r in found}
    assert got == {
        1: (None, None, None), 2: (2, "o", stamp(10)), 3: (3, "q", stamp(50)), 4: (None, "n", stamp(5)), 5: (None, None, None),
        6: (4, "r", stamp(60)), 7: (1, "z", stamp(90000)), 8: (5, "s", stamp(61)),
    }

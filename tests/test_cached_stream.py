"""The cache of a stream: answers do not depend on its cuts, and the state is let go."""

import random

import pytest
from pyspark.sql import functions as F

from restframe.streaming.cache_state import CachedStream

SCHEMA = "id long, key string, secs long"


def accesses(n, seed=3):
    rng = random.Random(seed)
    return [(i, rng.choice(["hot"] * 4 + [f"k{j}" for j in range(4)] + [None]), i * 330 + rng.randrange(3000)) for i in range(n)]


def brute(rows, ttl=3600):
    want, loaded = {}, {}
    for i, key, at in sorted(rows, key=lambda r: (r[2], r[0])):
        want[i] = key in loaded and at - loaded[key] <= ttl
        if not want[i]:
            loaded[key] = at
    return want


def fed(spark, cache, tmp_path, parts, name="in"):
    for part in parts:
        frame = spark.createDataFrame(part, SCHEMA).coalesce(1)
        frame.select("id", "key", F.timestamp_seconds("secs").alias("ts")).write.mode("append").parquet(f"{tmp_path}/{name}")
        source = spark.readStream.schema("id long, key string, ts timestamp").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/{name}")
    cache.start(source, f"{tmp_path}/log").trigger(availableNow=True).start().awaitTermination()


def cached(tmp_path, **options):
    return CachedStream("key", "ts", "id", 3600_000, options.pop("lateness", "1 hour"), f"{tmp_path}/out", f"{tmp_path}/state", **options)


def answered(spark, cache):
    rows = cache.answers(spark, "key string, ident long").collect()
    assert len({r.id for r in rows}) == len(rows)
    return {r.id: r.hit for r in rows}


@pytest.mark.parametrize("cuts", [1, 5])
def test_answers_do_not_depend_on_the_cuts(spark, tmp_path, cuts):
    rows = accesses(150)
    cache = cached(tmp_path, closing=F.col("id") < 0)
    size = -(-len(rows) // cuts)
    parts = [rows[i : i + size] for i in range(0, len(rows), size)]
    fed(spark, cache, tmp_path, [*parts, [(-1, "end", 10**7)]])
    assert answered(spark, cache) == brute(rows)


def test_any_order_within_a_long_lateness(spark, tmp_path):
    rows = accesses(120, seed=5)
    shuffled = random.Random(1).sample(rows, len(rows))
    cache = cached(tmp_path, lateness="2 days")
    fed(spark, cache, tmp_path, [shuffled[i::3] for i in range(3)])
    cache.finish(spark)
    assert answered(spark, cache) == brute(rows)


def test_state_is_dropped_during_the_run(spark, tmp_path):
    rows = [(i, f"k{i // 20}", i * 600) for i in range(120)]  # a key is used for a while and never again
    cache = cached(tmp_path)
    waits, keys = [], []
    for i in range(0, 120, 20):
        fed(spark, cache, tmp_path, [rows[i : i + 20]])
        waits.append(spark.read.parquet(f"{tmp_path}/state/{i // 20}/waiting").count())
        keys.append(spark.read.parquet(f"{tmp_path}/state/{i // 20}/loaded").count())
    assert max(waits) <= 7 and max(keys) <= 2
    # Only the last states are there.
    assert {p.name for p in (tmp_path / "state").iterdir()} == {"4", "5"}
    cache.finish(spark)
    assert answered(spark, cache) == brute(rows)


def test_a_repeated_micro_batch_and_a_stream_that_goes_on(spark, tmp_path):
    rows = accesses(90, seed=8)
    cache = cached(tmp_path)
    fed(spark, cache, tmp_path, [rows[:30], rows[30:60]])
    # The second micro-batch again, as after a failure before it was recorded.
    batch = spark.createDataFrame(rows[30:60], SCHEMA).select(
        F.col("key"), F.col("id").alias("ident"), (F.col("secs") * 1_000_000).alias("us"), F.lit(False).alias("closes")
    )
    cache._step(batch, 1)
    cache.finish(spark)
    first = answered(spark, cache)
    assert first == brute(rows[:60])
    fed(spark, cache, tmp_path, [rows[60:]])
    cache.finish(spark)
    got = answered(spark, cache)
    assert len(got) == 90 and {i: got[i] for i in first} == first


def test_accesses_that_are_too_late(spark, tmp_path):
    cache = cached(tmp_path, lateness="10 minutes")
    fed(spark, cache, tmp_path, [[(0, "a", 0), (1, "a", 7200)], [(2, "a", 60), (3, "b", 100), (4, "a", 9000)], [(5, None, 9001)]])
    cache.finish(spark)
    # The late access of a is answered at the watermark it missed, 6,600; all are answered.
    assert answered(spark, cache) == {0: False, 2: False, 1: True, 3: False, 4: True, 5: False}


def test_an_empty_stream(spark, tmp_path):
    cache = cached(tmp_path)
    cache.finish(spark)
    fed(spark, cache, tmp_path, [[]])
    cache.finish(spark)
    assert not (tmp_path / "state").exists() or answered(spark, cache) == {}

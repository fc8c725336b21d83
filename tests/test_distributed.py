"""Operators that cut lanes into slices, against plain Python over the whole lane."""

import itertools
import json
import random
from collections import OrderedDict, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from restframe.operators.batches import make_requests, plan_batches, plan_byte_flushes, with_elements
from restframe.operators import greedy
from restframe.operators.cache import access_ttl, lru, smaller_before, write_ttl
from restframe.operators.greedy import chain_of, greedy_marks
from restframe.operators.sequence import last_value_before, number_rows, number_runs
from restframe.operators.skew import key_salts, salted_join
from restframe.operators.tokens import assign_tokens
from restframe.session import keep
from restframe.spec import SinkSpec

SPEC = SinkSpec(url="http://s", format="raw")


@pytest.fixture(scope="module")
def stream(spark):
    """One lane holds a third of all rows; values repeat, some are null."""
    rng = random.Random(5)
    rows = []
    for i in range(900):
        lane = 0 if i % 3 == 0 else rng.randrange(1, 5)
        rows.append((i, lane, i // 40, rng.choice(["a", "A", "b", None]), rng.randrange(0, 50)))
    return rows, spark.createDataFrame(rows, "id long, lane long, slice long, v string, size long").cache()


def by_lane(rows):
    lanes = defaultdict(list)
    for row in sorted(rows):
        lanes[row[1]].append(row)
    return lanes


def test_number_rows(stream):
    rows, frame = stream
    got = {r.id: r.seq for r in number_rows(frame, ["lane"], ["slice"], ["id"]).collect()}
    want = {row[0]: i for lane in by_lane(rows).values() for i, row in enumerate(lane)}
    assert got == want


def test_number_rows_keeps_null_lanes(spark):
    frame = spark.createDataFrame([(1, None), (2, None), (3, "x")], "id long, lane string").withColumn("s", F.lit(0))
    assert {r.id: r.seq for r in number_rows(frame, ["lane"], ["s"], ["id"]).collect()} == {1: 0, 2: 1, 3: 0}


@pytest.mark.parametrize("inclusive", [False, True])
def test_last_value_before(stream, inclusive):
    rows, frame = stream
    got = last_value_before(frame, ["lane"], ["slice"], ["id"], F.col("v"), "last", inclusive)
    want = {}
    for lane in by_lane(rows).values():
        last = None
        for row in lane:
            before, last = last, row[3] if row[3] is not None else last
            want[row[0]] = last if inclusive else before
    assert {r.id: r["last"] for r in got.collect()} == want


def test_number_runs(stream):
    rows, frame = stream
    got = number_runs(frame, ["lane"], ["slice"], ["id"], F.lower("v"))
    want = {}
    for lane in by_lane(rows).values():
        start, previous = 0, object()
        for i, row in enumerate(lane):
            value = row[3] and row[3].lower()
            if value != previous:
                start, previous = i, value
            want[row[0]] = (i, start)
    assert {r.id: (r.seq, r.run_seq) for r in got.collect()} == want


@pytest.mark.parametrize(("reach", "max_rows"), [(100, 7), (0, 3), (10_000, 1000), (60, 1)])
def test_byte_flushes(stream, reach, max_rows):
    rows, frame = stream
    spec = SPEC.replace(max_batch_bytes=max(reach, 1), max_batch_size=max_rows)
    elements = with_elements(frame.withColumn("text", F.expr("repeat('x', size)")), spec, ["text"])
    got = plan_byte_flushes(elements, spec, ["lane"], "slice", ["id"])
    want = {}
    for lane in by_lane(rows).values():
        start, held, count = 0, 0, 0
        for i, row in enumerate(lane):
            if i and (held + row[4] > spec.max_batch_bytes or count == max_rows):
                start, held, count = i, 0, 0
            held, count = held + row[4], count + 1
            want[row[0]] = start
    assert {r.id: r.flush_seq for r in got.collect()} == want


@pytest.mark.parametrize("reach", [0, 3, 17, 100, 5000])
def test_greedy_marks(stream, reach):
    rows, frame = stream
    points = frame.withColumn("at", F.col("id") * 2)
    got = greedy_marks(points, ["lane"], "slice", ["id"], "at", "at", reach)
    want = {}
    for lane in by_lane(rows).values():
        mark = None
        for row in lane:
            if mark is None or 2 * row[0] > mark + reach:
                mark = 2 * row[0]
            want[row[0]] = mark
    marks = got.collect()
    assert {r.id: r.mark_lo for r in marks} == want
    assert all(r.is_mark == (2 * r.id == r.mark_lo) for r in marks)


def test_chains_compose_as_their_blocks_do():
    rng = random.Random(9)
    for _ in range(400):
        reach, max_rows = rng.choice([0, 5, 40, 1000]), rng.choice([None, 1, 3, 50])
        sizes = [rng.randrange(0, 12) for _ in range(rng.randrange(2, 60))]
        his = np.cumsum(sizes)
        rows = np.array([his - sizes, his, np.arange(len(sizes))]).T
        cuts = sorted({0, len(rows), *[rng.randrange(len(rows) + 1) for _ in range(rng.randrange(8))]})
        parts = [chain_of(rows[a:b], reach, max_rows) for a, b in itertools.pairwise(cuts)]
        while len(parts) > 1:  # composed in any grouping
            at = rng.randrange(len(parts) - 1)
            parts[at : at + 2] = [parts[at].then(parts[at + 1])]
        for entry in [(-(10**15), -(10**15)), (-rng.randrange(1, 50), -rng.randrange(1, 5))]:
            lo, at = entry
            for row_lo, row_hi, row_at in rows.tolist():
                if row_hi > lo + reach or (max_rows is not None and row_at >= at + max_rows):
                    lo, at = row_lo, row_at
            got = parts[0].after(np.int64(entry[0]), np.int64(entry[1]))
            assert (int(got[0]), int(got[1])) == (lo, at)


@pytest.mark.parametrize("reach", [50, 3000])
def test_a_hot_lane_is_a_tree(spark, monkeypatch, reach):
    """Half of the rows in one lane, a reach of many blocks: no node has more than FAN children, no chain is longer than a reach."""
    monkeypatch.setattr(greedy, "FAN_BITS", 2)
    levels = []
    monkeypatch.setattr(greedy, "kept_table", lambda df, label: levels.append(keep(df, label)) or levels[-1])
    frame = spark.range(3000).selectExpr("id", "if(id % 2 = 0, 0, id % 7) as lane", "id div 10 as block", "id * 3 as at")
    got = greedy_marks(frame, ["lane"], "block", ["id"], "at", "at", reach).collect()
    want, marks = {}, {}
    for i in range(3000):
        lane = 0 if i % 2 == 0 else i % 7
        if lane not in marks or 3 * i > marks[lane] + reach:
            marks[lane] = 3 * i
        want[i] = marks[lane]
    assert {r.id: r.mark_lo for r in got} == want and len(got) == 3000
    assert len(levels) >= 5
    for level in levels[:-1]:
        assert level.groupBy("lane", F.shiftright("_node", 2)).count().agg(F.max("count")).first()[0] <= 4
    for level in levels:
        assert level.agg(F.max(F.size("his"))).first()[0] <= reach // 3 + 2


@pytest.mark.parametrize("kind", ["date", "timestamp", "int"])
def test_blocks_of_other_kinds(spark, kind):
    frame = spark.range(60).selectExpr("id", "0 as lane", f"cast({'id div 6' if kind == 'int' else 'timestamp_seconds(id * 43200)'} as {kind}) as block")
    got = {r.id: r.mark_lo for r in greedy_marks(frame, ["lane"], "block", ["id"], "id", "id", 9).collect()}
    assert got == {i: i - i % 10 for i in range(60)}


def test_blocks_around_nought(spark, monkeypatch):
    monkeypatch.setattr(greedy, "FAN_BITS", 1)
    frame = spark.range(-60, 60).selectExpr("id", "0 as lane", "id div 7 as block")
    got = {r.id: r.mark_lo for r in greedy_marks(frame, ["lane"], "block", ["id"], "id", "id", 9).collect()}
    assert got == {i: i - (i + 60) % 10 for i in range(-60, 60)}


def test_smaller_before():
    rng = random.Random(2)
    for n in (0, 1, 2, 31, 32, 33, 64, 500, 1500):
        values = [rng.randrange(max(1, n // 2)) for _ in range(n)]
        assert smaller_before(np.array(values, np.int64)).tolist() == [sum(w < v for w in values[:i]) for i, v in enumerate(values)]


@pytest.mark.parametrize("block_rows", [16, 1 << 18])
def test_lru_of_many_keys(spark, block_rows):
    """A cache of 100,000 keys has rows as narrow as one of three: four numbers besides the access itself."""
    rng = random.Random(12)
    rows = [(i, i % 2 or None, f"k{min(rng.randrange(900), rng.randrange(900))}" if i % 50 else None) for i in range(2500)]
    frame = spark.createDataFrame(rows, "id long, lane int, key string").withColumn("ts", F.timestamp_seconds(F.col("id") * 7))
    for max_rows in (40, 300, 100_000):
        want, caches = {}, defaultdict(OrderedDict)
        for i, lane, key in rows:
            cache = caches[lane]
            want[i] = key in cache
            cache[key] = None
            cache.move_to_end(key)
            if len(cache) > max_rows:
                cache.popitem(last=False)
        got = lru(frame, "lane", "key", "ts", ["id"], max_rows, "hour", block_rows=block_rows)
        assert {r.id: r.hit for r in got.collect()} == want


@pytest.fixture(scope="module")
def accesses(spark):
    rng = random.Random(7)
    rows = [(i, i % 2, "hot" if rng.random() < 0.34 else f"k{rng.randrange(8)}", i * rng.randrange(1, 900)) for i in range(600)]
    frame = spark.createDataFrame(rows, "id long, lane long, key string, secs long")
    return rows, frame.withColumn("ts", F.expr("timestamp_seconds(1700000000 + secs)")).cache()


def test_ttls(accesses):
    rows, frame = accesses
    access, write, seen, loaded = {}, {}, {}, {}
    for i, _, key, at in sorted(rows, key=lambda r: (r[3], r[0])):
        access[i] = key in seen and at - seen[key] <= 3600
        seen[key] = at
        write[i] = key in loaded and at - loaded[key] <= 3600
        if not write[i]:
            loaded[key] = at
    got = access_ttl(frame, "key", "ts", ["id"], F.expr("interval '1' hour"), "hour")
    assert {r.id: r.hit for r in got.collect()} == access
    for slice_of in ("hour", "day", "week"):
        got = write_ttl(frame, "key", "ts", ["id"], 3600_000, slice_of, "hour" if slice_of == "week" else "minute")
        assert {r.id: r.hit for r in got.collect()} == write


@pytest.mark.parametrize("max_rows", [1, 3, 50])
def test_lru(accesses, max_rows):
    rows, frame = accesses
    want, caches = {}, defaultdict(OrderedDict)
    for i, lane, key, _ in sorted(rows, key=lambda r: (r[3], r[0])):
        cache = caches[lane]
        want[i] = key in cache
        cache[key] = None
        cache.move_to_end(key)
        if len(cache) > max_rows:
            cache.popitem(last=False)
    got = lru(frame, "lane", "key", "ts", ["id"], max_rows, "hour")
    assert {r.id: r.hit for r in got.collect()} == want


@pytest.mark.parametrize("how", ["inner", "left", "right"])
def test_salted_join_is_the_join(spark, how):
    big = spark.range(3000).selectExpr("id", "case when id % 3 = 0 then 7 when id % 3 = 1 then id % 500 end as k")
    small = spark.range(600).selectExpr("id as k", "id * 2 as v").union(spark.sql("select 7L, -1L"))
    got = sorted(map(tuple, salted_join(big, small, ["k"], how).select("id", "k", "v").collect()), key=str)
    want = sorted(map(tuple, big.join(small, "k", how).select("id", "k", "v").collect()), key=str)
    assert got == want


def test_salted_join_spreads_the_hot_key(spark):
    big = spark.range(4000).selectExpr("id", "case when id % 2 = 0 then 7 else id end as k")
    small = spark.range(4000).selectExpr("id as k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = salted_join(big, small, ["k"]).withColumn("p", F.spark_partition_id())
        parts = joined.where("k = 7").groupBy("p").count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(parts) == 4 and sum(r["count"] for r in parts) == 2001


@pytest.mark.parametrize("how", ["inner", "left", "right"])
def test_salts_by_size(spark, how):
    """A key of 0.05% of the rows is spread too where a task is to get fewer, each key as its size needs."""
    big = spark.range(20_000).selectExpr("id", "case when id < 10 then 1 when id < 410 then 2 else id end as k")
    small = spark.range(21_000).selectExpr("id as k", "-id as v")
    counts = big.groupBy("k").agg(F.count("*").alias("n"))
    salts = {r._salted_hash: r._salts for r in key_salts(counts, ["k"], "n", 5).collect()}
    hashes = spark.range(1, 3).select(F.xxhash64("id").alias("h")).collect()
    assert [salts[r.h] for r in hashes] == [2, 80] and len(salts) == 2
    got = sorted(map(tuple, salted_join(big, small, ["k"], how, target_rows=5).select("id", "k", "v").collect()), key=str)
    assert got == sorted(map(tuple, big.join(small, "k", how).select("id", "k", "v").collect()), key=str)


def test_tokens(spark):
    tokens = spark.createDataFrame([("t1", 0, 100), ("t2", 50, 1), ("t3", 90_000, 10)], "token string, s long, expires_in int")
    tokens = tokens.select("token", F.timestamp_seconds("s").alias("issued"), "expires_in")
    asked = spark.createDataFrame([(-1,), (0,), (49,), (50,), (51,), (52,), (90_009,), (90_010,)], "s long")
    asked = asked.withColumn("ts", F.timestamp_seconds("s"))
    got = assign_tokens(asked, tokens, "ts", order=["s"])
    assert {r.s: r.token for r in got.collect()} == {
        -1: None, 0: "t1", 49: "t1", 50: "t2", 51: "t2", 52: None, 90_009: "t3", 90_010: None,
    }


PARTS = [(i, f"part {i}", round(1.25 * i, 2), f"2024-03-0{i} 08:0{i}:00") for i in range(1, 8)]


@pytest.fixture(scope="module")
def parts(spark):
    frame = spark.createDataFrame(PARTS, "id long, label string, price double, made string")
    return frame.withColumn("made", F.col("made").cast("timestamp")).withColumn("lane", F.lit(0))


def batches(frame, spec, columns, method=None):
    planned = plan_batches(with_elements(frame, spec, columns, method), spec, ["lane"], ["id"], ["id"])
    return make_requests(planned, spec, ["lane"]).orderBy("batch_seq").collect()


@pytest.mark.parametrize("size", [1, 2, 3, 7, 8, 100])
def test_batch_counts(parts, size):
    got = batches(parts, SPEC.replace(request_batch_size=size), ["label"])
    labels = [label for _, label, _, _ in PARTS]
    want = [labels[i : i + size] for i in range(0, len(labels), size)]
    assert [r.body[1:-1].split(",") for r in got] == want
    assert [r.n_records for r in got] == [len(group) for group in want]


@pytest.mark.parametrize("seed", range(6))
def test_method_runs(parts, seed):
    rng = random.Random(seed)
    verbs = [rng.choice(["POST", "PUT", "put", "Post"]) for _ in PARTS]
    got = batches(parts, SPEC.replace(request_batch_size=50), ["label"], F.element_at(F.array(*map(F.lit, verbs)), F.col("id").cast("int")))
    want = [(key, len(list(group))) for key, group in itertools.groupby(verbs, key=str.upper)]
    assert [(r.method, r.n_records) for r in got] == want


def test_json_body(parts):
    spec = SinkSpec(url="http://s", request_batch_size=1)
    bodies = [json.loads(r.body) for r in batches(parts, spec, ["id", "label", "price", "made"])]
    assert bodies == [[dict(zip(("id", "label", "price", "made"), row, strict=True))] for row in PARTS]

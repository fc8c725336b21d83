"""Queries on rows that only larger tables have, and steps whose cost must not outgrow them."""

import datetime
import glob
import resource

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from restframe import session
from restframe.operators import greedy
from restframe.operators.cache import write_ttl
from restframe.plans import QUERIES, sinks
from restframe.sources.transport import CallableTransport
from restframe.spec import SinkSpec


@pytest.fixture()
def orders_dir(spark, tmp_path):
    """Orders of customers whose numbers are those of larger tables."""
    rows = [
        (i, custkey, "FOP"[i % 3], 1.5 * i, datetime.datetime(1995, 1 + i % 12, 3, 4, 5, 6), f"{i % 5}-PRIORITY")
        for i, custkey in enumerate([1, 7999, 8000, 14_999, 900_001, 5_400_003])
    ]
    schema = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/orders.parquet")
    return str(tmp_path), rows


def test_typed_keys_hold_large_customer_numbers(spark, orders_dir):
    path, rows = orders_dir
    got = QUERIES["lookup_join_types"](spark, path).collect()
    assert sorted(map(tuple, got)) == [(r[0], f"order-{r[0]}", r[1], r[2]) for r in rows]


@pytest.fixture(scope="module")
def events_dir(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("events"))
    events = spark.range(300_000).selectExpr(
        "id as event_id", "timestamp_seconds(1704067200 + id * 9) as ts", "id % 5000 as user_id",
        "case id % 3 when 0 then 'view' when 1 then 'click' else 'error' end as event_type",
    )
    events.coalesce(1).write.parquet(f"{path}/events.parquet")
    return path


def parts_of(spark, monkeypatch, tmp_path, module, name, sf_dir):
    """The files, with their rows and row groups, that a query makes a stream of."""
    monkeypatch.setattr(module, "new_dir", lambda _, label: f"{tmp_path}/{label}")
    result = QUERIES[name](spark, sf_dir).collect()
    files = [pq.ParquetFile(p).metadata for p in sorted(glob.glob(f"{tmp_path}/*-parts/*.parquet"))]
    return result, [(m.num_rows, m.num_row_groups) for m in files]


def test_files_of_a_table_stream_are_even_and_read_by_many_tasks(spark, monkeypatch, tmp_path, events_dir):
    (got,), files = parts_of(spark, monkeypatch, tmp_path, sinks, "sink_table_stream", events_dir)
    assert got.epochs == 3 and got.records + got.rejected == 300_000
    assert len(files) == 3 and all(rows > 90_000 and groups > 1 for rows, groups in files), files


@pytest.mark.parametrize("keep_body", [False, True])
def test_answers_that_wait_hold_no_bodies(spark, keep_body):
    def memory_of_worker(request):
        pages = int(open("/proc/self/statm").read().split()[1])
        return {"status": 200, "body": str(pages * resource.getpagesize() >> 20)}

    bodies = spark.range(0, 4000, 1, 1).selectExpr("id", "repeat(md5(string(id)), 4000) as text")
    requests = bodies.selectExpr("string(id) as request_id", "'POST' as method", "'http://s' as url", "text as body", "id", "text")
    carry = ["id", "text"] if keep_body else ["id"]
    sent = CallableTransport(memory_of_worker, threads=1).fetch(requests, SinkSpec(url="http://s"), carry)
    digest = [F.md5("text").alias("digest")] if keep_body else []
    rows = sent.select("id", F.col("body").cast("int").alias("mb"), *digest).collect()
    assert sorted(r.id for r in rows) == list(range(4000))
    # All bodies together are 488 MB.
    used = [r.mb for r in rows]
    assert max(used) - used[0] < 300, (used[0], max(used))


def test_small_lanes_make_no_chains(spark, monkeypatch):
    """Expiry after write of keys with few accesses needs no block to know what came before it."""
    written = []

    def watched(df, label):
        kept = session.keep(df, label)
        written.append((label, kept.count()))
        return kept

    monkeypatch.setattr(greedy, "kept_table", watched)
    rows = [(i, i % 1500, i * 997 % 400_000) for i in range(6000)]
    rows += [(i, -1, i * 31 % 400_000) for i in range(6000, 6200)]
    frame = spark.createDataFrame(rows, "id long, key long, secs long").withColumn("at", F.timestamp_seconds("secs"))
    got = {r.id: r.hit for r in write_ttl(frame, "key", "at", ["id"], 100_000_000).collect()}
    want, loaded = {}, {}
    for i, key, at in sorted(rows, key=lambda r: (r[2], r[0])):
        want[i] = key in loaded and at - loaded[key] <= 100_000
        if not want[i]:
            loaded[key] = at
    assert got == want
    # One key holds over a thousandth of all rows; the slices of the others would be 5,700 chains.
    assert sum(n for _, n in written) <= 600, written


def test_batches_shuffle_columns_once_and_no_elements(spark, sf_dir):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frame = QUERIES["sink_batch_method_runs"](spark, sf_dir)
        lines = frame._jdf.queryExecution().executedPlan().toString().split("\n")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    made = [i for i, line in enumerate(lines) if "Exchange hashpartitioning(_group" in line]
    assert any("ReusedExchange" in line and "l_shipdate" in line for line in lines), "\n".join(lines)
    assert not any("to_json" in line for i in made for line in lines[i : i + 3])

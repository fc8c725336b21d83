"""The table forms: a streaming sink and calls of whole tables from SQL."""

import json
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fake_http import in_flight, post
from restframe.operators.lookup import observe_calls
from restframe.operators.request import distinct_requests
from restframe.session import keep
from restframe.sources.delivery import deliver, observe_delivery, sink_metrics
from restframe.sources.http_sink import as_elements, register_sink
from restframe.sources.sqlapi import register_fetch_table
from restframe.sources.transport import CallableTransport
from restframe.spec import LookupSpec, SinkSpec
from restframe.streaming.enrich import deliver_stream

SPEC = LookupSpec(url="http://s", schema="id int")


@pytest.fixture(scope="module", autouse=True)
def in_workers(spark):
    spark.sparkContext.addPyFile(str(Path(__file__).parent / "fake_http.py"))


def test_eight_calls_of_a_sql_lookup_are_under_way(spark):
    register_fetch_table(spark, "fetch_all", SPEC.replace(async_polling=True, request_threads=8), in_flight, carry="id bigint, note string")
    rows = spark.range(64).coalesce(1).selectExpr("id", "if(id = 7, null, 'n') as note", "'GET' as method", "'http://s' as url", "'' as body")
    rows.createOrReplaceTempView("asked")
    got = spark.sql("select id, note, status, headers, cast(body as int) as most, n_attempts from fetch_all(table(asked))").collect()
    assert sorted(r.id for r in got) == list(range(64)) and {(r.status, r.n_attempts, r.headers) for r in got} == {(200, 1, None)}
    assert max(r.most for r in got) >= 8
    assert [r.id for r in got if r.note is None] == [7]


def test_no_rows_and_no_carried_columns(spark):
    register_fetch_table(spark, "fetch_none", SPEC, in_flight)
    spark.sql("select 'GET' as method, 'http://s' as url, '' as body limit 0").createOrReplaceTempView("nothing")
    spark.sql("select 'GET' as method, 'http://s' as url, map('a', 'b') as headers").createOrReplaceTempView("something")
    assert spark.sql("select * from fetch_none(table(nothing))").collect() == []
    assert [r.status for r in spark.sql("select * from fetch_none(table(something))").collect()] == [200]


def start(spark, tmp_path, name="state", **options):
    source = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    writer = as_elements(source, SinkSpec(url="http://s")).writeStream.format("http-sink")
    options = {"url": f"http://{tmp_path}/keys", "format": "json", "sender": "fake_http:keep_key", "log-path": f"file://{tmp_path}/log"} | options
    writer = writer.options(**options).option("checkpointLocation", str(tmp_path / name))
    return writer.trigger(availableNow=True).start()


def test_stream_of_epochs(spark, tmp_path):
    register_sink(spark)
    for i in range(3):
        spark.range(i * 10, i * 10 + 10).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    start(spark, tmp_path).awaitTermination()
    logs = {p.name: json.loads(p.read_text()) for p in (tmp_path / "log").iterdir()}
    assert sorted(logs) == [f"epoch-{i}.json" for i in range(3)]
    assert {(x["records"], x["requests"], x["requests_failed"], x["rejected"]) for x in logs.values()} == {(10, 1, 0, 0)}
    keys = (tmp_path / "keys").read_text().split()
    assert len(set(keys)) == 3
    # The last epoch again, as after a failure before it was recorded: its keys are repeated, and its log is its own.
    for path in (tmp_path / "state" / "commits").iterdir():
        if path.name.strip(".").startswith("2"):
            path.unlink()
    start(spark, tmp_path).awaitTermination()
    assert Counter((tmp_path / "keys").read_text().split()) == Counter({keys[0]: 1, keys[1]: 1, keys[2]: 2})
    assert len(list((tmp_path / "log").iterdir())) == 3
    # Another query on the same data is another delivery.
    start(spark, tmp_path, "other").awaitTermination()
    assert len(set((tmp_path / "keys").read_text().split())) == 6


def test_a_stream_that_must_not_fail(spark, tmp_path):
    register_sink(spark)
    spark.range(5).coalesce(1).write.parquet(str(tmp_path / "in"))
    with pytest.raises(Exception, match="requests_failed"):
        start(spark, tmp_path, sender="fake_http:refuse", **{"fail-on-error": "true"}).awaitTermination()


def test_log_of_a_table_write(spark, tmp_path):
    register_sink(spark)
    rows = as_elements(spark.range(9), SinkSpec(url="http://s")).withColumn("method", F.when(F.rand(1) >= 0, "GET"))
    options = {"url": "http://s", "format": "json", "sender": "fake_http:post", "log-path": str(tmp_path / "log")}
    rows.write.format("http-sink").mode("append").options(**options).save()
    (log,) = [json.loads(p.read_text()) for p in (tmp_path / "log").iterdir()]
    assert (log["records"], log["rejected"]) == (0, 9)


def test_counters_of_a_batch_and_of_a_stream_are_observed(spark, tmp_path):
    spec = SinkSpec(url="http://s", request_batch_size=3)
    rows = spark.range(30).withColumn("lane", F.lit(0))
    args = (spec, CallableTransport(post), ["lane"], ["id"], ["id"])
    log, seen = observe_delivery(deliver(rows, *args, columns=["id"]))
    kept = keep(log)
    want = sink_metrics(kept).drop("url").first().asDict()
    assert seen.get == want and want["requests"] == 10 and want["requests_failed"] == 1
    for i in range(2):
        rows.where(f"id div 15 = {i}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    told = {}
    source = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    writer = deliver_stream(source, spec, CallableTransport(post), str(tmp_path / "out"), str(tmp_path / "state"),
                            ["lane"], ["id"], ["id"], observed=told.__setitem__, columns=["id"])
    writer.trigger(availableNow=True).start().awaitTermination()
    assert sorted(told) == [0, 1] and sum(x["records"] for x in told.values()) == 30
    assert sum(x["requests_failed"] for x in told.values()) == 1 and {x["requests"] for x in told.values()} == {5}


def test_calls_are_observed(spark):
    requests, _ = distinct_requests(spark.range(20).selectExpr("id % 4 as k"), SPEC, {"k": "k"})
    sent, seen = observe_calls(requests)
    assert sent.count() == 4
    assert seen.get == {"probe_rows": 20, "calls": 4, "calls_saved": 16}

"""Lookup joins, transports, sinks and streams end to end, without a network."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

import fake_http
from fake_http import CountingHook, double, fake_http_post
from restframe import LookupSpec, SinkSpec, deliver, lookup_join
from restframe.operators.request import plan_requests
from restframe.session import keep, new_dir
from restframe.sources.delivery import redrive, sink_metrics
from restframe.sources.http_sink import as_elements, register_sink
from restframe.sources.sqlapi import create_lookup_view
from restframe.sources.transport import (
    CallableTransport,
    HttpTransport,
    ReplayTransport,
    StoreTransport,
    TableTransport,
    bearer_token,
    make_opener,
)
from restframe.streaming.cache_state import CachedStream, cache_stream
from restframe.streaming.enrich import deliver_stream, enrich_stream

SPEC = LookupSpec(url="http://h/x", schema="id bigint, twice bigint", max_retries=2, continue_on_error=True)


@pytest.fixture(scope="module")
def helper(spark):
    spark.sparkContext.addPyFile(str(Path(fake_http.__file__)))


pytestmark = pytest.mark.usefixtures("helper")


@pytest.fixture(scope="module")
def probe(spark):
    return spark.range(10, 40).selectExpr("id as n", "id % 10 as cust")


def test_http_transport(probe, helper):
    names = ["http-status-code", "http-completion-state", "error-string", "http-headers"]
    http = HttpTransport(opener=fake_http.Opener, sleep=fake_http.no_sleep, parallelism=3)
    joined = lookup_join(probe, SPEC, {"id": "cust"}, http, select=["twice"], metadata=names)
    got = {r.n: tuple(r)[2:6] for r in joined.collect()}
    assert len(got) == 30
    assert got[10] == (0, 200, "SUCCESS", None)
    assert got[11] == (2, 200, "SUCCESS", None)
    assert got[12] == (4, 200, "SUCCESS", None)
    assert got[13] == (None, 400, "HTTP_ERROR_STATUS", "bad id")
    tags = joined.where("n = 10").select(F.col("`http-headers`")["Tag"]).first()[0]
    assert tags == ["a", "b"]


def test_retries_run_out(probe, helper):
    http = HttpTransport(opener=fake_http.Opener, sleep=fake_http.no_sleep)
    spec = SPEC.replace(max_retries=0)
    names = ["http-completion-state", "error-string"]
    joined = lookup_join(probe, spec, {"id": "cust"}, http, select=["twice"], metadata=names)
    got = {r.n: tuple(r)[2:] for r in joined.collect()}
    assert got[11] == (None, "EXCEPTION", "reset")
    assert got[12] == (None, "HTTP_ERROR_STATUS", "busy")


def test_token_is_cached_until_it_expires():
    spec = SPEC.replace(oidc_url="http://h/token", oidc_request="grant_type=x", oidc_reduction=10)
    opener, clock = fake_http.Opener(), [1000.0]
    first = bearer_token(spec, opener, lambda: clock[0])
    clock[0] += 50
    assert bearer_token(spec, opener, lambda: clock[0]) == first
    clock[0] += 1
    assert bearer_token(spec, opener, lambda: clock[0]) != first
    assert make_opener(SPEC.replace(proxy_host="p", proxy_port=1, proxy_username="u", proxy_password="w"))


def test_async_equals_sync_and_dedup_changes_nothing(probe):
    spec = SPEC.replace(ignored_codes="404")
    results = []
    for variant, skew in ((spec, True), (spec.replace(async_polling=True), True), (spec, False)):
        joined = lookup_join(probe, variant, {"id": "cust"}, CallableTransport(double), select=["twice"], skew=skew)
        results.append(sorted(map(tuple, joined.collect())))
    assert results[0] == results[1] == results[2]
    assert len(results[0]) == 27


def test_row_by_row_equals_dedup(spark):
    probe = spark.range(30).selectExpr("id as n", "case when id % 7 <> 0 then id % 10 end as status")
    spec = SPEC.replace(ignored_codes="404")
    for how in ("inner", "left"):
        for names in ([], ["http-completion-state"]):
            rows = [
                lookup_join(
                    probe, spec, {"id": "status"}, CallableTransport(double), how, ["twice"], names, dedup=dedup
                ).collect()
                for dedup in (True, False)
            ]
            assert sorted(map(str, rows[0])) == sorted(map(str, rows[1]))


def test_carried_columns_come_through_unchanged(spark):
    probe = spark.sql(
        "select 1L as id_, cast(null as bigint) as big, timestamp_ntz'2024-01-02 03:04:05.123456' as t, "
        "named_struct('a', cast(null as int)) as s, map('k', array(1, null)) as m, date'1500-01-01' as d "
        "union all select 2L, 9007199254740993L, null, null, null, null"
    )
    spec = SPEC.replace(cache="NONE")
    joined = lookup_join(probe, spec, {"id": "id_"}, CallableTransport(double), select=["twice"])
    want = [(*row, 2 * row.id_) for row in probe.orderBy("id_").collect()]
    assert [tuple(r) for r in joined.orderBy("id_").collect()] == want


def test_store_spares_calls(spark, probe):
    spec = SPEC.replace(ignored_codes="404")
    requests = plan_requests(probe, spec, {"id": "cust"}).dropDuplicates(["request_id"])
    store = keep(CallableTransport(double).fetch(requests.where("url not like '%=7'"), spec))

    def only_seven(request):
        if not request["url"].endswith("=7"):
            raise ValueError("this answer is in the store")
        return {"status": 200, "body": '{"twice": 14}'}

    stored = StoreTransport(store, CallableTransport(only_seven))
    strict = spec.replace(continue_on_error=False)
    got = lookup_join(probe, strict, {"id": "cust"}, stored, select=["twice"])
    want = lookup_join(probe, spec, {"id": "cust"}, CallableTransport(double), select=["twice"])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


@pytest.mark.parametrize(("name", "body", "want"), [("raw", "17", 17), ("csv", "17,x", 17)])
def test_other_response_formats(spark, name, body, want):
    schema = "v int" if name == "raw" else "v int, s string"
    spec = LookupSpec(url="http://h", schema=schema, response_format=name)
    answer = CallableTransport(lambda r: {"status": 200, "body": body})
    got = lookup_join(spark.range(1), spec, {"v": "id"}, answer, select=["v"])
    assert got.first().v == want


def test_null_keys(spark):
    probe = spark.createDataFrame([(1, 5), (2, None)], "n int, cust long")
    endpoint = TableTransport(spark.sql("select 5L as id, 10L as twice"), ["id"])
    spec = SPEC.replace(ignored_codes="404")

    def run(**options):
        rows = lookup_join(probe, spec, {"id": "cust"}, endpoint, select=["twice"], keep=["n"], **options)
        return sorted(map(tuple, rows.collect()))

    assert run() == [(1, 10)]
    assert run(how="left") == [(1, 10), (2, None)]
    everything = CallableTransport(lambda r: {"status": 200, "body": '{"twice": 1}'})
    sent = lookup_join(
        probe, spec, {"id": "cust"}, everything, select=["twice"], keep=["n"], null_keys="request"
    )
    assert sorted(map(tuple, sent.collect())) == [(1, 1), (2, 1)]


def test_bad_request_fails_or_becomes_a_row(spark):
    probe = spark.sql("select 1 as n, 'a b' as k")
    spec = LookupSpec(
        url="http://h/{k}", schema="v int", query_creator="generic-json-url", url_map={"k": "k"}, continue_on_error=True
    )
    echo = CallableTransport(lambda r: {"status": 200, "body": "{}"})
    with pytest.raises(Exception, match="cannot build the request"):
        lookup_join(probe, spec, ["k"], echo).collect()
    row = lookup_join(
        probe, spec, ["k"], echo, fail_on_bad_request=False, metadata=["http-completion-state"]
    ).first()
    assert (row.n, row.v, row["http-completion-state"]) == (1, None, "EXCEPTION")


def test_array_endpoint_with_a_hot_key(spark):
    orders = spark.range(300).selectExpr("id as o", "case when id % 3 = 0 then 1 else id % 40 end as cust")
    spec = LookupSpec(url="http://h/o", schema="cust long, o long", result_type="array", ignored_codes="404")
    probe = spark.range(50).selectExpr("id as c")
    got = lookup_join(probe, spec, {"cust": "c"}, TableTransport(orders, ["cust"]), select=["o"])
    want = probe.join(orders, probe.c == orders.cust).select("c", "o")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_replay(probe):
    spec = SPEC.replace(ignored_codes="404")
    requests = plan_requests(probe, spec, {"id": "cust"}).dropDuplicates(["request_id"])
    captured = keep(CallableTransport(double).fetch(requests, spec))
    live = lookup_join(probe, spec, {"id": "cust"}, CallableTransport(double), select=["twice"])
    replayed = lookup_join(probe, spec, {"id": "cust"}, ReplayTransport(captured), select=["twice"])
    assert sorted(map(tuple, live.collect())) == sorted(map(tuple, replayed.collect()))
    gone = lookup_join(
        probe, spec, {"id": "cust"}, ReplayTransport(captured.limit(0)), select=["twice"], metadata=["error-string"]
    )
    assert {r["error-string"] for r in gone.collect()} == {"no captured response"}


def test_hook(spark, tmp_path):
    log = tmp_path / "calls"
    probe = spark.range(3).selectExpr("id as n", "id as k").coalesce(1)
    transport = CallableTransport(double, hook=CountingHook(str(log)))
    requests = plan_requests(probe, SPEC, {"id": "k"})
    assert transport.fetch(requests, SPEC).count() == 3
    lines = log.read_text().split()
    assert lines[0] == "open" and lines[-1] == "close" and lines.count("GET") == 3


def test_view(spark, probe):
    spec = SPEC.replace(ignored_codes="404")
    create_lookup_view("enriched", probe, spec, {"id": "cust"}, CallableTransport(double), select=["twice"])
    assert spark.sql("select count(*) from enriched where twice = 2 * cust").first()[0] == 27


def test_deliver_logs_every_record(spark):
    rows = spark.range(100).selectExpr("id", "id % 3 as lane", "id div 10 as part", "repeat('x', cast(id as int)) as t")
    spec = SinkSpec(url="http://s", request_batch_size=4, max_record_bytes=100)
    log = deliver(
        rows, spec, CallableTransport(fake_http_post), ["lane"], ["part"], ["id"], columns=["id", "t"],
        log_path=new_dir(spark, "test-log"),
    )
    assert log.agg(F.sum("n_records")).first()[0] == 100
    refused = log.where("io_error = 'record too large'")
    assert refused.count() == 15
    sent = log.where("io_error is null")
    assert sent.where("is_error").count() == 1
    metrics = sink_metrics(log).first()
    assert metrics.records == 100 and metrics.requests_failed == 16
    assert redrive(log, log).count() == 16


def test_byte_limit(spark):
    rows = spark.range(40).selectExpr("id", "id % 2 as lane", "id div 10 as part", "repeat('x', cast(id as int)) as t")
    spec = SinkSpec(url="http://s", format="raw", max_batch_bytes=60, request_batch_size=3)
    log = deliver(
        rows, spec, CallableTransport(fake_http_post), ["lane"], ["part"], ["id"], columns=["t"], by_bytes=True
    ).collect()
    assert sum(r.n_records for r in log) == 40
    assert all(r.n_bytes <= 60 and r.n_records <= 3 for r in log)
    assert len(log) > 14


def test_single_mode(spark):
    rows = spark.range(5).selectExpr("id", "0 as lane")
    spec = SinkSpec(url="http://s", mode="single", method="PUT")
    for ordered in (False, True):
        log = deliver(
            rows, spec, CallableTransport(fake_http_post), ["lane"], ["id"], ["id"], columns=["id"],
            keep_body=True, ordered=ordered,
        )
        assert sorted(r.request_body for r in log.collect()) == [f'{{"id":{i}}}' for i in range(5)]


@pytest.mark.parametrize(("status", "exclude", "errors"), [(500, "", 1), (404, "404", 0), (None, "", 1)])
def test_one_record(spark, status, exclude, errors):
    def answer(request):
        if status is None:
            raise ConnectionResetError
        return {"status": status}

    log = deliver(
        spark.range(1).withColumn("lane", F.lit(0)), SinkSpec(url="http://s", error_exclude=exclude),
        CallableTransport(answer), ["lane"], ["id"], ["id"],
    )
    assert sink_metrics(log).first().num_records_send_errors == errors


def test_data_source_writer(spark, helper):
    register_sink(spark)
    rows = spark.range(30).selectExpr("id")
    spec = SinkSpec(url="http://s", request_batch_size=7)
    writer = as_elements(rows, spec).write.format("http-sink").mode("append")
    options = {"url": "http://s", "format": "json", "connector.http.sink.request.batch.size": "7"}
    writer.options(**options, sender="fake_http:post").save()
    with pytest.raises(Exception, match="insert-method"):
        writer.options(**options, **{"insert-method": "GET"}).save()


def test_streams_repeat_nothing(spark, tmp_path):
    source = tmp_path / "in"
    for i in range(3):
        spark.range(i * 10, i * 10 + 10).selectExpr("id", "id % 5 as cust", "0 as lane").coalesce(1).write.mode(
            "append"
        ).parquet(str(source))
    frame = spark.readStream.schema("id long, cust long, lane int").option("maxFilesPerTrigger", 1)
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    spec = SPEC.replace(ignored_codes="404")
    for _ in range(2):
        running = enrich_stream(
            frame.parquet(str(source)), spec.replace(schema="key bigint, twice bigint"), {"key": "cust"},
            CallableTransport(double), out, state, select=["twice"], keep=["id"],
        )
        running.trigger(availableNow=True).start().awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == 24 and got.select("epoch").distinct().count() == 3
    sink_out, sink_state = str(tmp_path / "log"), str(tmp_path / "sink-state")
    running = deliver_stream(
        frame.parquet(str(source)), SinkSpec(url="http://s", request_batch_size=3),
        CallableTransport(fake_http_post), sink_out, sink_state, ["lane"], ["id"], ["id"], columns=["id"],
    )
    running.trigger(availableNow=True).start().awaitTermination()
    log = spark.read.parquet(sink_out)
    assert log.agg(F.sum("n_records")).first()[0] == 30


@pytest.mark.parametrize("lateness", [None, "1 hour"])
def test_cache_stream(spark, tmp_path, lateness):
    source = tmp_path / "in"
    for i in range(3):
        rows = spark.range(i * 20, i * 20 + 20).selectExpr("id", "id % 3 as k", "timestamp_seconds(1700000000 + id * 60) as ts")
        rows.coalesce(1).write.mode("append").parquet(str(source))
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(source))
    out, state = str(tmp_path / "out"), str(tmp_path / "s")
    if lateness is None:
        hits = cache_stream(stream, "k", "ts", "id", 600_000)
        writer = hits.writeStream.format("parquet").option("path", out).option("checkpointLocation", state)
        writer.trigger(availableNow=True).start().awaitTermination()
        got = spark.read.parquet(out)
    else:
        cache = CachedStream("k", "ts", "id", 600_000, lateness, out, state)
        cache.start(stream, str(tmp_path / "log")).trigger(availableNow=True).start().awaitTermination()
        assert cache.answers(spark, "key long, ident long").count() == 0  # the whole stream is shorter than the lateness
        cache.finish(spark)
        cache.finish(spark)  # nothing more to do
        got = cache.answers(spark, "key long, ident long")
    want, loaded = {}, {}
    for i in range(60):
        want[i] = i % 3 in loaded and (i - loaded[i % 3]) * 60 <= 600
        if not want[i]:
            loaded[i % 3] = i
    assert {r.id: r.hit for r in got.collect()} == want and got.count() == 60


def test_options():
    spec = LookupSpec.from_options(
        {
            "connector": "rest-lookup",
            "url": "http://h",
            "format": "json",
            "json.ignore-parse-errors": "true",
            "lookup-method": "PUT",
            "asyncPolling": "true",
            "lookup.max-retries": "5",
            "lookup.cache": "PARTIAL",
            "lookup.partial-cache.expire-after-write": "5 min",
            "lookup-request.format.json.fail-on-missing-field": "true",
            "any.connector.http.source.lookup.retry-codes": "503",
            "any.connector.http.source.lookup.header.Origin": "*",
            "any.connector.http.source.lookup.request.timeout": "7",
            "any.connector.http.request.query-param-fields": "a;b",
            "any.connector.http.request.url-map": "a:x,b:y",
        },
        "id int",
    )
    assert spec.ignore_parse_errors and spec.threads == 8 and spec.max_retries == 5
    assert spec.cache_expire_after_write == 300 and spec.request_timeout == 7
    assert spec.query_param_fields == ("a", "b") and spec.url_map == {"a": "x", "b": "y"}
    assert spec.headers == {"Origin": "*"} and spec.retry_set == {503}
    assert spec.request_options == {"fail-on-missing-field": "true"}


@pytest.mark.parametrize(
    "changes",
    [
        {"result_type": "page"},
        {"retry_strategy": "never"},
        {"oidc_url": "http://t"},
        {"http_version": "HTTP_2"},
        {"logging_level": "ALL"},
        {"cache": "FULL"},
        {"max_retries": -1},
    ],
)
def test_bad_lookup_options(changes):
    with pytest.raises(ValueError):
        LookupSpec(url="http://h", schema="a int", **changes)


@pytest.mark.parametrize(
    "changes", [{"request_batch_size": 0}, {"mode": "stream"}, {"error_codes": "4X"}, {"max_buffered": 10}, {"url": ""}]
)
def test_bad_sink_options(changes):
    with pytest.raises(ValueError):
        SinkSpec(**{"url": "http://h", **changes})


def test_unknown_options():
    with pytest.raises(ValueError, match="unknown"):
        LookupSpec.from_options({"url": "http://h", "format": "json", "colour": "red"}, "a int")
    with pytest.raises(ValueError, match="required"):
        SinkSpec.from_options({"url": "http://h"})
    with pytest.raises(ValueError, match="insert-method"):
        SinkSpec.from_options({"url": "http://h", "format": "json", "insert-method": "post"})



"""The calls of a task and what a worker remembers, with injected clocks and endpoints."""

import threading
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fake_http import UrlLog, echo, other
from restframe.operators.lookup import lookup_join
from restframe.sources import calls
from restframe.sources import transport as wire
from restframe.sources.calls import Calls, PartialCache
from restframe.sources.transport import CallableTransport, KeptConnections, followed, redirected
from restframe.spec import LookupSpec, SinkSpec

SPEC = LookupSpec(url="http://s", schema="id int", retry_codes="503", max_retries=3)


@pytest.fixture(scope="module", autouse=True)
def in_workers(spark):
    from pathlib import Path

    spark.sparkContext.addPyFile(str(Path(__file__).parent / "fake_http.py"))


def requests(n, url="http://s/{}"):
    return [(i, {"request_id": str(i), "method": "GET", "url": url.format(i), "body": None}) for i in range(n)]


@pytest.mark.parametrize("workers", [1, 4])
def test_every_request_is_answered_once(workers):
    seen = Counter()
    lock = threading.Lock()

    def send(request):
        with lock:
            seen[request["url"]] += 1
            times = seen[request["url"]]
        i = int(request["url"].rsplit("/", 1)[1])
        if i % 7 == 0 and times <= 2:
            return {"status": 503}
        if i % 11 == 0:
            raise ConnectionResetError("reset")
        if i % 13 == 0:
            raise ValueError("no such thing")
        return {"status": 200, "body": str(i)}

    paused = []
    got = dict(Calls(send, SPEC, workers, sleep=paused.append).run(iter(requests(200))))
    assert sorted(got) == list(range(200))
    for i, answer in got.items():
        if i % 11 == 0:
            assert answer["io_error"] == "reset" and answer["attempt"] == 4
        elif i % 13 == 0:
            assert answer["io_error"] == "no such thing" and answer["attempt"] == (3 if i % 7 == 0 else 1)
        else:
            assert answer["body"] == str(i) and answer["attempt"] == (3 if i % 7 == 0 else 1)


@pytest.mark.parametrize("workers", [1, 2])
def test_back_off_holds_no_thread(workers):
    """Half of the requests back off; the others are all answered before the first of them is due."""
    spec = SPEC.replace(fixed_delay=1.0)
    tried = Counter()

    def send(request):
        tried[request["url"]] += 1
        i = int(request["url"].rsplit("/", 1)[1])
        return {"status": 503 if i % 2 and tried[request["url"]] == 1 else 200, "body": "x"}

    began = time.monotonic()
    order = [place for place, _ in Calls(send, spec, workers).run(iter(requests(60)))]
    took = time.monotonic() - began
    assert all(i % 2 == 0 for i in order[:30]) and all(i % 2 for i in order[30:])
    assert took < 5  # thirty pauses one after the other in two threads would take fifteen times one


def test_waiting_requests_are_bounded(monkeypatch):
    monkeypatch.setattr(calls, "WAITING", 5)
    most = []

    def send(request):
        most.append(len(made.waiting))
        return {"status": 503}

    for workers in (1, 3):
        made = Calls(send, SPEC, workers, sleep=lambda s: None)
        assert len(list(made.run(iter(requests(40))))) == 40
    assert max(most) <= 5 + 6


def test_equal_requests_under_way_are_sent_once():
    sent = []

    def send(request):
        sent.append(request["url"])
        time.sleep(0.05)
        return {"status": 200, "body": "x"}

    cache = PartialCache(SPEC.replace(cache_max_rows=10))
    got = list(Calls(send, SPEC, 4, cache).run(iter(requests(40, "http://s/one"))))
    assert len(got) == 40 and len(sent) == 1
    # An answer that is not kept is asked for by each.
    sent.clear()
    strict = PartialCache(SPEC.replace(cache_missing_key=False))
    refuse = lambda request: sent.append(request["url"]) or {"status": 200, "body": " "}
    assert len(list(Calls(refuse, SPEC, 4, strict).run(iter(requests(9, "http://s/one"))))) == 9 and len(sent) == 9


ANSWER = {"status": 200, "body": "x" * 10, "headers": None}


@pytest.mark.parametrize("limit", ["cache_expire_after_write", "cache_expire_after_access"])
def test_nothing_expired_is_held(limit):
    clock = [0.0]
    cache = PartialCache(SPEC.replace(**{limit: 5}), lambda: clock[0])
    for i in range(100_000):
        clock[0] = float(i)
        cache.put((f"k{i}",), ANSWER)
        assert len(cache) <= 6
    clock[0] += 6
    cache.expire()
    assert len(cache) == 0 == cache.chars


def test_use_does_not_lengthen_the_time_since_writing():
    clock = [0.0]
    cache = PartialCache(SPEC.replace(cache_expire_after_write=5), lambda: clock[0])
    cache.put(("a",), ANSWER)
    clock[0] = 1.0
    cache.put(("b",), ANSWER)
    clock[0] = 4.0
    assert cache.get(("a",))
    clock[0] = 5.5
    assert cache.get(("a",)) is None and cache.get(("b",))
    cache.put(("b",), ANSWER)  # written again
    clock[0] = 10.0
    assert cache.get(("b",))


def test_cache_is_bounded_by_characters():
    cache = PartialCache(SPEC.replace(cache_expire_after_write=1000), max_chars=120)
    for i in range(50):
        cache.put((f"key{i:02}",), ANSWER)
        assert cache.chars <= 120
    assert len(cache) == 8 and cache.get(("key49",)) and cache.get(("key00",)) is None


def test_caches_of_other_lookups_are_apart_and_few(monkeypatch):
    monkeypatch.setattr(calls, "_CACHES", type(calls._CACHES)())
    spec = SPEC.replace(cache_max_rows=5)
    one = calls.worker_cache(spec, "one")
    one.put(("a",), ANSWER)
    assert calls.worker_cache(spec, "two").get(("a",)) is None and calls.worker_cache(spec, "one") is one
    for i in range(100):
        calls.worker_cache(spec, f"n{i}").put(("a",), ANSWER)
    assert len(calls._CACHES) <= calls.CACHES
    assert calls.worker_cache(SPEC, "one") is None and calls.worker_cache(SinkSpec(url="http://s"), "one") is None


def test_headers_are_part_of_the_key():
    base = {"request_id": "1", "method": "GET", "url": "http://s", "body": None}
    keys = {calls.request_key(base | {"headers": h}, fixed) for h, fixed in [
        (None, {}), ({"Authorization": "a"}, {}), ({"Authorization": "b"}, {}), (None, {"X-Tenant": "1"}), (None, {"X-Tenant": "2"}),
    ]}
    assert len(keys) == 5
    assert calls.request_key(base | {"headers": {"authorization": "a"}}, {"Authorization": "z"}) in keys


def test_two_endpoints_with_one_spec(spark):
    spec = SPEC.replace(cache_max_rows=100)
    probe = spark.range(8).coalesce(1).selectExpr("id % 2 as k")
    for send, want in ((echo, 1), (other, 2), (echo, 1)):
        rows = lookup_join(probe, spec, {"k": "k"}, CallableTransport(send), select=["id"], keep=[]).collect()
        assert {r.id for r in rows} == {want} and len(rows) == 8


def test_equal_requests_meet_one_cache(spark, tmp_path):
    log = tmp_path / "calls"
    wire.register_hook("routing", UrlLog(str(log)))
    spec = SPEC.replace(cache_max_rows=1000, callback="routing", ignored_codes="404")
    probe = spark.range(0, 800, 1, 8).selectExpr("id % 40 as k")
    rows = lookup_join(probe, spec, {"k": "k"}, CallableTransport(echo, parallelism=8), select=["id"], keep=["k"])
    assert rows.count() == 800 - 20
    assert set(Counter(log.read_text().split()).values()) == {1}


def test_a_request_of_very_many_rows_goes_to_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(wire, "CACHED_ROWS", 50)
    rows = spark.range(300).selectExpr("id", "if(id < 200, 'hot', cast(id as string)) as request_id", "'GET' as method", "'u' as url", "'' as body")
    routed = wire.route_calls(rows, CallableTransport(echo, parallelism=8)).withColumn("p", F.spark_partition_id())
    places = {r.request_id: r.n for r in routed.groupBy("request_id").agg(F.count_distinct("p").alias("n")).collect()}
    assert 1 < places.pop("hot") <= 4 and set(places.values()) == {1}
    assert routed.count() == 300 and routed.columns == [*rows.columns, "p"]


METHODS = ["GET", "HEAD", "POST", "PUT", "DELETE"]


@pytest.mark.parametrize("status", [301, 302, 303, 307, 308])
@pytest.mark.parametrize("method", METHODS)
def test_method_after_a_redirect(status, method):
    want = method
    if (status == 303 and method != "HEAD") or (status in (301, 302) and method == "POST"):
        want = "GET"
    assert redirected(method, "http://a/", status, "b") == (want, "http://a/b")
    body = b"x" if method in ("POST", "PUT") else None
    assert followed(method, "http://a/", body, status, "b", False) == (want, "http://a/b", body if want == method else None)
    if body and want != method:
        with pytest.raises(OSError, match="would drop the body"):
            followed(method, "http://a/", body, status, "b", True)
    else:
        assert followed(method, "http://a/", body, status, "b", True) == (want, "http://a/b", body)


def test_a_sink_keeps_the_body_or_fails():
    assert wire.make_opener(SinkSpec(url="https://s")).keep_body and not wire.make_opener(SPEC).keep_body
    assert isinstance(wire.make_opener(SPEC), KeptConnections)

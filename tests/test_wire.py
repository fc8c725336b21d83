"""The wire without a network: connections, redirects, caches and callbacks by injected stand-ins."""

import http.client
import threading
import urllib.request
from email.message import Message
from pathlib import Path

import pytest
from fake_http import UrlLog, echo, refuse, slow_first
from pyspark.sql import functions as F

from restframe.functions.headers import header_column
from restframe.operators.audit import audit_log
from restframe.operators.lookup import lookup_join
from restframe.operators.tokens import assign_tokens
from restframe.session import shared_dir
from restframe.sources import transport as wire
from restframe.sources.delivery import deliver
from restframe.sources.transport import CallableTransport, KeptConnections, PartialCache, redirected
from restframe.spec import LookupSpec, SinkSpec

SPEC = LookupSpec(url="http://s", schema="id int")


@pytest.fixture(scope="module", autouse=True)
def in_workers(spark):
    spark.sparkContext.addPyFile(str(Path(__file__).parent / "fake_http.py"))


class Line:
    """A connection that answers from a script; what it raises breaks it."""

    opened = 0

    def __init__(self, script):
        Line.opened += 1
        self.script, self.closed = script, False

    def request(self, method, path, body, headers):
        self.asked = (method, path, body, headers)

    def getresponse(self):
        step = self.script.pop(0)
        if isinstance(step, Exception):
            raise step
        status, location = step
        answer = Message()
        if location:
            answer["Location"] = location
        reply = http.client.HTTPMessage()
        reply._headers = answer._headers
        made = type("Answer", (), {"status": status, "headers": reply, "will_close": False})()
        made.read = lambda: repr(self.asked).encode()
        return made

    def close(self):
        self.closed = True


def session(script):
    Line.opened = 0
    return KeptConnections(None, lambda scheme, netloc, timeout: Line(script))


def ask(kept, method="GET", url="https://a.example/x?y=1", data=None):
    return kept.open(urllib.request.Request(url, data=data, method=method, headers={"Authorization": "t"}), timeout=1)


def test_connections_are_kept_and_opened_anew():
    script = [(200, None), (200, None), http.client.RemoteDisconnected("gone"), (201, None)]
    kept = session(script)
    assert [ask(kept).status for _ in range(3)] == [200, 200, 201]
    assert Line.opened == 2
    with pytest.raises(http.client.BadStatusLine):
        ask(session([http.client.BadStatusLine("?")]))


def test_redirects():
    kept = session([(307, "/z"), (302, "https://b.example/w"), (200, None)])
    assert ask(kept, "POST", data=b"q").read() == repr(("GET", "/w", None, {})).encode()
    down = session([(301, "http://a.example/")])
    assert ask(down).status == 301
    assert redirected("PUT", "http://a/", 308, "b") == ("PUT", "http://a/b")
    assert redirected("PUT", "http://a/", 303, "b") == ("GET", "http://a/b")
    assert redirected("GET", "http://a/", 304, "b") is redirected("GET", "http://a/", 302, None) is None


def test_cut_replies_are_tried_again():
    steps = [http.client.IncompleteRead(b""), {"status": 200}]

    def send(request):
        step = steps.pop(0)
        if isinstance(step, Exception):
            raise step
        return step

    got = wire.send_with_retry(send, {"request_id": "1"}, SPEC, lambda s: None)
    assert (got["status"], got["attempt"]) == (200, 2)


def test_a_slow_call_holds_up_no_other(spark):
    spec = SPEC.replace(async_polling=True, request_threads=4, cache="NONE")
    rows = lookup_join(spark.range(40).coalesce(1), spec, {"k": "id"}, CallableTransport(slow_first), select=["id"], keep=[])
    at = sorted(r.id for r in rows.collect())
    assert at[-1] - at[-2] > 900  # all others were done long before


def test_partial_cache():
    clock = [0.0]
    spec = SPEC.replace(cache_max_rows=2, cache_expire_after_write=10, cache_expire_after_access=4, ignored_codes="404")
    cache = PartialCache(spec, lambda: clock[0])
    good, empty = {"status": 200, "body": "{}"}, {"status": 404, "body": ""}
    cache.put(("a",), good)
    cache.put(("b",), empty)
    assert cache.get(("a",)) and cache.get(("b",))
    clock[0] = 3.0
    assert cache.get(("a",))
    cache.put(("c",), good)
    assert cache.get(("b",)) is None  # the least recently used
    for clock[0] in (6.0, 9.0):
        assert cache.get(("a",))
    clock[0] = 11.0
    assert cache.get(("a",)) is None  # written too long ago
    assert cache.get(("c",)) is None  # not used for too long
    cache.put(("d",), {"status": 500, "body": "x"})
    assert cache.get(("d",)) is None
    strict = PartialCache(spec.replace(cache_missing_key=False), lambda: 0.0)
    strict.put(("b",), empty)
    assert strict.get(("b",)) is None


@pytest.mark.parametrize(("options", "calls"), [
    ({"lookup.partial-cache.max-rows": "100"}, 4),
    ({"lookup.partial-cache.max-rows": "100", "lookup.partial-cache.cache-missing-key": "false"}, 4 + 9),
    ({"lookup.partial-cache.max-rows": "1"}, 40),
])
def test_cache_options_take_effect(spark, tmp_path, options, calls):
    log = tmp_path / "calls"
    wire.register_hook("counting", UrlLog(str(log)))
    spec = LookupSpec.from_options(
        {"url": f"http://{tmp_path.name}", "format": "json", "lookup.cache": "PARTIAL",
         "source.lookup.ignored-response-codes": "404", "source.lookup.request-callback": "counting", **options},
        "id int",
    )
    probe = spark.range(40).coalesce(1).selectExpr("id % 4 as k")
    # One task, whose cache sees the keys by turns.
    rows = lookup_join(probe, spec, {"k": "k"}, CallableTransport(echo, parallelism=1), select=["id"], keep=["k"])
    assert rows.count() == 30
    assert len(log.read_text().split()) == calls


def test_unknown_callback_is_refused(spark):
    with pytest.raises(ValueError, match="callback"):
        lookup_join(spark.range(1), SPEC.replace(callback="nobody"), {"k": "id"}, CallableTransport(echo), select=["id"], keep=[])


def test_logging_level_of_the_spec(spark):
    requests = spark.sql("select '1' as request_id, 'GET' as method, 'http://a' as url, '' as body, map('h', 'v') as headers")
    answers = spark.createDataFrame([("1", 200, None, "the body", None)], "request_id string, status int, headers map<string,array<string>>, body string, io_error string")
    quiet = audit_log(requests, answers, spec=SPEC).first().response_line
    loud = audit_log(requests, answers, spec=SPEC.replace(logging_level="MAX")).first().response_line
    assert "the body" not in quiet and "the body" in loud


def test_dynamic_headers_replace_fixed_ones_in_any_case(one):
    assert one(header_column({"X-Key": "fixed", "Z": "z"}, {"x-key": F.lit("row")})) == {"x-key": "row", "Z": "z"}


def test_tokens_issued_at_once(spark):
    tokens = spark.sql("select * from values ('t1', timestamp'2024-01-01', 60), ('t9', timestamp'2024-01-01', 60), ('t5', timestamp'2024-01-01', 90) as t(token, issued, expires_in)")
    asked = spark.sql("select 1 as id, timestamp'2024-01-01 00:00:05' as ts")
    for order in ([0, 1, 2], [2, 1, 0]):
        shuffled = spark.createDataFrame([tokens.collect()[i] for i in order], tokens.schema)
        assert assign_tokens(asked, shuffled, "ts", order=["id"]).first().token == "t9"


def test_all_refused_is_reported(spark):
    from restframe.sources.http_sink import as_elements, register_sink

    register_sink(spark)
    rows = as_elements(spark.range(9), SinkSpec(url="http://s"))
    options = {"url": "http://s", "format": "json", "sender": "fake_http:refuse"}
    rows.write.format("http-sink").mode("append").options(**options).save()
    with pytest.raises(Exception, match="requests_failed"):
        rows.write.format("http-sink").mode("append").options(**options, **{"fail-on-error": "true"}).save()


def test_log_of_a_delivery_is_not_written_over(spark, tmp_path):
    path = str(tmp_path / "log")
    args = (spark.range(5).withColumn("lane", F.lit(0)), SinkSpec(url="http://s"), CallableTransport(refuse), ["lane"], ["id"], ["id"])
    first = deliver(*args, log_path=path, delivery_id="d").collect()
    with pytest.raises(Exception, match="ALREADY_EXISTS|already exists"):
        deliver(*args, log_path=path)
    again = deliver(*args, delivery_id="d").collect()
    other = deliver(*args, delivery_id="e").collect()
    keys = [{r.idempotency_key for r in log} for log in (first, again, other)]
    assert keys[0] == keys[1] and not keys[0] & keys[2]


def test_a_shared_folder_is_needed_on_a_cluster():
    class Context:
        master = "spark://somewhere:7077"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Context()
        conf = type("Conf", (), {"get": staticmethod(lambda key, default: default)})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session())


def test_hooks_of_threads_are_called_once_each(spark, tmp_path):
    log = tmp_path / "all"
    spec = SPEC.replace(async_polling=True, request_threads=5, cache="NONE", ignored_codes="404")
    transport = CallableTransport(echo, UrlLog(str(log)))
    assert lookup_join(spark.range(50).coalesce(1), spec, {"k": "id"}, transport, how="left", select=[], keep=["id"], metadata=["http-status-code"]).count() == 50
    assert len(log.read_text().split()) == 50 and threading.active_count() < 200

"""Transports: DataFrame of requests -> DataFrame of responses.

``fetch(requests, spec, carry)`` takes rows with at least (request_id, method, url, body) and
gives the ``carry`` columns of the request and (request_id, attempt, status, headers, body,
io_error). Only ``HttpTransport`` touches a network, and only on the executors.
"""

from __future__ import annotations

import http.client
import json
import ssl
import threading
import time
import urllib.error
import urllib.request
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any, Protocol
from urllib.parse import urljoin, urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from restframe.functions.formats import encode_json
from restframe.operators.request import with_requests
from restframe.operators.retry import resolve_attempts
from restframe.operators.skew import hashable, key_salts, salted_join
from restframe.sources.calls import Answer, Calls, PartialCache, Request, Send, send_with_retry, worker_cache
from restframe.spec import ARRAY, LookupSpec, SinkSpec

RESPONSE_DDL = (
    "request_id string, attempt int, status int, headers map<string,array<string>>, body string, io_error string"
)
RESPONSE_COLUMNS = ["request_id", "attempt", "status", "headers", "body", "io_error"]

__all__ = ["PartialCache", "send_with_retry"]

#: Rows of a batch, and bytes of them, that are made into requests at once.
REQUESTS, REQUEST_BYTES = 1024, 8 << 20
#: Rows with one request that go to one task of a lookup with a partial cache.
CACHED_ROWS = 1_000_000
#: Answers, and characters of their bodies and bytes of what they carry, that a task holds before it hands them on.
ANSWERS, ANSWER_CHARS = 10_000, 16 << 20

class Transport(Protocol):
    def fetch(
        self, requests: DataFrame, spec: LookupSpec | SinkSpec, carry: Sequence[str] = ()
    ) -> DataFrame: ...


class Hook:
    """Called around the calls of one task; subclass to log or count (must be picklable)."""

    def open(self) -> None: ...

    def call(self, request: Request, response: Answer) -> None: ...

    def close(self) -> None: ...


#: Hooks by the ids that the callback options name.
HOOKS: dict[str, Hook] = {}


def register_hook(name: str, hook: Hook) -> None:
    """Make a hook known under the id that a ``request-callback`` option gives."""
    HOOKS[name] = hook


def hook_of(spec: LookupSpec | SinkSpec, hook: Hook | None) -> Hook | None:
    """The transport's own hook, or the one the spec's callback option names."""
    if hook is not None or spec.callback is None:
        return hook
    if spec.callback not in HOOKS:
        raise ValueError(f"no callback is registered as {spec.callback!r}; see register_hook")
    return HOOKS[spec.callback]


def _threads(spec: LookupSpec | SinkSpec) -> int:
    return spec.threads if isinstance(spec, LookupSpec) else spec.writer_threads


def _response_types() -> dict[str, pa.DataType]:
    text, number = pa.string(), pa.int32()
    kinds = [text, number, number, pa.map_(text, pa.list_(text)), text, text]
    return dict(zip(RESPONSE_COLUMNS, kinds, strict=True))


def _values(column: pa.Array) -> list[Any]:
    """The values of a column; texts all at once, not one by one."""
    return column.to_numpy(zero_copy_only=False).tolist() if pa.types.is_string(column.type) else column.to_pylist()


def map_requests(
    requests: DataFrame,
    spec: LookupSpec | SinkSpec,
    make_send: Callable[[], Send],
    hook: Hook | None = None,
    threads: int | None = None,
    sleep=time.sleep,
    carry: Sequence[str] = (),
    fixed: Mapping[str, str] | None = None,
) -> DataFrame:
    """Run the calls of every partition on the executors, a few at a time.

    Answers go on as they come, in portions limited by number and size. ``fixed`` are headers that
    ``make_send`` adds to every request. A partial cache belongs to the lookup that ``spec.cache_scope``
    names, by default to this call.
    """
    workers = threads or _threads(spec)
    hook = hook_of(spec, hook)
    scope = getattr(spec, "cache_scope", None) or uuid.uuid4().hex
    fields = [c for c in ("request_id", "method", "url", "body", "headers") if c in requests.columns]
    carried = [F.col(c).alias(f"carry_{i}") for i, c in enumerate(carry)]
    names = [f"carry_{i}" for i in range(len(carry))]
    chosen = requests.select(*fields, *carried)
    types = {f.name: f.dataType.simpleString() for f in chosen.schema.fields}
    ddl = ", ".join([*[f"{n} {types[n]}" for n in names], RESPONSE_DDL])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if hook is not None:
            hook.open()
        calls = Calls(make_send(), spec, workers, worker_cache(spec, scope), fixed, hook and hook.call, sleep)

        def rows() -> Iterator[tuple[tuple[pa.RecordBatch, int, float], Request]]:
            for batch in batches:
                portion = max(1, min(REQUESTS, REQUEST_BYTES * batch.num_rows // max(1, batch.nbytes)))
                for start in range(0, batch.num_rows, portion):
                    part = batch.slice(start, portion)
                    columns = [_values(part.column(f)) for f in fields]
                    if "headers" in fields:
                        columns[-1] = [None if h is None else dict(h) for h in columns[-1]]
                    # A copy, so that an answer that waits to be handed on does not hold the bodies of its batch.
                    part = part.select(names).take(pa.array(range(part.num_rows)))
                    size = part.nbytes / part.num_rows
                    for i, values in enumerate(zip(*columns, strict=True)):
                        yield (part, i, size), dict(zip(fields, values, strict=True))

        def answered(done: list[tuple[tuple[pa.RecordBatch, int, float], dict[str, Any]]]) -> Iterator[pa.RecordBatch]:
            # Carried columns pass through as they are, from the part that brought them.
            sources: dict[int, tuple[pa.RecordBatch, list[int], list[dict[str, Any]]]] = {}
            for (part, i, _), response in done:
                _, at, responses = sources.setdefault(id(part), (part, [], []))
                at.append(i)
                responses.append(response)
            for part, at, responses in sources.values():
                arrays = list(part.take(pa.array(at)).columns)
                for column, kind in _response_types().items():
                    values = [d[column] for d in responses]
                    if column == "headers":
                        values = [None if v is None else list(v.items()) for v in values]
                    arrays.append(pa.array(values, kind))
                yield pa.RecordBatch.from_arrays(arrays, names=[*names, *RESPONSE_COLUMNS])

        try:
            held: list[tuple[tuple[pa.RecordBatch, int, float], dict[str, Any]]] = []
            size = 0.0
            for place, response in calls.run(rows()):
                held.append((place, response))
                size += len(response["body"] or "") + place[2]
                if size >= ANSWER_CHARS or len(held) >= ANSWERS:
                    yield from answered(held)
                    held, size = [], 0.0
            yield from answered(held)
        finally:
            if hook is not None:
                hook.close()

    sent = chosen.mapInArrow(run, ddl)
    return sent.withColumnsRenamed(dict(zip(names, carry, strict=True)))


@dataclass(frozen=True)
class CallableTransport:
    """Answers come from a Python function of the request; for tests and in-process services."""

    send: Send
    hook: Hook | None = None
    threads: int | None = None
    sleep: Callable[[float], None] = time.sleep
    parallelism: int | None = None

    def fetch(
        self, requests: DataFrame, spec: LookupSpec | SinkSpec, carry: Sequence[str] = ()
    ) -> DataFrame:
        send = self.send
        return map_requests(requests, spec, lambda: send, self.hook, self.threads, self.sleep, carry)


@dataclass(frozen=True)
class ReplayTransport:
    """Answers come from a table of captured attempts: (request_id, attempt, status, ...)."""

    captured: DataFrame

    def fetch(
        self, requests: DataFrame, spec: LookupSpec | SinkSpec, carry: Sequence[str] = ()
    ) -> DataFrame:
        log = self.captured.select(*RESPONSE_COLUMNS)
        if isinstance(spec, LookupSpec):
            log = resolve_attempts(log, spec).withColumnRenamed("n_attempts", "attempt")
        found = requests.select("request_id", *carry).join(log, "request_id", "left")
        missing = F.col("status").isNull() & F.col("io_error").isNull()
        return found.withColumn(
            "io_error", F.when(missing, "no captured response").otherwise(F.col("io_error"))
        ).select(*carry, *RESPONSE_COLUMNS)


@dataclass(frozen=True)
class StoreTransport:
    """Answers kept from earlier runs first, calls for the rest; the user owns the store.

    ``store`` holds responses, unique by request id. Drop what has expired before passing it.
    """

    store: DataFrame
    inner: Transport

    def fetch(
        self, requests: DataFrame, spec: LookupSpec | SinkSpec, carry: Sequence[str] = ()
    ) -> DataFrame:
        known = requests.select("request_id", *carry).join(self.store.select(*RESPONSE_COLUMNS), "request_id")
        missing = requests.join(self.store.select("request_id"), "request_id", "left_anti")
        called = self.inner.fetch(spread_calls(missing, self.inner), spec, carry)
        return known.select(*carry, *RESPONSE_COLUMNS).unionByName(called.select(*carry, *RESPONSE_COLUMNS))


@dataclass(frozen=True)
class TableTransport:
    """An endpoint backed by a table: JSON of the rows whose keys make the same request.

    The table's own rows are run through the request planner, so a request finds its rows by
    request id. With ``result-type=array`` every row is an answer part of its own: a key with
    very many rows is never gathered into one document. Documents are never broadcast: a small file
    may make very large ones.
    """

    table: DataFrame
    keys: Mapping[str, str | Column] | Sequence[str]
    columns: Sequence[str] | None = None
    missing_status: int = 404

    def fetch(
        self, requests: DataFrame, spec: LookupSpec | SinkSpec, carry: Sequence[str] = ()
    ) -> DataFrame:
        planned = with_requests(self.table, spec, self.keys, "_rq_")
        names = list(self.columns or [f for f in spec.row_type.fieldNames() if f in self.table.columns])
        dtypes = {f.name: f.dataType for f in self.table.schema.fields}
        document = encode_json([(n, F.col(n), dtypes[n]) for n in names])
        if spec.result_type == ARRAY:
            document = F.concat(F.lit("["), document, F.lit("]"))
        served = planned.select(F.col("_rq_request_id").alias("request_id"), document.alias("body"))
        wanted = requests.select("request_id", *carry)
        if spec.result_type == ARRAY:
            found = salted_join(served, wanted, ["request_id"], "right", broadcast=False)
        else:
            found = wanted.hint("merge").join(served, "request_id", "left")
        status = F.when(F.col("body").isNull(), self.missing_status).otherwise(200)
        return found.select(
            *carry,
            "request_id",
            F.lit(1).alias("attempt"),
            status.alias("status"),
            F.create_map(F.lit("Content-Type"), F.array(F.lit("application/json"))).alias("headers"),
            "body",
            F.lit(None).cast("string").alias("io_error"),
        )


# ---------------------------------------------------------------- the wire

_TOKENS: dict[tuple[str, str], tuple[str, float]] = {}
_TOKENS_LOCK = threading.Lock()


def _ssl_context(spec: LookupSpec | SinkSpec) -> ssl.SSLContext:
    context = ssl.create_default_context(cafile=spec.server_cert)
    if spec.client_cert:
        context.load_cert_chain(spec.client_cert, spec.client_key)
    if spec.allow_self_signed:
        context.check_hostname = False
        context.verify_mode = ssl.CERT_NONE
    return context


def redirected(method: str, url: str, status: int, location: str | None) -> tuple[str, str] | None:
    """(method, url) of the request that follows a redirect; None where the reply is the answer.

    301 and 302 turn a POST into a GET, 303 turns everything but HEAD into one; else the request is
    repeated with its method and body. From https none leads to http.
    """
    if status not in (301, 302, 303, 307, 308) or not location:
        return None
    target = urljoin(url, location)
    old, new = urlsplit(url).scheme.lower(), urlsplit(target).scheme.lower()
    if new not in ("http", "https") or (old == "https" and new == "http"):
        return None
    to_get = method != "HEAD" if status == 303 else status in (301, 302) and method == "POST"
    return ("GET" if to_get else method), target


def followed(
    method: str, url: str, body: bytes | None, status: int, location: str | None, keep_body: bool
) -> tuple[str, str, bytes | None] | None:
    """(method, url, body) of the request after a redirect. With ``keep_body`` losing one is an error."""
    following = redirected(method, url, status, location)
    if following is None:
        return None
    if following[0] != method and body is not None and keep_body:
        raise OSError(f"redirect {status} to {following[1]} would drop the body of the {method}")
    return *following, (body if following[0] == method else None)


class _Redirects(urllib.request.HTTPRedirectHandler):
    """The same rule for sessions through a proxy."""

    def __init__(self, keep_body: bool = False) -> None:
        self.keep_body = keep_body

    def redirect_request(self, req, fp, code, msg, headers, newurl):  # noqa: ANN001, ANN201
        following = followed(req.get_method(), req.full_url, req.data, code, newurl, self.keep_body)
        if following is None:
            return None
        method, url, data = following
        return urllib.request.Request(url, data=data, headers=dict(req.header_items()), method=method)

    http_error_308 = urllib.request.HTTPRedirectHandler.http_error_302


class Reply:
    """An answer that was read whole, so that its connection can be used again."""

    def __init__(self, status: int, headers: Any, body: bytes) -> None:
        self.status, self.headers, self.body = status, headers, body

    def read(self) -> bytes:
        return self.body

    def __enter__(self) -> Reply:
        return self

    def __exit__(self, *_: object) -> None: ...


class KeptConnections:
    """A session that keeps a connection per thread and host, and opens it anew after an error."""

    def __init__(
        self, context: ssl.SSLContext, connect: Callable[..., Any] | None = None, keep_body: bool = False
    ) -> None:
        self.context, self.connect, self.local = context, connect or self._connect, threading.local()
        self.keep_body = keep_body

    def _connect(self, scheme: str, netloc: str, timeout: float) -> http.client.HTTPConnection:
        if scheme == "https":
            return http.client.HTTPSConnection(netloc, timeout=timeout, context=self.context)
        return http.client.HTTPConnection(netloc, timeout=timeout)

    def open(self, request: urllib.request.Request, timeout: float) -> Reply:
        method, url, body = request.get_method(), request.full_url, request.data
        headers = dict(request.header_items())
        for _ in range(MAX_REDIRECTS):
            reply = self._exchange(method, url, body, headers, timeout)
            following = followed(method, url, body, reply.status, reply.headers.get("Location"), self.keep_body)
            if following is None:
                return reply
            if urlsplit(following[1]).netloc != urlsplit(url).netloc:
                headers = {k: v for k, v in headers.items() if k.lower() != "authorization"}
            method, url, body = following
        raise OSError("too many redirects")

    def _exchange(self, method: str, url: str, body: bytes | None, headers: dict[str, str], timeout: float) -> Reply:
        parts = urlsplit(url)
        place = (parts.scheme.lower(), parts.netloc.rpartition("@")[2])
        path = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
        held = self.local.__dict__.setdefault("held", {})
        while True:
            kept = place in held
            connection = held.get(place) or self.connect(*place, timeout)
            held[place] = connection
            try:
                connection.request(method, path, body, headers)
                answer = connection.getresponse()
                reply = Reply(answer.status, answer.headers, answer.read())
            except (OSError, http.client.HTTPException) as error:
                held.pop(place, None)
                connection.close()
                # The other side may have closed a kept connection meanwhile; a new one tells.
                if kept and not isinstance(error, TimeoutError):
                    continue
                raise
            if answer.will_close:
                held.pop(place, None)
                connection.close()
            return reply


MAX_REDIRECTS = 10


def make_opener(spec: LookupSpec | SinkSpec) -> Any:
    """A session with the spec's TLS and proxy settings; without a proxy it keeps its connections.

    A sink's record is its body: a redirect that would drop it is an error, not a delivery.
    """
    keep_body = isinstance(spec, SinkSpec)
    if not getattr(spec, "proxy_host", None):
        return KeptConnections(_ssl_context(spec), keep_body=keep_body)
    login = f"{spec.proxy_username}:{spec.proxy_password}@" if spec.proxy_username else ""
    proxy = f"http://{login}{spec.proxy_host}:{spec.proxy_port}"
    return urllib.request.build_opener(
        urllib.request.HTTPSHandler(context=_ssl_context(spec)),
        _Redirects(keep_body),
        urllib.request.ProxyHandler({"http": proxy, "https": proxy}),
    )


def bearer_token(spec: LookupSpec | SinkSpec, opener: Any, now: Callable[[], float] = time.time) -> str:
    """A valid access token, fetched once per Python worker and again when it has expired."""
    key = (spec.oidc_url, spec.oidc_request)
    with _TOKENS_LOCK:
        cached = _TOKENS.get(key)
        if cached is not None and now() <= cached[1]:
            return cached[0]
        asked = urllib.request.Request(
            spec.oidc_url,
            data=spec.oidc_request.encode(),
            headers={"Content-Type": "application/x-www-form-urlencoded"},
            method="POST",
        )
        with opener.open(asked, timeout=spec.request_timeout) as reply:
            if reply.status != 200:
                raise ValueError(f"the token endpoint answered {reply.status}")
            answer = json.loads(reply.read())
        life = float(answer.get("expires_in") or 0)
        if life > spec.oidc_reduction:
            life -= spec.oidc_reduction
        _TOKENS[key] = (answer["access_token"], now() + life)
        return _TOKENS[key][0]


@dataclass(frozen=True)
class HttpTransport:
    """Real HTTP/1.1 calls from the executors; ``opener`` builds the session of a task."""

    opener: Callable[[LookupSpec | SinkSpec], Any] = make_opener
    hook: Hook | None = None
    sleep: Callable[[float], None] = time.sleep
    headers: Mapping[str, str] = field(default_factory=dict)
    parallelism: int | None = None

    def fetch(
        self, requests: DataFrame, spec: LookupSpec | SinkSpec, carry: Sequence[str] = ()
    ) -> DataFrame:
        fixed = {**spec.headers, **self.headers}
        make = self.opener

        def make_send() -> Send:
            opener = make(spec)
            return lambda request: _call(opener, request, spec, fixed)

        return map_requests(requests, spec, make_send, self.hook, None, self.sleep, carry, fixed)


def _call(opener: Any, request: Request, spec: LookupSpec | SinkSpec, fixed: Mapping[str, str]) -> Answer:
    headers = {**fixed, **dict(request.get("headers") or {})}
    if spec.oidc_url:
        headers = {k: v for k, v in headers.items() if k.lower() != "authorization"}
        headers["Authorization"] = f"Bearer {bearer_token(spec, opener)}"
    body = request.get("body")
    wire = urllib.request.Request(
        request["url"],
        data=None if body is None or request["method"] == "GET" else body.encode(),
        headers=headers,
        method=request["method"],
    )
    try:
        reply = opener.open(wire, timeout=spec.request_timeout)
    except urllib.error.HTTPError as refused:  # any status outside 2XX
        reply = refused
    with reply:
        return {
            "status": reply.status,
            "headers": {name: reply.headers.get_all(name) for name in set(reply.headers.keys())},
            "body": reply.read().decode("utf-8", "replace"),
        }


def route_calls(requests: DataFrame, transport: Transport) -> DataFrame:
    """Rows with equal requests to one task, for the cache of its worker.

    A request that very many rows make goes to several tasks, each of which then calls for it.
    """
    if isinstance(transport, (TableTransport, ReplayTransport, StoreTransport)):
        return requests
    counts = requests.groupBy("request_id").agg(F.count(F.lit(1)).alias("n"))
    salts = F.broadcast(key_salts(counts, ["request_id"], "n", CACHED_ROWS))
    rows = requests.withColumn("_salted_key", F.xxhash64("request_id")).join(salts, F.col("_salted_key") == F.col("_salted_hash"), "left")
    others = [c for c in hashable(requests) if c not in ("`method`", "`url`", "`body`", "`headers`", "`request_id`")]
    salt = F.pmod(F.xxhash64(*others), F.coalesce("_salts", F.lit(1))) if others else F.lit(0)
    return rows.repartition(_call_tasks(requests, transport), "_salted_key", salt).drop("_salted_key", "_salted_hash", "_salts")


def _call_tasks(requests: DataFrame, transport: Transport) -> int:
    spark = requests.sparkSession
    usual = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return getattr(transport, "parallelism", None) or usual


def spread_calls(requests: DataFrame, transport: Transport) -> DataFrame:
    """Spread distinct requests over the tasks of a transport that makes calls.

    Calls in flight = tasks x threads, and distinct requests are rows so small that adaptive
    execution would gather them in few tasks. ``parallelism`` sets the number of tasks. By default
    it is that of shuffle partitions, which is set for the size of the data, and not less than the
    cores there are; the executors of the moment when the plan is made say nothing about the calls.
    """
    if isinstance(transport, (TableTransport, ReplayTransport, StoreTransport)):
        return requests
    return requests.repartition(_call_tasks(requests, transport))

"""The calls of one task: retries that hold no thread, and the answers a worker remembers."""

from __future__ import annotations

import heapq
import http.client
import threading
import time
from collections import OrderedDict
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass
from typing import Any

from restframe.operators.retry import backoff
from restframe.spec import LookupSpec, SinkSpec

Request = dict[str, Any]
Answer = Mapping[str, Any]
Send = Callable[[Request], Answer]
#: Whatever a request came with; it is handed back with the answer.
Place = Any

#: Characters of the answers that a partial cache holds; the least recently used go first.
CACHE_CHARS = 128 << 20
#: Partial caches a worker keeps; that of the lookup least recently used goes first.
CACHES = 16
#: Requests of a task that may wait for another attempt; with more, no new ones are taken.
WAITING = 10_000


@dataclass
class _Entry:
    answer: dict[str, Any]
    written: float
    used: float
    size: int


class PartialCache:
    """Answers a worker remembers between its calls, under the partial-cache options.

    At most ``cache_max_rows`` answers and ``max_chars`` characters, the least recently used goes
    first; an answer is dropped after its time since it was written or last used. Every use of the
    cache first drops all answers whose time is over: they stand at the front of two queues, one in
    the order of writing and one in the order of use. Only successful answers are kept; those without
    a row to give (an ignored status, a blank body) only with ``cache_missing_key``.
    """

    def __init__(
        self, spec: LookupSpec, now: Callable[[], float] = time.monotonic, max_chars: int = CACHE_CHARS
    ) -> None:
        self.spec, self.now, self.max_chars, self.chars = spec, now, max_chars, 0
        self.success, self.ignored = spec.success_set, spec.ignored_set
        self.by_use: OrderedDict[tuple, _Entry] = OrderedDict()
        self.by_writing: OrderedDict[tuple, float] = OrderedDict()
        self.lock = threading.Lock()

    def __len__(self) -> int:
        return len(self.by_use)

    def _drop(self, key: tuple) -> None:
        self.chars -= self.by_use.pop(key).size
        del self.by_writing[key]

    def expire(self) -> None:
        """Drop what is over; takes time for what it drops only."""
        with self.lock:
            self._expire(self.now())

    def _expire(self, at: float) -> None:
        write, access = self.spec.cache_expire_after_write, self.spec.cache_expire_after_access
        while write is not None and self.by_writing:
            key, written = next(iter(self.by_writing.items()))
            if at - written <= write:
                break
            self._drop(key)
        while access is not None and self.by_use:
            key, entry = next(iter(self.by_use.items()))
            if at - entry.used <= access:
                break
            self._drop(key)

    def get(self, key: tuple) -> dict[str, Any] | None:
        with self.lock:
            at = self.now()
            self._expire(at)
            entry = self.by_use.get(key)
            if entry is None:
                return None
            entry.used = at
            self.by_use.move_to_end(key)
            return entry.answer

    def put(self, key: tuple, answer: dict[str, Any]) -> None:
        status = answer["status"]
        empty = status in self.ignored or not (answer["body"] or "").strip()
        if status not in self.success or (empty and not self.spec.cache_missing_key):
            return
        size = sum(len(str(part)) for part in (*key, answer["body"], answer.get("headers")) if part is not None)
        with self.lock:
            at = self.now()
            self._expire(at)
            if key in self.by_use:
                self._drop(key)
            self.by_use[key], self.by_writing[key] = _Entry(answer, at, at, size), at
            self.chars += size
            most = self.spec.cache_max_rows
            while self.by_use and (self.chars > self.max_chars or (most is not None and len(self.by_use) > most)):
                self._drop(next(iter(self.by_use)))


#: The caches of a Python worker, by lookup, the one used last at the end.
_CACHES: OrderedDict[str, PartialCache] = OrderedDict()
_CACHES_LOCK = threading.Lock()


def worker_cache(spec: LookupSpec | SinkSpec, scope: str) -> PartialCache | None:
    """The worker's cache of one lookup with partial-cache limits; it outlives tasks and micro-batches.

    ``scope`` names the lookup, so that no lookup gets the answers of another one.
    """
    if not isinstance(spec, LookupSpec) or not spec.limits_cache:
        return None
    with _CACHES_LOCK:
        own = _CACHES.setdefault(f"{scope} {spec!r}", PartialCache(spec))
        _CACHES.move_to_end(f"{scope} {spec!r}")
        for name, cache in list(_CACHES.items()):
            cache.expire()
            if cache is not own and (not len(cache) or len(_CACHES) > CACHES):
                del _CACHES[name]
        return own


def request_key(request: Request, fixed: Mapping[str, str]) -> tuple:
    """All that an answer may depend on."""
    headers = {**{k.lower(): v for k, v in fixed.items()}, **{k.lower(): v for k, v in (request.get("headers") or {}).items()}}
    return request["method"], request["url"], request.get("body"), *[f"{k}:{headers[k]}" for k in sorted(headers)]


def response_of(request: Request, answer: Answer, attempt: int) -> dict[str, Any]:
    headers = answer.get("headers")
    if headers is not None:
        headers = {k: list(v) if isinstance(v, (list, tuple)) else [str(v)] for k, v in headers.items()}
    status = answer.get("status")
    return {
        "request_id": request["request_id"],
        "attempt": attempt,
        "status": None if status is None else int(status),
        "headers": headers,
        "body": answer.get("body"),
        "io_error": answer.get("io_error"),
    }


def attempt_call(
    send: Send, request: Request, spec: LookupSpec | SinkSpec, attempt: int, retry_codes: frozenset[int]
) -> tuple[dict[str, Any], float | None]:
    """The response to one attempt, and the seconds to wait for another one, if there is to be one.

    I/O errors and retry codes are tried again, any other failure belongs to this one row. Sinks
    never try again.
    """
    retries = spec.max_retries if isinstance(spec, LookupSpec) else 0
    again = False
    try:
        answer: Answer = send(request)
        again = answer.get("status") in retry_codes
    except (OSError, http.client.HTTPException) as error:  # also a reply cut short
        answer, again = {"io_error": str(error) or type(error).__name__}, True
    except Exception as error:
        answer = {"io_error": str(error) or type(error).__name__}
    response = response_of(request, answer, attempt)
    return response, backoff(attempt, spec) if again and attempt <= retries else None


def retry_codes_of(spec: LookupSpec | SinkSpec) -> frozenset[int]:
    return spec.retry_set if isinstance(spec, LookupSpec) else frozenset()


def send_with_retry(send: Send, request: Request, spec: LookupSpec | SinkSpec, sleep=time.sleep) -> dict[str, Any]:
    """One call with the spec's retries, waiting between them."""
    attempt, retry_codes = 1, retry_codes_of(spec)
    while True:
        response, pause = attempt_call(send, request, spec, attempt, retry_codes)
        if pause is None:
            return response
        sleep(pause)
        attempt += 1


class Calls:
    """Runs requests a few at a time and gives answers as they come.

    A request that is to be tried again waits in a heap by the time it is due and holds no thread, so
    the others go on at full speed. With one worker calls are made in the order of the rows, in the
    caller's own thread. With a cache, equal requests that come while one is under way wait for its
    answer.
    """

    def __init__(
        self,
        send: Send,
        spec: LookupSpec | SinkSpec,
        workers: int,
        cache: PartialCache | None = None,
        fixed: Mapping[str, str] | None = None,
        called: Callable[[Request, dict[str, Any]], None] | None = None,
        sleep: Callable[[float], None] = time.sleep,
        now: Callable[[], float] = time.monotonic,
    ) -> None:
        self.send, self.spec, self.workers, self.cache, self.fixed = send, spec, workers, cache, fixed or {}
        self.called, self.sleep, self.now, self.skipped = called, sleep, now, 0.0
        self.retry_codes = retry_codes_of(spec)
        self.waiting: list[tuple[float, int, Place, Request, int]] = []
        self.turn = 0
        self.under_way: dict[tuple, list[tuple[Place, Request]]] = {}

    def _clock(self) -> float:
        return self.now() + self.skipped

    def _pause(self) -> None:
        """Until the next attempt is due; a ``sleep`` that returns early moves the clock."""
        left = self.waiting[0][0] - self._clock()
        if left > 0:
            self.sleep(left)
            self.skipped += max(0.0, self.waiting[0][0] - self._clock())

    def _later(self, place: Place, request: Request, attempt: int, pause: float) -> None:
        self.turn += 1
        heapq.heappush(self.waiting, (self._clock() + pause, self.turn, place, request, attempt))

    def _is_due(self) -> bool:
        return bool(self.waiting) and self.waiting[0][0] <= self._clock()

    def _finished(self, place: Place, request: Request, response: dict[str, Any]) -> list[tuple[Place, Request]]:
        """Note an answer; gives the requests that waited for it and are to be sent themselves."""
        if self.called is not None:
            self.called(request, response)
        if self.cache is None:
            return []
        key = request_key(request, self.fixed)
        self.cache.put(key, response)
        return self.under_way.pop(key, [])

    def _known(self, request: Request) -> dict[str, Any] | None:
        found = self.cache.get(request_key(request, self.fixed)) if self.cache is not None else None
        return None if found is None else found | {"request_id": request["request_id"]}

    def run(self, rows: Iterator[tuple[Place, Request]]) -> Iterator[tuple[Place, dict[str, Any]]]:
        return self._in_order(rows) if self.workers == 1 else self._in_threads(rows)

    def _in_order(self, rows: Iterator[tuple[Place, Request]]) -> Iterator[tuple[Place, dict[str, Any]]]:
        def attempt(place: Place, request: Request, number: int) -> Iterator[tuple[Place, dict[str, Any]]]:
            response, pause = attempt_call(self.send, request, self.spec, number, self.retry_codes)
            if pause is not None:
                self._later(place, request, number + 1, pause)
            else:
                self._finished(place, request, response)
                yield place, response

        for place, request in rows:
            while self._is_due() or len(self.waiting) >= WAITING:
                self._pause()
                yield from attempt(*heapq.heappop(self.waiting)[2:])
            known = self._known(request)
            if known is not None:
                yield place, known
            else:
                yield from attempt(place, request, 1)
        while self.waiting:
            self._pause()
            _, _, place, request, number = heapq.heappop(self.waiting)
            known = self._known(request)  # another row may have had an answer meanwhile
            if known is not None:
                yield place, known
            else:
                yield from attempt(place, request, number)

    def _in_threads(self, rows: Iterator[tuple[Place, Request]]) -> Iterator[tuple[Place, dict[str, Any]]]:
        running: dict[Future, tuple[Place, Request, int]] = {}
        more = True
        with ThreadPoolExecutor(self.workers) as pool:

            def submit(place: Place, request: Request, attempt: int = 1) -> None:
                call = pool.submit(attempt_call, self.send, request, self.spec, attempt, self.retry_codes)
                running[call] = place, request, attempt

            def take(place: Place, request: Request) -> dict[str, Any] | None:
                """The answer, if it is known; else the request is sent, or waits for one that was."""
                known = self._known(request)
                if known is None and self.cache is not None:
                    key = request_key(request, self.fixed)
                    if key in self.under_way:
                        self.under_way[key].append((place, request))
                        return None
                    self.under_way[key] = []
                if known is None:
                    submit(place, request)
                return known

            while more or running or self.waiting:
                while len(running) < 2 * self.workers and self._is_due():
                    submit(*heapq.heappop(self.waiting)[2:])
                while more and len(running) < 2 * self.workers and len(self.waiting) < WAITING:
                    row = next(rows, None)
                    if row is None:
                        more = False
                    elif (known := take(*row)) is not None:
                        yield row[0], known
                if not running:
                    if self.waiting:
                        self._pause()
                    continue
                left = max(0.0, self.waiting[0][0] - self._clock()) if self.waiting else None
                for future in wait(running, left, return_when=FIRST_COMPLETED).done:
                    place, request, attempt = running.pop(future)
                    response, pause = future.result()
                    if pause is not None:
                        self._later(place, request, attempt + 1, pause)
                        continue
                    followers = self._finished(place, request, response)
                    yield place, response
                    for follower in followers:
                        if (known := take(*follower)) is not None:
                            yield follower[0], known

"""A stand-in for the HTTP session, so that no test opens a socket."""

import io
import json
import threading
import time
import urllib.error
from email.message import Message
from urllib.parse import parse_qs, urlsplit

from restframe.sources.transport import Hook

CALLS = []


class Reply(io.BytesIO):
    def __init__(self, status, body, **headers):
        super().__init__(body.encode())
        self.status = status
        self.headers = Message()
        for name, values in headers.items():
            for value in values if isinstance(values, list) else [values]:
                self.headers[name] = value


class Opener:
    def __init__(self, spec=None):
        self.seen = {}

    def open(self, request, timeout):
        CALLS.append((request.get_method(), request.full_url, dict(request.header_items()), request.data))
        if request.full_url.endswith("/token"):
            return Reply(200, json.dumps({"access_token": f"tok{len(CALLS)}", "expires_in": 60}))
        key = int(parse_qs(urlsplit(request.full_url).query)["id"][0])
        times = self.seen[key] = self.seen.get(key, 0) + 1
        if key % 5 == 1 and times == 1:
            raise ConnectionResetError("reset")
        if key % 5 == 2 and times <= 2:
            raise urllib.error.HTTPError(request.full_url, 503, "busy", Message(), io.BytesIO(b"busy"))
        if key % 5 == 3:
            raise urllib.error.HTTPError(request.full_url, 400, "bad", Message(), io.BytesIO(b"bad id"))
        return Reply(200, json.dumps({"id": key, "twice": 2 * key}), Tag=["a", "b"])


def post(request):
    """A sink endpoint: refuses bodies that mention 13."""
    return {"status": 500 if "13" in request["body"] else 201, "body": ""}


def no_sleep(seconds):
    return None


def double(request):
    key = int(request["url"].rsplit("=", 1)[1])
    return {"status": 200, "body": f'{{"id":{key},"twice":{2 * key}}}'} if key != 4 else {"status": 404}


def fake_http_post(request):
    return {"status": 500 if '"id":13,' in request["body"] else 201, "body": ""}


class CountingHook(Hook):
    def __init__(self, path):
        self.path = path

    def open(self):
        self.lines = ["open"]

    def call(self, request, response):
        self.lines.append(f"call {request['method']} {response['status']}")

    def close(self):
        with open(self.path, "a") as out:
            out.write("\n".join([*self.lines, "close", ""]))


class UrlLog(Hook):
    """Appends the url of every call to a file."""

    def __init__(self, path):
        self.path = path

    def call(self, request, response):
        with open(self.path, "a") as out:
            out.write(request["url"] + "\n")


def echo(request):
    return {"status": 200, "body": '{"id":1}'} if not request["url"].endswith("=3") else {"status": 404}


def other(request):
    return {"status": 200, "body": '{"id":2}'}


def refuse(request):
    return {"status": 500, "body": ""}


def slow_first(request):
    """Answers with the time; the first one is late."""
    if request["url"].endswith("=0"):
        time.sleep(1.5)
    return {"status": 200, "body": f'{{"id":{time.monotonic_ns() // 10**6 % 10**9}}}'}


_NOW, _MOST, _LOCK = [0], [0], threading.Lock()


def in_flight(request):
    """Answers with the most calls that were under way at once in this process."""
    with _LOCK:
        _NOW[0] += 1
        _MOST[0] = max(_MOST[0], _NOW[0])
    time.sleep(0.05)
    with _LOCK:
        _NOW[0] -= 1
    return {"status": 200, "body": str(_MOST[0])}


def keep_key(request):
    """Writes the key of a request to a folder named in its url."""
    with open(request["url"].removeprefix("http://"), "a") as out:
        out.write(request["headers"]["Idempotency-Key"] + "\n")
    return {"status": 200, "body": ""}

"""Lookup and sink settings: option names, defaults, validation. Driver side only, no I/O."""

from __future__ import annotations

import dataclasses
import re
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import types as T

from restframe.functions.codes import check_rules, parse_code_set, parse_sink_codes
from restframe.functions.formats import format_options
from restframe.functions.headers import headers_from_options
from restframe.functions.loglines import log_level

SINGLE_VALUE = "single-value"
ARRAY = "array"
FIXED_DELAY = "fixed-delay"
EXPONENTIAL_DELAY = "exponential-delay"

_DURATION_UNITS = {"ms": 0.001, "s": 1.0, "sec": 1.0, "min": 60.0, "m": 60.0, "h": 3600.0, "d": 86400.0}


def seconds(text: str | int | float) -> float:
    """``"30 s"``, ``"500 ms"``, ``"1 min"``, ``"PT10S"`` or a bare number of seconds."""
    if isinstance(text, (int, float)):
        return float(text)
    plain = text.strip().lower()
    iso = re.fullmatch(r"pt(?:(\d+)h)?(?:(\d+)m)?(?:(\d+(?:\.\d+)?)s)?", plain)
    if iso and any(iso.groups()):
        hours, minutes, secs = (float(g or 0) for g in iso.groups())
        return hours * 3600 + minutes * 60 + secs
    found = re.fullmatch(r"(\d+(?:\.\d+)?)\s*([a-z]*)", plain)
    if not found or (found[2] and found[2] not in _DURATION_UNITS):
        raise ValueError(f"cannot read duration {text!r}")
    return float(found[1]) * _DURATION_UNITS.get(found[2], 1.0)


def _flag(text: str | bool) -> bool:
    return text if isinstance(text, bool) else str(text).strip().lower() == "true"


def _names(text: str) -> tuple[str, ...]:
    return tuple(part.strip() for part in re.split("[;,]", text) if part.strip())


def _mapping(text: str) -> dict[str, str]:
    return dict(tuple(p.strip() for p in part.split(":", 1)) for part in text.split(",") if part.strip())


def plain_options(options: Mapping[str, str]) -> dict[str, str]:
    """Option keys without the vendor part in front of ``source.lookup.``, ``sink.`` and the like."""
    return {re.sub(r"^(?:\w+\.)?connector\.http\.", "", key): value for key, value in options.items()}


# The option keys that users' table definitions hold. Option key -> (field, reader).
_LOOKUP_OPTIONS = {
    "url": ("url", str),
    "format": ("response_format", str),
    "lookup-request.format": ("request_format", str),
    "lookup-method": ("method", str),
    "asyncPolling": ("async_polling", _flag),
    "source.lookup.query-creator": ("query_creator", str),
    "source.lookup.result-type": ("result_type", str),
    "source.lookup.use-raw-authorization-header": ("raw_authorization", _flag),
    "source.lookup.success-codes": ("success_codes", str),
    "source.lookup.retry-codes": ("retry_codes", str),
    "source.lookup.ignored-response-codes": ("ignored_codes", str),
    "lookup.max-retries": ("max_retries", int),
    "source.lookup.retry-strategy.type": ("retry_strategy", str),
    "source.lookup.retry-strategy.fixed-delay.delay": ("fixed_delay", seconds),
    "source.lookup.retry-strategy.exponential-delay.initial-backoff": ("initial_backoff", seconds),
    "source.lookup.retry-strategy.exponential-delay.max-backoff": ("max_backoff", seconds),
    "source.lookup.retry-strategy.exponential-delay.backoff-multiplier": ("backoff_multiplier", float),
    "source.lookup.continue-on-error": ("continue_on_error", _flag),
    "lookup.cache": ("cache", str),
    "lookup.partial-cache.max-rows": ("cache_max_rows", int),
    "lookup.partial-cache.expire-after-write": ("cache_expire_after_write", seconds),
    "lookup.partial-cache.expire-after-access": ("cache_expire_after_access", seconds),
    "lookup.partial-cache.cache-missing-key": ("cache_missing_key", _flag),
    "source.lookup.request.timeout": ("request_timeout", seconds),
    "source.lookup.connection.timeout": ("connection_timeout", seconds),
    "source.lookup.request.thread-pool.size": ("request_threads", int),
    "source.lookup.response.thread-pool.size": ("response_threads", int),
    "source.lookup.http-version": ("http_version", str),
    "source.lookup.request-callback": ("callback", str),
    "source.lookup.proxy.host": ("proxy_host", str),
    "source.lookup.proxy.port": ("proxy_port", int),
    "source.lookup.proxy.username": ("proxy_username", str),
    "source.lookup.proxy.password": ("proxy_password", str),
    "security.oidc.token.endpoint.url": ("oidc_url", str),
    "security.oidc.token.request": ("oidc_request", str),
    "security.oidc.token.expiry.reduction": ("oidc_reduction", seconds),
    "security.cert.server": ("server_cert", str),
    "security.cert.server.allowSelfSigned": ("allow_self_signed", _flag),
    "security.cert.client": ("client_cert", str),
    "security.key.client": ("client_key", str),
    "logging.level": ("logging_level", str),
    "request.query-param-fields": ("query_param_fields", _names),
    "request.body-fields": ("body_fields", _names),
    "request.url-map": ("url_map", _mapping),
}


@dataclass(frozen=True)
class LookupSpec:
    """A REST endpoint used as a dimension table."""

    url: str
    schema: T.StructType | str
    method: str = "GET"
    request_format: str = "json"
    response_format: str = "json"
    options: Mapping[str, str] = field(default_factory=dict)
    query_creator: str | None = None
    result_type: str = SINGLE_VALUE
    headers: Mapping[str, str] = field(default_factory=dict)
    raw_authorization: bool = False
    success_codes: str = "2XX"
    retry_codes: str = "500,503,504"
    ignored_codes: str = ""
    max_retries: int = 3
    retry_strategy: str = FIXED_DELAY
    fixed_delay: float = 1.0
    initial_backoff: float = 1.0
    max_backoff: float = 60.0
    backoff_multiplier: float = 1.5
    continue_on_error: bool = False
    cache: str = "PARTIAL"
    cache_max_rows: int | None = None
    cache_expire_after_write: float | None = None
    cache_expire_after_access: float | None = None
    cache_missing_key: bool = True
    #: Names the lookup a partial cache belongs to; lookups that share it share their answers.
    cache_scope: str | None = None
    async_polling: bool = False
    request_threads: int = 8
    response_threads: int = 4
    request_timeout: float = 30.0
    connection_timeout: float | None = None
    http_version: str | None = None
    callback: str | None = None
    proxy_host: str | None = None
    proxy_port: int | None = None
    proxy_username: str | None = None
    proxy_password: str | None = None
    oidc_url: str | None = None
    oidc_request: str | None = None
    oidc_reduction: float = 1.0
    server_cert: str | None = None
    allow_self_signed: bool = False
    client_cert: str | None = None
    client_key: str | None = None
    logging_level: str | None = None
    query_param_fields: tuple[str, ...] = ()
    body_fields: tuple[str, ...] = ()
    url_map: Mapping[str, str] = field(default_factory=dict)
    date_keys: str = "iso"
    max_rows_per_key: int | None = None

    def __post_init__(self) -> None:
        if not self.url:
            raise ValueError("url is required")
        if self.result_type not in (SINGLE_VALUE, ARRAY):
            raise ValueError(f"unknown result type {self.result_type!r}")
        if self.retry_strategy not in (FIXED_DELAY, EXPONENTIAL_DELAY):
            raise ValueError(f"unknown retry strategy {self.retry_strategy!r}")
        if self.cache not in ("NONE", "PARTIAL"):
            raise ValueError(f"lookup.cache must be NONE or PARTIAL, got {self.cache!r}")
        if self.date_keys not in ("iso", "epoch"):
            raise ValueError("date_keys must be iso or epoch")
        if self.max_retries < 0:
            raise ValueError("lookup.max-retries must not be negative")
        if (self.oidc_url is None) != (self.oidc_request is None):
            raise ValueError("the OIDC token endpoint and token request go together")
        if self.http_version not in (None, "HTTP_1_1"):
            raise ValueError("only HTTP/1.1 is supported on the executors")
        if not isinstance(self.max_rows_per_key, (int, type(None))) or self.max_rows_per_key not in (None, 1):
            raise ValueError("max_rows_per_key is either 1 or not set")
        log_level(self.logging_level)
        check_rules(self.success_set, self.retry_set)

    @property
    def row_type(self) -> T.StructType:
        """The declared columns; DDL text is parsed by the active session."""
        return T.StructType.fromDDL(self.schema) if isinstance(self.schema, str) else self.schema

    @property
    def is_get(self) -> bool:
        return self.method.upper() == "GET"

    @property
    def ignored_set(self) -> frozenset[int]:
        return parse_code_set(self.ignored_codes)

    @property
    def success_set(self) -> frozenset[int]:
        return parse_code_set(self.success_codes) | self.ignored_set

    @property
    def retry_set(self) -> frozenset[int]:
        return parse_code_set(self.retry_codes)

    @property
    def limits_cache(self) -> bool:
        """Whether a partial cache was asked for that forgets."""
        limits = (self.cache_max_rows, self.cache_expire_after_write, self.cache_expire_after_access)
        return self.cache == "PARTIAL" and (any(x is not None for x in limits) or not self.cache_missing_key)

    @property
    def threads(self) -> int:
        """Requests in flight per task."""
        return self.request_threads if self.async_polling else 1

    @property
    def ignore_parse_errors(self) -> bool:
        return self.response_options.get("ignore-parse-errors", "false").lower() == "true"

    @property
    def response_options(self) -> dict[str, str]:
        return format_options(self.options, self.response_format)

    @property
    def request_options(self) -> dict[str, str]:
        return format_options(self.options, f"lookup-request.format.{self.request_format}")

    def replace(self, **changes: object) -> LookupSpec:
        return dataclasses.replace(self, **changes)

    @classmethod
    def from_options(cls, options: Mapping[str, str], schema: T.StructType | str) -> LookupSpec:
        """Read the connector's option keys; ``url`` and ``format`` are required."""
        plain = plain_options(options)
        for required in ("url", "format"):
            if required not in plain:
                raise ValueError(f"option {required!r} is required")
        values: dict[str, object] = {"cache": "NONE"}
        rest: dict[str, str] = {}
        raw = _flag(plain.get("source.lookup.use-raw-authorization-header", "false"))
        for key, value in plain.items():
            known = _LOOKUP_OPTIONS.get(key) or _LOOKUP_OPTIONS.get(key.removeprefix("source.lookup."))
            if known is not None:
                values[known[0]] = known[1](value)
            elif key != "connector" and not key.startswith("source.lookup.header."):
                rest[key] = value
        formats = (str(values["response_format"]), "lookup-request.format")
        unknown = [k for k in rest if not k.startswith(tuple(f"{f}." for f in formats)) and not k.startswith("table.")]
        if unknown:
            raise ValueError(f"unknown options {sorted(unknown)}")
        headers = headers_from_options(plain, "source.lookup.header.", raw)
        return cls(schema=schema, options=rest, headers=headers, **values)


# The option keys that users' table definitions hold. Option key -> (field, reader).
_SINK_OPTIONS = {
    "url": ("url", str),
    "format": ("format", str),
    "insert-method": ("method", str),
    "sink.batch.max-size": ("max_batch_size", int),
    "sink.requests.max-inflight": ("max_in_flight", int),
    "sink.requests.max-buffered": ("max_buffered", int),
    "sink.flush-buffer.size": ("max_batch_bytes", int),
    "sink.flush-buffer.timeout": ("max_time_ms", int),
    "sink.writer.request.mode": ("mode", str),
    "sink.request.batch.size": ("request_batch_size", int),
    "sink.request.timeout": ("request_timeout", seconds),
    "sink.writer.thread-pool.size": ("writer_threads", int),
    "sink.request-callback": ("callback", str),
    "sink.error.code": ("error_codes", str),
    "sink.error.code.exclude": ("error_exclude", str),
    "security.oidc.token.endpoint.url": ("oidc_url", str),
    "security.oidc.token.request": ("oidc_request", str),
    "security.oidc.token.expiry.reduction": ("oidc_reduction", seconds),
    "security.cert.server": ("server_cert", str),
    "security.cert.server.allowSelfSigned": ("allow_self_signed", _flag),
    "security.cert.client": ("client_cert", str),
    "security.key.client": ("client_key", str),
    "logging.level": ("logging_level", str),
}

# The methods the table form allows.
INSERT_METHODS = ("POST", "PUT")


@dataclass(frozen=True)
class SinkSpec:
    """An HTTP endpoint rows are delivered to."""

    url: str
    format: str = "json"
    method: str = "POST"
    options: Mapping[str, str] = field(default_factory=dict)
    max_batch_size: int = 500
    max_in_flight: int = 50
    max_buffered: int = 10_000
    max_batch_bytes: int = 5 * 1024 * 1024
    max_time_ms: int = 5000
    max_record_bytes: int = 1024 * 1024
    mode: str = "batch"
    request_batch_size: int | None = None
    headers: Mapping[str, str] = field(default_factory=dict)
    error_codes: str = ""
    error_exclude: str = ""
    request_timeout: float = 30.0
    writer_threads: int = 4
    callback: str | None = None
    oidc_url: str | None = None
    oidc_request: str | None = None
    oidc_reduction: float = 1.0
    server_cert: str | None = None
    allow_self_signed: bool = False
    client_cert: str | None = None
    client_key: str | None = None
    logging_level: str | None = None

    def __post_init__(self) -> None:
        if not self.url:
            raise ValueError("url is required")
        if (self.oidc_url is None) != (self.oidc_request is None):
            raise ValueError("the OIDC token endpoint and token request go together")
        if self.mode not in ("single", "batch"):
            raise ValueError(f"request mode must be single or batch, got {self.mode!r}")
        for name in ("max_batch_size", "batch_size", "max_in_flight", "max_buffered", "max_batch_bytes"):
            if int(getattr(self, name)) <= 0:
                raise ValueError(f"{name} must be positive")
        if self.max_buffered < self.max_batch_size:
            raise ValueError("the buffer must hold at least one batch")
        log_level(self.logging_level)
        parse_sink_codes(self.error_codes, self.error_exclude)

    @property
    def batch_size(self) -> int:
        if self.mode == "single":
            return 1
        return self.max_batch_size if self.request_batch_size is None else self.request_batch_size

    def replace(self, **changes: object) -> SinkSpec:
        return dataclasses.replace(self, **changes)

    @classmethod
    def from_options(cls, options: Mapping[str, str]) -> SinkSpec:
        """Read the connector's option keys; the table form allows POST and PUT only."""
        plain = plain_options(options)
        for required in ("url", "format"):
            if required not in plain:
                raise ValueError(f"option {required!r} is required")
        values: dict[str, object] = {}
        rest: dict[str, str] = {}
        # Spark hands data-source options over in lower case.
        known_keys = {key.lower(): target for key, target in _SINK_OPTIONS.items()}
        for key, value in plain.items():
            if key.lower() in known_keys:
                name, read = known_keys[key.lower()]
                values[name] = read(value)
            elif key.startswith(f"{plain['format']}."):
                rest[key] = value
            elif key != "connector" and not key.startswith("sink.header."):
                raise ValueError(f"unknown option {key!r}")
        if values.get("method", "POST") not in INSERT_METHODS:
            raise ValueError(f"insert-method must be one of {INSERT_METHODS}, got {values['method']!r}")
        return cls(options=rest, headers=headers_from_options(plain, "sink.header."), **values)

"""Request and response log lines with redaction by level."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Level names, redaction marks and line formats.
LEVELS = ("MIN", "REQRESPONSE", "MAX")
HIDDEN = "***"
NONE = "None"
REQUEST_LINE = "HTTP %s Request: URL: %s, Headers: %s"
RESPONSE_LINE = "HTTP %s Response: URL: %s, Response Headers: %s, status code: %s, Response Body: %s"
EXCEPTION_LINE = "HTTP %s Exception Response: URL: %s Exception %s"


def log_level(level: str | None) -> str:
    if level is None:
        return "MIN"
    if level not in LEVELS:
        raise ValueError(f"log level must be one of {LEVELS}, got {level!r}")
    return level


def headers_text(headers: Column, level: str | None = None) -> Column:
    """``map<string, array<string>>`` as it appears in a log line."""
    shown = F.lit(HIDDEN)
    if log_level(level) == "MAX":
        entries = F.array_sort(
            F.transform(
                F.map_entries(headers),
                lambda e: F.struct(F.lower(e["key"]).alias("sort"), e["key"].alias("k"), e["value"].alias("v")),
            )
        )
        shown = F.array_join(
            F.transform(
                entries, lambda e: F.concat(e["k"], F.lit(":["), F.array_join(e["v"], ";"), F.lit("]"))
            ),
            ";",
        )
    return F.when(F.coalesce(F.size(headers), F.lit(0)) <= 0, NONE).otherwise(shown)


def body_text(body: Column, level: str | None = None) -> Column:
    shown = F.lit(HIDDEN) if log_level(level) == "MIN" else body
    return F.when(F.coalesce(body, F.lit("")) == "", NONE).otherwise(shown)


def request_line(method: Column, url: Column, headers: Column, level: str | None = None) -> Column:
    return F.format_string(REQUEST_LINE, method, url, headers_text(headers, level))


def response_line(
    method: Column, url: Column, headers: Column, status: Column, body: Column, level: str | None = None
) -> Column:
    return F.format_string(
        RESPONSE_LINE, method, url, headers_text(headers, level), status.cast("string"), body_text(body, level)
    )


def exception_line(method: Column, url: Column, error: Column) -> Column:
    return F.format_string(EXCEPTION_LINE, method, url, error)

"""Header maps and authorization values."""

from __future__ import annotations

import base64
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

AUTHORIZATION = "Authorization"
BASIC = "Basic "


def basic_auth(value: Column, raw: bool | Column = False) -> Column:
    """``user:password`` as a Basic value; left alone when it already is one, or when raw."""
    keep = value.startswith(BASIC) | (raw if isinstance(raw, Column) else F.lit(raw))
    return F.when(keep, value).otherwise(F.concat(F.lit(BASIC), F.base64(value.cast("binary"))))


def headers_from_options(options: Mapping[str, str], prefix: str, raw_auth: bool = False) -> dict[str, str]:
    """Header name -> value for every option below ``prefix``; the name is its last segment."""
    found: dict[str, str] = {}
    for key, value in options.items():
        if not key.startswith(prefix):
            continue
        name = key.rsplit(".", 1)[-1]
        if name.lower() == AUTHORIZATION.lower() and not raw_auth and not value.startswith(BASIC):
            value = BASIC + base64.b64encode(value.encode()).decode()
        found[name] = value
    return found


def header_column(headers: Mapping[str, str], dynamic: Mapping[str, Column] | None = None) -> Column:
    """``map<string,string>``: fixed headers, with per-row values where given (names in any case)."""
    pairs: list[Column] = []
    dynamic = dict(dynamic or {})
    taken = {name.lower() for name in dynamic}
    for name, value in sorted(headers.items()):
        if name.lower() not in taken:
            pairs += [F.lit(name), F.lit(value)]
    for name, value in sorted(dynamic.items()):
        pairs += [F.lit(name), value.cast("string")]
    return F.create_map(*pairs) if pairs else F.expr("cast(map() as map<string,string>)")


def grouped_headers(pairs: Column) -> Column:
    """``array<struct<name, value>>`` as ``map<string, array<string>>``, values in order."""
    names = F.array_distinct(F.transform(pairs, lambda p: p["name"]))
    return F.map_from_entries(
        F.transform(
            names,
            lambda n: F.struct(
                n.alias("key"),
                F.transform(F.filter(pairs, lambda p: p["name"] == n), lambda p: p["value"]).alias("value"),
            ),
        )
    )

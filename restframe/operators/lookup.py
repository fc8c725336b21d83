"""The lookup join: probe rows -> distinct requests -> responses -> joined rows."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from restframe.operators.keys import resolve_keys
from restframe.operators.request import (
    distinct_requests,
    fail_on_request_error,
    key_columns,
    with_requests,
)
from restframe.operators.response import (
    EXCEPTION,
    emit_rows,
    fail_on_error,
    process_responses,
    pruned_schema,
)
from restframe.operators.skew import salted_join
from restframe.sources.transport import Transport, route_calls, spread_calls
from restframe.spec import LookupSpec

Keys = Mapping[str, str | Column] | Sequence[str]


def fetch_outcomes(
    requests: DataFrame,
    spec: LookupSpec,
    transport: Transport,
    select: Sequence[str] | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Send distinct requests and classify and decode what comes back, one row per response."""
    outcome = process_responses(transport.fetch(requests, spec, carry), spec, select)
    return fail_on_error(outcome, spec)


def lookup_join(
    probe: DataFrame,
    spec: LookupSpec,
    keys: Keys,
    transport: Transport,
    how: str = "inner",
    select: Sequence[str] | None = None,
    metadata: Sequence[str] = (),
    keep: Sequence[str] | None = None,
    null_keys: str = "skip",
    fail_on_bad_request: bool = True,
    dedup: bool | None = None,
    skew: bool = True,
) -> DataFrame:
    """Join every probe row with what the endpoint answers for its keys.

    ``keys`` maps lookup columns to probe columns. ``keep`` names the probe columns wanted,
    ``select`` the lookup columns (nested paths allowed), ``metadata`` the HTTP metadata
    columns. Equal requests are sent once; with ``lookup.cache=NONE`` (or ``dedup=False``) every
    row makes its own call, which takes no shuffle and no join back: for keys that hardly repeat,
    and for endpoints that answer every call differently. A partial cache with limits (rows, times,
    missing keys) makes rows call one by one through a cache that each worker keeps for this lookup; rows
    with equal requests go to one task, so that they meet one cache. A row whose top-level key is null matches nothing:
    it is left out of an inner join and kept by a left join; ``null_keys="request"`` sends it
    all the same. Lookup columns that clash with probe columns must be selected away.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be inner or left, got {how!r}")
    wanted = list(keep) if keep is not None else probe.columns
    fetched = [*pruned_schema(spec.row_type, select).fieldNames(), *metadata]
    clash = sorted(set(wanted) & set(fetched))
    if clash:
        raise ValueError(f"columns {clash} are on both sides; use keep= or select=")
    if spec.limits_cache and spec.cache_scope is None:
        spec = spec.replace(cache_scope=uuid.uuid4().hex)
    ident, values = key_columns(probe, keys)
    present = reduce(lambda a, b: a & b, [c.isNotNull() for c in values.values()], F.lit(True))
    sent = probe if null_keys == "request" else probe.where(present)
    if not (spec.cache == "PARTIAL" and not spec.limits_cache if dedup is None else dedup):
        return _join_row_by_row(
            sent, probe.where(~present) if how == "left" and null_keys != "request" else None,
            spec, keys, transport, how, select, metadata, wanted, fail_on_bad_request,
        )
    requests, on = distinct_requests(sent, spec, keys)
    counts = requests.select(*on, "n_rows")
    if fail_on_bad_request:
        requests = fail_on_request_error(requests)
    carry = on
    good = spread_calls(requests.where(F.col("error").isNull()), transport)
    outcome = fetch_outcomes(good, spec, transport, select, carry)
    rows = emit_rows(outcome, spec, metadata, carry, select)
    if not fail_on_bad_request and metadata:
        rows = rows.unionByName(_bad_request_rows(requests, carry, metadata), allowMissingColumns=True)
    if null_keys == "request":
        # Null keys are requests too, so they have to match: compare the keys as one value.
        whole = F.struct(*on)
        counts, rows = counts.withColumn("_whole", whole), rows.withColumn("_whole", whole).drop(*on)
        sides = probe.select(
            *wanted, F.struct(*[c.alias(n) for n, c in ident.items()]).alias("_whole")
        )
        on = ["_whole"]
    else:
        # A left join keeps rows with a null key, but under a key that matches nothing.
        keyed = {n: F.when(present, c) if how == "left" else c for n, c in ident.items()}
        base = sent if how == "inner" else probe
        sides = base.select(*wanted, *[c.alias(n) for n, c in keyed.items()])
    # Keys as text (those that hold a map) are larger than the columns they are made of.
    broadcast = set(ident) <= set(values)
    if skew:
        joined = salted_join(sides, rows, on, how, counts, "n_rows", broadcast=broadcast)
    else:
        joined = (sides if broadcast else sides.hint("merge")).join(rows, on, how)
    return joined.select(*wanted, *[F.col(f"`{c}`") for c in fetched])


def _join_row_by_row(
    sent: DataFrame,
    unsent: DataFrame | None,
    spec: LookupSpec,
    keys: Keys,
    transport: Transport,
    how: str,
    select: Sequence[str] | None,
    metadata: Sequence[str],
    wanted: Sequence[str],
    fail_on_bad_request: bool,
) -> DataFrame:
    # Probe columns travel with their request, under names no response column has.
    carried = {f"_w{i}": name for i, name in enumerate(wanted)}
    resolved = {f"_k{i}": (name, c) for i, (name, c, _) in enumerate(resolve_keys(sent, keys))}
    flat = sent.select(
        *[F.col(f"`{name}`").alias(alias) for alias, name in carried.items()],
        *[c.alias(alias) for alias, (_, c) in resolved.items()],
    )
    requests = with_requests(flat, spec, {name: alias for alias, (name, _) in resolved.items()})
    if fail_on_bad_request:
        requests = fail_on_request_error(requests)
    good = requests.where(F.col("error").isNull())
    if spec.limits_cache:
        good = route_calls(good, transport)
    outcome = fetch_outcomes(good, spec, transport, select, list(carried))
    rows = emit_rows(outcome, spec, metadata, list(carried), select, keep_empty=how == "left")
    if not fail_on_bad_request and (metadata or how == "left"):
        rows = rows.unionByName(_bad_request_rows(requests, list(carried), metadata), allowMissingColumns=True)
    rows = rows.withColumnsRenamed(carried)
    if unsent is not None:
        rows = rows.unionByName(unsent.select(*wanted), allowMissingColumns=True)
    return rows


def _bad_request_rows(requests: DataFrame, carry: Sequence[str], metadata: Sequence[str]) -> DataFrame:
    values = {"error-string": F.col("error"), "http-completion-state": F.lit(EXCEPTION)}
    known = [values[m].alias(m) for m in metadata if m in values]
    return requests.where(F.col("error").isNotNull()).select(*carry, *known)


def _call_counters() -> list[Column]:
    return [
        F.sum("n_rows").alias("probe_rows"),
        F.count(F.lit(1)).alias("calls"),
        (F.sum("n_rows") - F.count(F.lit(1))).alias("calls_saved"),
    ]


def call_counter(requests: DataFrame) -> DataFrame:
    """Probe rows, calls made for them, and calls saved by sending equal requests once."""
    return requests.agg(*_call_counters())


def observe_calls(requests: DataFrame) -> tuple[DataFrame, Observation]:
    """Distinct requests with the counters of ``call_counter`` observed as they are sent."""
    seen = Observation()
    return requests.observe(seen, *_call_counters()), seen

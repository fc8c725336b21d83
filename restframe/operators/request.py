"""Request planning: key columns -> method, URL, body, headers, request id. Columns only."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from urllib.parse import quote_plus

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from restframe.functions.formats import ENCODERS
from restframe.functions.headers import header_column
from restframe.functions.urls import form_encode, is_valid_url
from restframe.operators.keys import Key, key_leaves, key_text, leaves, resolve_keys
from restframe.spec import LookupSpec


@dataclass(frozen=True)
class RequestParts:
    """What a query creator yields: the query (GET) or body text, a query string to go with a
    body, path parameters."""

    query: Column
    url_params: Column | None = None
    path_params: Mapping[str, Column] = field(default_factory=dict)


QueryCreator = Callable[[Sequence[Key], LookupSpec], RequestParts]


def _form_pairs(leaves: Sequence[tuple[str, Column, bool]]) -> Column:
    """``name=value`` pairs, form-encoded; a null value leaves its pair out."""
    # The names are known when the query is planned, so this is one flat concatenation.
    pairs = [
        F.concat(F.lit(f"{quote_plus(name, safe='*')}=".replace("~", "%7E")), form_encode(text) if unsafe else text)
        for name, text, unsafe in leaves
    ]
    return F.concat_ws("&", *pairs)


def get_query(keys: Sequence[Key], spec: LookupSpec) -> RequestParts:
    return RequestParts(_form_pairs(key_leaves(keys, spec.date_keys)))


def json_query(keys: Sequence[Key], spec: LookupSpec) -> RequestParts:
    return RequestParts(ENCODERS[spec.request_format](list(keys), spec.request_options))


def search_query(keys: Sequence[Key], spec: LookupSpec) -> RequestParts:
    """Search-lite syntax; values go in as they are."""
    terms = [
        F.concat(F.lit(f"{name}:%22"), text, F.lit("%22")) for name, text, _ in key_leaves(keys, spec.date_keys)
    ]
    joined = F.concat_ws("%20AND%20", *terms)
    return RequestParts(F.when(joined == "", "").otherwise(F.concat(F.lit("q="), joined)))


def _leaf_map(keys: Sequence[Key]) -> dict[str, tuple[Column, T.DataType]]:
    flat = [leaf for key in keys for leaf in leaves(*key)]
    names = [name for name, _, _ in flat]
    doubled = sorted({n for n in names if names.count(n) > 1})
    if doubled:
        raise ValueError(f"key fields {doubled} are ambiguous for this query creator")
    return {name: (value, dtype) for name, value, dtype in flat}


def flexible_query(keys: Sequence[Key], spec: LookupSpec) -> RequestParts:
    """Chosen columns as query parameters, body fields and path segments."""
    flat = _leaf_map(keys)
    top = {name: (value, dtype) for name, value, dtype in keys}
    path = {
        insert: key_text(*flat[name], spec.date_keys)
        for name, insert in spec.url_map.items()
        if name in flat
    }
    if spec.is_get:
        pairs = []
        for name in dict.fromkeys(spec.query_param_fields):
            if name not in top:
                text = F.lit("null")
            elif isinstance(top[name][1], (T.StructType, T.ArrayType, T.MapType)):
                text = F.when(top[name][0].isNull(), "null").otherwise("")
            else:
                text = F.coalesce(key_text(*top[name], spec.date_keys), F.lit("null"))
            pairs.append(F.concat(F.lit(f"{name}="), form_encode(text)))
        return RequestParts(F.concat_ws("&", *pairs), path_params=path)
    body_keys = [key for key in keys if key[0] in spec.body_fields]
    body = ENCODERS[spec.request_format](body_keys, spec.request_options)
    chosen = {leaf[0]: leaf for leaf in key_leaves(keys, spec.date_keys)}
    wanted = [chosen[n] for n in sorted(set(spec.query_param_fields)) if n in chosen]
    return RequestParts(body, _form_pairs(wanted) if wanted else None, path)


QUERY_CREATORS: dict[str, QueryCreator] = {
    "generic-get-query": get_query,
    "generic-json-query": json_query,
    "generic-json-url": flexible_query,
    "elasticsearch-lite": search_query,
}


def register_query_creator(name: str, creator: QueryCreator) -> None:
    QUERY_CREATORS[name] = creator


def query_parts(keys: Sequence[Key], spec: LookupSpec) -> RequestParts:
    default = "generic-get-query" if spec.is_get else "generic-json-query"
    name = spec.query_creator or default
    if name not in QUERY_CREATORS:
        raise ValueError(f"unknown query creator {name!r}; known: {sorted(QUERY_CREATORS)}")
    return QUERY_CREATORS[name](keys, spec)


def _fill_path(base: str, params: Mapping[str, Column]) -> tuple[Column, str | None]:
    """The base URL with the first occurrence of each placeholder replaced, unencoded."""
    pieces: list[str | Column] = [base]
    for insert, value in params.items():
        mark = "{" + insert + "}"
        at = next((i for i, p in enumerate(pieces) if isinstance(p, str) and mark in p), None)
        if at is None:
            return F.lit(base), f"no placeholder {mark} in the URL"
        before, after = str(pieces[at]).split(mark, 1)
        # A null value leaves the placeholder in place, which the validity check reports.
        pieces[at : at + 1] = [before, F.coalesce(value, F.lit(mark)), after]
    columns = [F.lit(p) if isinstance(p, str) else p for p in pieces if not isinstance(p, str) or p]
    return F.concat(*columns), None


def assemble_url(
    base: str, query: Column | None = None, path_params: Mapping[str, Column] | None = None
) -> tuple[Column, str | None]:
    """Base + query (skipped when blank) with path parameters; and why that cannot work, if so."""
    url, problem = _fill_path(base, path_params or {})
    if query is not None:
        glue = "&" if "?" in base else "?"
        url = F.when(F.trim(F.coalesce(query, F.lit(""))) == "", url).otherwise(
            F.concat(url, F.lit(glue), query)
        )
    return url, problem


def request_id(method: Column, url: Column, body: Column) -> Column:
    # Never null, so joins on it need no null filter that would compute it again.
    return F.coalesce(F.sha2(F.concat_ws("|", method, url, body), 256), F.lit(""))


REQUEST_FIELDS = ("request_id", "method", "url", "body", "error")


def with_requests(
    probe: DataFrame, spec: LookupSpec, keys: Mapping[str, str | Column] | Sequence[str], prefix: str = ""
) -> DataFrame:
    """Add request_id, method, url, body and error of one request per row, named with ``prefix``."""
    parts = query_parts(resolve_keys(probe, keys), spec)
    # Each step is a column of its own: what later steps use more than once is computed once,
    # and the id is taken from exactly the bytes that are sent.
    query, url = f"{prefix}query", f"{prefix}url"
    if spec.is_get:
        staged = probe.withColumn(query, parts.query)
        address, problem = assemble_url(spec.url, F.col(query), parts.path_params)
        body = F.lit(None).cast("string")
    else:
        params = F.lit("") if parts.url_params is None else parts.url_params
        staged = probe.withColumn(query, params).withColumn(f"{prefix}body", parts.query)
        address, problem = assemble_url(spec.url, F.col(query), parts.path_params)
        body = F.col(f"{prefix}body")
    error = (
        F.lit(problem)
        if problem
        else F.when(~is_valid_url(F.col(url)), F.concat(F.lit("invalid URL: "), F.col(url)))
    )
    method = F.lit(spec.method.upper())
    return (
        staged.withColumn(url, address)
        .withColumns(
            {
                f"{prefix}method": method,
                f"{prefix}body": body,
                f"{prefix}error": error.cast("string"),
                f"{prefix}request_id": request_id(method, F.col(url), body),
            }
        )
        .drop(query)
    )


def plan_requests(
    probe: DataFrame,
    spec: LookupSpec,
    keys: Mapping[str, str | Column] | Sequence[str],
    keep: Sequence[str] = (),
    dynamic_headers: Mapping[str, Column] | None = None,
) -> DataFrame:
    """The request table: one row per probe row, the ``keep`` columns in front."""
    named = {f"_h{i}": c for i, c in enumerate((dynamic_headers or {}).values())}
    planned = with_requests(probe.withColumns(named) if named else probe, spec, keys, "_rq_")
    headers = header_column(spec.headers, dict(zip(dynamic_headers or {}, map(F.col, named), strict=True)))
    fields = [F.col(f"_rq_{f}").alias(f) for f in REQUEST_FIELDS]
    return planned.select(*keep, *fields, headers.alias("headers"))


def key_columns(
    probe: DataFrame, keys: Mapping[str, str | Column] | Sequence[str]
) -> tuple[dict[str, Column], dict[str, Column]]:
    """(columns that identify a key row, the key columns themselves), by generated names.

    Maps can be neither grouped nor joined on, so keys that hold one are identified by text.
    """
    resolved = resolve_keys(probe, keys)
    values = {f"_k{i}": c for i, (_, c, _) in enumerate(resolved)}
    if any("map<" in dtype.simpleString() for _, _, dtype in resolved):
        fields = F.struct(*[c.alias(name) for name, c in values.items()])
        # Never null: a null filter inferred on so wide an expression is very slow to optimize.
        # For the same reason callers put it behind the columns it is made of.
        return {"_key": F.coalesce(F.to_json(fields, {"ignoreNullFields": "false"}), F.lit(""))}, values
    return values, values


def distinct_requests(
    probe: DataFrame, spec: LookupSpec, keys: Mapping[str, str | Column] | Sequence[str]
) -> tuple[DataFrame, list[str]]:
    """One request per distinct key row with ``n_rows``, the probe rows behind it; and its key names.

    Keys are made distinct before the request is built: the probe rows of a hot key fold into
    one on the map side, and URLs are put together once per key, not once per row.
    """
    names = list(keys)
    ident, values = key_columns(probe, keys)
    keyed = probe.select(*[c.alias(n) for n, c in {**values, **ident}.items()])
    rest = [F.any_value(v).alias(v) for v in values if v not in ident]
    distinct = keyed.groupBy(*ident).agg(F.count(F.lit(1)).alias("n_rows"), *rest)
    requests = with_requests(distinct, spec, dict(zip(names, values, strict=True)))
    # Tied to the count, a filter on the error stays above the aggregation; it would otherwise
    # be pushed down and put together a URL for every probe row.
    tied = F.when(F.col("n_rows") > 0, F.col("error"))
    return requests.withColumn("error", tied), list(ident)


def fail_on_request_error(requests: DataFrame) -> DataFrame:
    """Stop the job on the first request that cannot be built."""
    return requests.where(
        F.when(
            F.col("error").isNotNull(),
            F.raise_error(F.concat(F.lit("cannot build the request: "), F.col("error"))).cast("boolean"),
        ).otherwise(True)
    )

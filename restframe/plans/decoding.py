"""Queries over response decoding and row emission."""

from __future__ import annotations

from pyspark.sql import functions as F

from restframe.functions.headers import grouped_headers
from restframe.operators.response import emit_rows, process_responses
from restframe.plans.base import RESPONSES_SQL, event_responses, query, table
from restframe.spec import ARRAY, LookupSpec

_URL = "http://events.example.com/k"


def _responses(spark, sf_dir, body_sql):
    return table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "cast(event_id as string) as request_id",
        "200 as status",
        f"{body_sql} as body",
        "cast(null as string) as io_error",
        "cast(null as map<string,array<string>>) as headers",
    )


# An object with a nested object, a missing field and an extra one.
NESTED_BODY = (
    "concat('{\"id\":', event_id, ',\"extra\":[1,2],\"profile\":{\"even\":', "
    "case when event_id % 2 = 0 then 'true' else 'false' end, ',\"account\":{\"owner\":\"u-', user_id, '\"}}"
    ",\"tags\":[\"', event_type, '\",\"t\"]}')"
)
_NESTED_DDL = (
    "id bigint, absent string, profile struct<even:boolean,account:struct<owner:string>>, tags array<string>"
)


@query(
    "decode_single",
    """
    select event_id, event_id as id, null::varchar as absent, event_id % 2 = 0 as active,
           'u-' || user_id as owner, event_type || ',t' as tags
    from events""",
)
def decode_single(spark, sf_dir):
    spec = LookupSpec(url=_URL, schema=_NESTED_DDL)
    rows = emit_rows(process_responses(_responses(spark, sf_dir, NESTED_BODY), spec), spec, (), ("event_id",))
    return rows.select(
        "event_id",
        "id",
        "absent",
        F.col("profile.even").alias("active"),
        F.col("profile.account.owner").alias("owner"),
        F.array_join("tags", ",").alias("tags"),
    )


# Two good elements around a null, for every third event one element more that does not fit.
ARRAY_BODY = (
    "concat('[', props, ',null,{\"k\":\"', user_id, '\",\"z\":1}', "
    "case when event_id % 3 = 0 then ',\"plain\"' else '' end, ']')"
)


@query(
    "decode_array",
    """
    select event_id, (props->>'k')::int as k, 'first' as which from events
    union all select event_id, user_id::int, 'second' from events""",
)
def decode_array(spark, sf_dir):
    spec = LookupSpec(
        url=_URL, schema="k int, z int", result_type=ARRAY, options={"json.ignore-parse-errors": "true"}
    )
    rows = emit_rows(process_responses(_responses(spark, sf_dir, ARRAY_BODY), spec), spec, (), ("event_id",))
    which = F.when(F.col("z").isNull(), "first").otherwise("second")
    return rows.select("event_id", "k", which.alias("which"))


BROKEN_BODY = (
    "case event_id % 6 when 0 then concat('not json ', event_type) when 1 then substring(props, 1, 6) "
    "when 2 then concat('[', props, ']') when 3 then concat('{\"k\":\"', user_id, '\"}') "
    "when 4 then concat('{\"k\":\"', event_type, '\"}') else props end"
)


@query(
    "decode_corrupt",
    """
    select event_id,
           case when event_id % 6 in (0, 1, 2, 4) then 'UNABLE_TO_DESERIALIZE_RESPONSE' else 'SUCCESS' end
             as completion_state,
           case event_id % 6 when 3 then user_id::int when 5 then (props->>'k')::int end as k
    from events""",
)
def decode_corrupt(spark, sf_dir):
    spec = LookupSpec(url=_URL, schema="k int", continue_on_error=True)
    outcome = process_responses(_responses(spark, sf_dir, BROKEN_BODY), spec)
    return outcome.select("event_id", "completion_state", F.get(F.col("rows"), F.lit(0))["k"].alias("k"))


@query(
    "decode_ignore_errors",
    """
    select event_id, 'SUCCESS' as completion_state,
           (event_id % 6 in (3, 4, 5))::int as n_rows,
           case event_id % 6 when 3 then user_id::int when 5 then (props->>'k')::int end as k
    from events""",
)
def decode_ignore_errors(spark, sf_dir):
    spec = LookupSpec(
        url=_URL, schema="k int", continue_on_error=True, options={"json.ignore-parse-errors": "true"}
    )
    outcome = process_responses(_responses(spark, sf_dir, BROKEN_BODY), spec)
    return outcome.select(
        "event_id",
        "completion_state",
        F.size("rows").alias("n_rows"),
        F.get(F.col("rows"), F.lit(0))["k"].alias("k"),
    )


@query(
    "decode_blank",
    """
    select event_id, 'SUCCESS' as completion_state, (event_id % 4 = 3)::int as n_rows
    from events""",
)
def decode_blank(spark, sf_dir):
    spec = LookupSpec(url=_URL, schema="k int")
    body = "case event_id % 4 when 0 then '' when 1 then '  \t ' when 2 then null else props end"
    outcome = process_responses(_responses(spark, sf_dir, body), spec)
    return outcome.select("event_id", "completion_state", F.size("rows").alias("n_rows"))


@query(
    "meta_headers",
    """
    select event_id, 2 as n_names, event_type || ';' || user_id as cookies, 'application/json' as content_type
    from events""",
)
def meta_headers(spark, sf_dir):
    pairs = F.expr(
        "array(named_struct('name', 'Set-Cookie', 'value', event_type), "
        "named_struct('name', 'Content-Type', 'value', 'application/json'), "
        "named_struct('name', 'Set-Cookie', 'value', cast(user_id as string)))"
    )
    grouped = table(spark, sf_dir, "events").select("event_id", grouped_headers(pairs).alias("headers"))
    return grouped.select(
        "event_id",
        F.size("headers").alias("n_names"),
        F.array_join(F.col("headers")["Set-Cookie"], ";").alias("cookies"),
        F.col("headers")["Content-Type"][0].alias("content_type"),
    )


_SPEC = LookupSpec(url=_URL, schema="k int, absent string", ignored_codes="404", continue_on_error=True)

_HAS_DATA = "io_error is null and status in (200, 201) and event_id % 11 <> 0 and event_id % 7 <> 0 and event_id % 5 <> 0"


@query(
    "emit_inner",
    f"""
    select event_id, (props->>'k')::int as k, null::varchar as absent
    from ({RESPONSES_SQL}) where {_HAS_DATA}""",
)
def emit_inner(spark, sf_dir):
    outcome = process_responses(event_responses(spark, sf_dir), _SPEC)
    return emit_rows(outcome, _SPEC, (), ("event_id",))


@query(
    "emit_with_metadata",
    f"""
    select event_id, case when {_HAS_DATA} then (props->>'k')::int end as k, null::varchar as absent,
           status as code, case when io_error is null then event_type || ',v1' end as type_header,
           case when io_error is not null then 'EXCEPTION' when status = 503 then 'HTTP_ERROR_STATUS'
                when status = 404 then 'IGNORE_STATUS_CODE' when event_id % 11 = 0 then 'SUCCESS'
                when event_id % 7 = 0 or event_id % 5 = 0 then 'UNABLE_TO_DESERIALIZE_RESPONSE'
                else 'SUCCESS' end as state
    from ({RESPONSES_SQL})""",
)
def emit_with_metadata(spark, sf_dir):
    outcome = process_responses(event_responses(spark, sf_dir), _SPEC)
    rows = emit_rows(
        outcome, _SPEC, ("http-status-code", "http-headers-map", "http-completion-state"), ("event_id",)
    )
    return rows.select(
        "event_id",
        "k",
        "absent",
        F.col("`http-status-code`").alias("code"),
        F.array_join(F.col("`http-headers-map`")["X-Type"], ",").alias("type_header"),
        F.col("`http-completion-state`").alias("state"),
    )

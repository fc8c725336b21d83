"""Queries over status rules and completion states."""

from __future__ import annotations

from pyspark.sql import functions as F

from restframe.functions.codes import classify, code_set, is_sink_error, parse_code_set, rule_error
from restframe.operators.response import fail_on_error, process_responses
from restframe.plans.base import RESPONSES_SQL, event_responses, query, table
from restframe.spec import LookupSpec

RULE = (
    "case when s_suppkey % 7 = 3 then concat('2XX, ', s_suppkey, 'X') "
    "when s_suppkey % 7 = 5 then '!404, !405' "
    "else concat('  ', s_suppkey % 5 + 1, 'xX,', 100 + (s_suppkey * 37) % 500, ' ,!', "
    "100 + (s_suppkey * 11) % 500, ',') end"
)
RETRY_RULE = "case when s_suppkey % 4 = 0 then '5XX,!501' else '503,504' end"

_CODES_CTE = """
    {name}_tok as (select s_suppkey, trim(u.t) as tok from rules, unnest(string_split({column}, ',')) as u(t)
                   where trim(u.t) <> ''),
    {name}_bad as (select distinct s_suppkey from {name}_tok where not (
        regexp_full_match(tok, '[1-5][xX][xX]')
        or (regexp_full_match(tok, '!?[0-9]+') and try_cast(replace(tok, '!', '') as int) between 100 and 599))),
    {name} as (select distinct t.s_suppkey, c.code from {name}_tok t join codes c
        on (regexp_full_match(tok, '[1-5][xX][xX]') and c.code // 100 = left(tok, 1)::int)
        or (regexp_full_match(tok, '[0-9]+') and c.code = try_cast(tok as int))
        where t.s_suppkey not in (select s_suppkey from {name}_bad)
          and not exists (select 1 from {name}_tok x
                          where x.s_suppkey = t.s_suppkey and x.tok = '!' || c.code))"""


@query(
    "code_set",
    f"""
    with rules as (select s_suppkey, {RULE} as rule, {RETRY_RULE} as retry from supplier),
    codes as (select unnest(range(100, 600)) as code),
    {_CODES_CTE.format(name='succ', column='rule')},
    {_CODES_CTE.format(name='ret', column='retry')},
    problem as (select s_suppkey, case
        when s_suppkey in (select s_suppkey from succ_bad) then 'invalid code expression'
        when s_suppkey not in (select s_suppkey from succ) then 'empty success codes'
        when s_suppkey in (select succ.s_suppkey from succ join ret using (s_suppkey, code))
          then 'success and retry codes overlap' end as problem from rules)
    select r.s_suppkey, s.code::int as code, p.problem
    from rules r left join succ s using (s_suppkey) join problem p using (s_suppkey)""",
)
def code_set_query(spark, sf_dir):
    rules = table(spark, sf_dir, "supplier").selectExpr("s_suppkey", f"{RULE} as rule", f"{RETRY_RULE} as retry")
    sets = rules.withColumn("success", code_set(F.col("rule"))).withColumn("retrying", code_set(F.col("retry")))
    return sets.select(
        "s_suppkey",
        F.explode_outer("success").alias("code"),
        rule_error(F.col("success"), F.col("retrying")).alias("problem"),
    )


@query(
    "status_classify",
    """
    with e as (select event_id, (100 + event_id % 500)::int as status from events)
    select event_id, status, case
        when status = 409 then 'IGNORED'
        when (status between 200 and 299 and status <> 202) or status = 404 then 'SUCCESS'
        when (status between 400 and 499) or status in (500, 501, 502) then 'RETRY'
        else 'ERROR' end as class
    from e""",
)
def status_classify(spark, sf_dir):
    status = (F.lit(100) + F.col("event_id") % 500).cast("int")
    rules = [parse_code_set(rule) for rule in ("2XX,404,!202", "4XX,!404,500,501,502,!409", "409")]
    return table(spark, sf_dir, "events").select(
        "event_id", status.alias("status"), classify(status, *rules).alias("class")
    )


@query(
    "sink_status_error",
    """
    with e as (select event_id, (100 + event_id % 500)::int as status from events)
    select event_id, status // 100 in (4, 5) as by_default,
           (status // 100 in (3, 4) or status = 500) and status not in (404, 300) as by_rules
    from e""",
)
def sink_status_error(spark, sf_dir):
    status = (F.lit(100) + F.col("event_id") % 500).cast("int")
    return table(spark, sf_dir, "events").select(
        "event_id",
        is_sink_error(status).alias("by_default"),
        is_sink_error(status, "3xx, 4XX, ,500", "404, 300").alias("by_rules"),
    )


_SPEC = LookupSpec(
    url="http://events.example.com/k",
    schema="k int, absent string",
    success_codes="2XX",
    ignored_codes="404",
    continue_on_error=True,
)

_STATE = """case
        when io_error is not null then 'EXCEPTION'
        when status = 503 then 'HTTP_ERROR_STATUS'
        when status = 404 then 'IGNORE_STATUS_CODE'
        when trim(body) = '' then 'SUCCESS'
        when event_id % 7 = 0 or event_id % 5 = 0 then 'UNABLE_TO_DESERIALIZE_RESPONSE'
        else 'SUCCESS' end"""


def _outcome(spark, sf_dir, spec=_SPEC):
    return process_responses(event_responses(spark, sf_dir), spec)


@query(
    "completion_state",
    f"select event_id, {_STATE} as completion_state from ({RESPONSES_SQL})",
)
def completion_state(spark, sf_dir):
    return _outcome(spark, sf_dir).select("event_id", "completion_state")


@query(
    "status_ignored",
    f"""
    select event_id, {_STATE} as completion_state, 0 as n_rows
    from ({RESPONSES_SQL}) where status = 404""",
)
def status_ignored(spark, sf_dir):
    kept = _outcome(spark, sf_dir).where("completion_state = 'IGNORE_STATUS_CODE'")
    return kept.select("event_id", "completion_state", F.size("rows").alias("n_rows"))


@query(
    "meta_error_string",
    f"""
    select event_id, case {_STATE} when 'EXCEPTION' then io_error when 'HTTP_ERROR_STATUS' then body
           when 'UNABLE_TO_DESERIALIZE_RESPONSE' then body end as error_string
    from ({RESPONSES_SQL})""",
)
def meta_error_string(spark, sf_dir):
    return _outcome(spark, sf_dir).select("event_id", "error_string")


@query("meta_status", f"select event_id, status from ({RESPONSES_SQL})")
def meta_status(spark, sf_dir):
    return _outcome(spark, sf_dir).select("event_id", "status")


@query(
    "continue_on_error",
    f"""
    select event_id, {_STATE} as completion_state, true as kept
    from ({RESPONSES_SQL})""",
)
def continue_on_error(spark, sf_dir):
    # With errors survived the check lets every row through.
    kept = fail_on_error(_outcome(spark, sf_dir), _SPEC)
    return kept.select("event_id", "completion_state", F.lit(True).alias("kept"))

"""Queries over attempt logs: schedules, resolution, counters."""

from __future__ import annotations

from pyspark.sql import functions as F

from restframe.operators.retry import resolve_attempts, retry_counters, with_schedule
from restframe.plans.base import EVENT_STATUS, query, table
from restframe.spec import EXPONENTIAL_DELAY, LookupSpec

SPEC = LookupSpec(url="http://events.example.com/k", schema="k int", max_retries=2)

# Five neighbouring events are the attempts of one request.
_ATTEMPTS = f"""
    select event_id // 5 as request, (event_id % 5 + 1)::int as attempt,
           case when event_id % 13 <> 0 then {EVENT_STATUS} end as status,
           case when event_id % 13 <> 0 then props end as body,
           case when event_id % 13 = 0 then 'reset' end as io_error
    from events"""


def attempts(spark, sf_dir):
    return table(spark, sf_dir, "events").selectExpr(
        "event_id div 5 as request",
        "cast(event_id % 5 + 1 as int) as attempt",
        f"case when event_id % 13 <> 0 then {EVENT_STATUS} end as status",
        "case when event_id % 13 <> 0 then props end as body",
        "case when event_id % 13 = 0 then 'reset' end as io_error",
    )


@query(
    "retry_schedule_fixed",
    f"""
    select request, attempt, case when attempt = 1 then 0 else 250 end::bigint as wait_ms,
           ((attempt - 1) * 250)::bigint as cumulative_wait_ms
    from ({_ATTEMPTS}) where attempt <= 4""",
)
def retry_schedule_fixed(spark, sf_dir):
    spec = SPEC.replace(max_retries=3, fixed_delay=0.25)
    scheduled = with_schedule(attempts(spark, sf_dir), spec)
    return scheduled.select("request", "attempt", "wait_ms", "cumulative_wait_ms")


@query(
    "retry_schedule_exp",
    f"""
    with a as (select request, attempt from ({_ATTEMPTS}) where attempt <= 5)
    select request, attempt,
           case when attempt = 1 then 0 else least(60, 15 * 2 ** (attempt - 2)) end::bigint as wait_ms,
           coalesce((select sum(least(60, 15 * 2 ** (u.n - 1))) from range(1, 5) u(n) where u.n < attempt), 0)::bigint
             as cumulative_wait_ms
    from a""",
)
def retry_schedule_exp(spark, sf_dir):
    spec = SPEC.replace(
        max_retries=4,
        retry_strategy=EXPONENTIAL_DELAY,
        initial_backoff=0.015,
        max_backoff=0.060,
        backoff_multiplier=2.0,
    )
    scheduled = with_schedule(attempts(spark, sf_dir), spec)
    return scheduled.select("request", "attempt", "wait_ms", "cumulative_wait_ms")


_RESOLVED = f"""
    with a as (select * from ({_ATTEMPTS}) where attempt <= 3),
    f as (select request, coalesce(min(attempt) filter (where io_error is null and status not in (500, 503, 504)),
                                   max(attempt)) as n_attempts
          from a group by request)
    select a.request, f.n_attempts, a.status, a.body, a.io_error
    from a join f on a.request = f.request and a.attempt = f.n_attempts"""


@query("retry_resolve", _RESOLVED)
def retry_resolve(spark, sf_dir):
    return resolve_attempts(attempts(spark, sf_dir), SPEC, ["request"])


@query(
    "retry_metrics",
    f"""
    select (request % 16)::int as endpoint,
           count(*) filter (where io_error is null and status between 200 and 299 and n_attempts > 1)
             as successful_with_retry,
           count(*) filter (where io_error is null and status between 200 and 299 and n_attempts = 1)
             as successful_without_retry,
           count(*) filter (where io_error is not null or status not between 200 and 299) as failed
    from ({_RESOLVED}) group by all""",
)
def retry_metrics(spark, sf_dir):
    final = resolve_attempts(attempts(spark, sf_dir), SPEC, ["request"])
    return retry_counters(
        final.withColumn("endpoint", (F.col("request") % 16).cast("int")), SPEC, ["endpoint"]
    )

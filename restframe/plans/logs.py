"""Queries over log lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from restframe.functions.loglines import body_text, exception_line, request_line, response_line
from restframe.plans.base import EVENT_STATUS, query, table

_HEADERS = (
    "case when event_id % 3 <> 0 then map('X-Type', array(event_type, 'v1'), 'Accept', array('json')) end as headers"
)
_HEADERS_TEXT = "case when event_id % 3 <> 0 then 'Accept:[json];X-Type:[' || event_type || ';v1]' else 'None' end"


def _calls(spark, sf_dir):
    return table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "event_type",
        "case when event_id % 2 = 0 then 'GET' else 'POST' end as method",
        "concat('http://events.example.com/', event_id) as url",
        _HEADERS,
        f"{EVENT_STATUS} as status",
        "case event_id % 4 when 0 then null when 1 then '' else props end as body",
    )


_LINE = "'HTTP ' || case when event_id % 2 = 0 then 'GET' else 'POST' end || '"
_AT = " URL: http://events.example.com/' || event_id || '"


@query(
    "log_request",
    f"""
    select event_id,
           {_LINE} Request:{_AT}, Headers: ' || case when event_id % 3 <> 0 then '***' else 'None' end as min_line,
           {_LINE} Request:{_AT}, Headers: ' || {_HEADERS_TEXT} as max_line
    from events""",
)
def log_request(spark, sf_dir):
    method, url, headers = F.col("method"), F.col("url"), F.col("headers")
    return _calls(spark, sf_dir).select(
        "event_id",
        request_line(method, url, headers).alias("min_line"),
        request_line(method, url, headers, "MAX").alias("max_line"),
    )


@query(
    "log_response",
    f"""
    with e as (select *, case event_id % 4 when 0 then null when 1 then '' else props end as body,
                      {EVENT_STATUS} as status from events)
    select event_id,
           {_LINE} Response:{_AT}, Response Headers: ' || case when event_id % 3 <> 0 then '***' else 'None' end
             || ', status code: ' || status || ', Response Body: '
             || case when coalesce(body, '') = '' then 'None' else '***' end as min_line,
           {_LINE} Response:{_AT}, Response Headers: ' || {_HEADERS_TEXT}
             || ', status code: ' || status || ', Response Body: '
             || case when coalesce(body, '') = '' then 'None' else body end as max_line
    from e""",
)
def log_response(spark, sf_dir):
    parts = [F.col(c) for c in ("method", "url", "headers", "status", "body")]
    return _calls(spark, sf_dir).select(
        "event_id", response_line(*parts).alias("min_line"), response_line(*parts, "MAX").alias("max_line")
    )


@query(
    "log_body",
    f"""
    with e as (select *, case event_id % 4 when 0 then null when 1 then '' else props end as body from events)
    select event_id, case when coalesce(body, '') = '' then 'None' else '***' end as min_body,
           case when coalesce(body, '') = '' then 'None' else body end as full_body,
           {_LINE} Exception Response:{_AT} Exception ' || event_type as exception_line
    from e""",
)
def log_body(spark, sf_dir):
    return _calls(spark, sf_dir).select(
        "event_id",
        body_text(F.col("body"), "MIN").alias("min_body"),
        body_text(F.col("body"), "REQRESPONSE").alias("full_body"),
        exception_line(F.col("method"), F.col("url"), F.col("event_type")).alias("exception_line"),
    )

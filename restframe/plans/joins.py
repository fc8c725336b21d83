"""Queries over lookup joins, transports and the streaming join."""

from __future__ import annotations

import json
from urllib.parse import parse_qs, urlsplit

from pyspark.sql import functions as F

from restframe.operators.audit import audit_log
from restframe.operators.lookup import lookup_join
from restframe.operators.request import plan_requests
from restframe.plans.base import query, stream, table
from restframe.session import new_dir
from restframe.sources.sqlapi import register_fetch, register_fetch_table
from restframe.sources.transport import CallableTransport, ReplayTransport, TableTransport
from restframe.spec import ARRAY, LookupSpec
from restframe.streaming.enrich import enrich_stream

CUSTOMER = LookupSpec(
    url="http://customers.example.com/v1/customer",
    schema="c_custkey bigint, c_name string, c_mktsegment string, c_nationkey int",
    ignored_codes="404",
)


def _customer_endpoint(spark, sf_dir, where="true"):
    served = table(spark, sf_dir, "customer").where(where)
    return TableTransport(served, {"c_custkey": "c_custkey"})


def orders_with_customer(spark, sf_dir):
    return lookup_join(
        table(spark, sf_dir, "orders"),
        CUSTOMER,
        {"c_custkey": "o_custkey"},
        _customer_endpoint(spark, sf_dir),
        select=["c_name", "c_mktsegment"],
        keep=["o_orderkey"],
    )


query(
    "lookup_join",
    "select o_orderkey, c_name, c_mktsegment from orders join customer on o_custkey = c_custkey",
)(orders_with_customer)


@query(
    "lookup_join_left",
    """
    select o_orderkey, c_name, c_mktsegment
    from orders left join (select * from customer where c_custkey % 3 <> 0)
      on c_custkey = case when o_orderkey % 10 <> 0 then o_custkey end""",
)
def lookup_join_left(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn(
        "cust", F.when(F.col("o_orderkey") % 10 != 0, F.col("o_custkey"))
    )
    return lookup_join(
        orders,
        CUSTOMER,
        {"c_custkey": "cust"},
        _customer_endpoint(spark, sf_dir, "c_custkey % 3 <> 0"),
        how="left",
        select=["c_name", "c_mktsegment"],
        keep=["o_orderkey"],
    )


@query(
    "lookup_join_struct",
    """
    select c_custkey, n_name from customer
    join nation on n_nationkey = c_nationkey and n_regionkey = c_custkey % 5""",
)
def lookup_join_struct(spark, sf_dir):
    spec = LookupSpec(
        url="http://geo.example.com/nation",
        schema="place struct<n_nationkey:int,n_regionkey:int>, n_name string",
        ignored_codes="404",
    )
    place = F.struct(
        F.col("c_nationkey").alias("n_nationkey"), (F.col("c_custkey") % 5).cast("int").alias("n_regionkey")
    )
    nation = table(spark, sf_dir, "nation").withColumn("place", F.struct("n_nationkey", "n_regionkey"))
    return lookup_join(
        table(spark, sf_dir, "customer"),
        spec,
        {"place": place},
        TableTransport(nation, ["place"]),
        select=["n_name"],
        keep=["c_custkey"],
    )


@query(
    "lookup_join_mixed",
    """
    select c_custkey, n_regionkey as region from customer
    join nation on n_name = 'NATION_' || c_nationkey and n_nationkey = c_nationkey""",
)
def lookup_join_mixed(spark, sf_dir):
    spec = LookupSpec(
        url="http://geo.example.com/nation",
        schema="nation_name string, nation struct<n_nationkey:int>, region int",
        method="POST",
    )
    nation = table(spark, sf_dir, "nation").selectExpr(
        "n_name as nation_name", "named_struct('n_nationkey', n_nationkey) as nation", "n_regionkey as region"
    )
    return lookup_join(
        table(spark, sf_dir, "customer"),
        spec,
        {
            "nation_name": F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")),
            "nation": F.struct(F.col("c_nationkey").alias("n_nationkey")),
        },
        TableTransport(nation, ["nation_name", "nation"]),
        select=["region"],
        keep=["c_custkey"],
    )


@query(
    "lookup_join_nested",
    """
    select l_orderkey, l_linenumber, l_partkey, l_suppkey, s_name as supplier
    from lineitem join supplier on s_suppkey = l_suppkey and s_nationkey = l_partkey % 25""",
)
def lookup_join_nested(spark, sf_dir):
    spec = LookupSpec(
        url="http://parts.example.com/supplier",
        schema="supplied_by struct<s_suppkey:bigint,place:struct<s_nationkey:int>>, supplier string",
        method="POST",
        ignored_codes="404",
    )
    suppliers = table(spark, sf_dir, "supplier").selectExpr(
        "named_struct('s_suppkey', s_suppkey, 'place', named_struct('s_nationkey', s_nationkey)) as supplied_by",
        "s_name as supplier",
    )
    nested = F.expr(
        "named_struct('s_suppkey', l_suppkey, 'place', named_struct('s_nationkey', cast(l_partkey % 25 as int)))"
    )
    keep = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return lookup_join(
        table(spark, sf_dir, "lineitem"),
        spec,
        {"supplied_by": nested},
        TableTransport(suppliers, ["supplied_by"]),
        select=["supplier"],
        keep=keep,
    )


# One key column per type, each from columns of orders.
TYPED_KEYS = {
    "is_final": "o_orderstatus = 'F'",
    "day_of_month": "cast(day(o_orderdate) as tinyint)",
    "year_placed": "cast(year(o_orderdate) as smallint)",
    "custkey": "cast(o_custkey as int)",
    "orderkey": "o_orderkey",
    "quarter_key": "cast(o_custkey as float) / 4",
    "priority": "o_orderpriority",
    "eighth_key": "cast(o_custkey / 8 as decimal(25,6))",
    "key_and_half": "array(cast(o_custkey as double), 0.5D)",
    "placed_on": "cast(o_orderdate as date)",
    "placed_at_time": "date_format(o_orderdate, 'HH:mm:ss')",
    "placed_local": "cast(o_orderdate as timestamp_ntz)",
    "placed": "cast(o_orderdate as timestamp)",
    "key_by_status": "map(o_orderstatus, o_custkey)",
    "nested_by_status": "map(o_orderstatus, map(o_orderpriority, cast(o_custkey as int)))",
    "buyer": "named_struct('o_custkey', cast(o_custkey as int), 'o_orderstatus', o_orderstatus)",
    "handling": "named_struct('o_orderstatus', o_orderstatus, 'urgency', named_struct('o_orderpriority', o_orderpriority))",
    "buyers": "array(named_struct('o_orderstatus', o_orderstatus, 'weight', cast(o_custkey as float)))",
}


@query(
    "lookup_join_types",
    """
    select o_orderkey, 'order-' || o_orderkey as label, o_custkey::int as custkey, o_orderstatus as status
    from orders""",
)
def lookup_join_types(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    typed = orders.select("*", *[F.expr(e).alias(n) for n, e in TYPED_KEYS.items()])
    served = typed.withColumn("label", F.concat(F.lit("order-"), F.col("o_orderkey")))
    schema = served.select(*TYPED_KEYS, "label").schema
    spec = LookupSpec(url="http://orders.example.com/typed", schema=schema, method="POST")
    joined = lookup_join(
        typed.select("o_orderkey", *[F.col(n).alias(f"k_{n}") for n in TYPED_KEYS]),
        spec,
        {n: f"k_{n}" for n in TYPED_KEYS},
        TableTransport(served, list(TYPED_KEYS)),
        select=["label", "custkey", "buyer.o_orderstatus"],
        keep=["o_orderkey"],
    )
    return joined.select("o_orderkey", "label", "custkey", F.col("buyer.o_orderstatus").alias("status"))


@query(
    "lookup_join_array",
    "select c_custkey, o_orderkey, o_orderstatus from customer join orders on o_custkey = c_custkey",
)
def lookup_join_array(spark, sf_dir):
    spec = LookupSpec(
        url="http://orders.example.com/by-customer",
        schema="o_custkey bigint, o_orderkey bigint, o_orderstatus string",
        result_type=ARRAY,
        ignored_codes="404",
    )
    return lookup_join(
        table(spark, sf_dir, "customer"),
        spec,
        {"o_custkey": "c_custkey"},
        TableTransport(table(spark, sf_dir, "orders"), ["o_custkey"]),
        select=["o_orderkey", "o_orderstatus"],
        keep=["c_custkey"],
    )


@query(
    "lookup_metadata",
    """
    select o_orderkey, c_name, case when c_custkey is null then 404 else 200 end as code,
           case when c_custkey is null then 'HTTP_ERROR_STATUS' else 'SUCCESS' end as state,
           null::varchar as problem, 'application/json' as content_type
    from orders left join (select * from customer where c_custkey % 3 <> 0) on c_custkey = o_custkey""",
)
def lookup_metadata(spark, sf_dir):
    joined = lookup_join(
        table(spark, sf_dir, "orders"),
        CUSTOMER.replace(ignored_codes="", continue_on_error=True),
        {"c_custkey": "o_custkey"},
        _customer_endpoint(spark, sf_dir, "c_custkey % 3 <> 0"),
        select=["c_name"],
        keep=["o_orderkey"],
        metadata=["http-status-code", "http-completion-state", "error-string", "http-headers"],
    )
    return joined.select(
        "o_orderkey",
        "c_name",
        F.col("`http-status-code`").alias("code"),
        F.col("`http-completion-state`").alias("state"),
        F.col("`error-string`").alias("problem"),
        F.col("`http-headers`")["Content-Type"][0].alias("content_type"),
    )


@query(
    "lookup_projection",
    """
    select o_orderkey, c_mktsegment as segment
    from orders join customer on o_custkey = c_custkey""",
)
def lookup_projection(spark, sf_dir):
    spec = LookupSpec(
        url=CUSTOMER.url,
        schema="c_custkey bigint, c_name string, "
        "details struct<active:boolean,nested:struct<segment:string,nation:int>>",
    )
    customers = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey",
        "c_name",
        "named_struct('active', true, 'nested', named_struct('segment', c_mktsegment, 'nation', c_nationkey)) as details",
    )
    joined = lookup_join(
        table(spark, sf_dir, "orders"),
        spec,
        {"c_custkey": "o_custkey"},
        TableTransport(customers, ["c_custkey"]),
        select=["details.nested.segment"],
        keep=["o_orderkey"],
    )
    return joined.select("o_orderkey", F.col("details.nested.segment").alias("segment"))


def echo(request):
    """An endpoint that answers from the request alone: the part number and twice that."""
    part = int(parse_qs(urlsplit(request["url"]).query)["part"][0])
    if part % 10 == 0:
        return {"status": 404, "body": "no such part"}
    return {"status": 200, "headers": {"X-Part": str(part)}, "body": json.dumps({"part": part, "twice": 2 * part})}


_ECHO_SQL = """
    select l_orderkey, l_linenumber, l_partkey, l_suppkey, 2 * l_partkey as twice
    from lineitem where l_partkey % 10 <> 0"""


def _echo_join(spark, sf_dir, async_polling):
    spec = LookupSpec(
        url="http://parts.example.com/double",
        schema="part bigint, twice bigint",
        ignored_codes="404",
        async_polling=async_polling,
    )
    keep = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return lookup_join(
        table(spark, sf_dir, "lineitem"),
        spec,
        {"part": "l_partkey"},
        CallableTransport(echo),
        select=["twice"],
        keep=keep,
    )


@query("lookup_sync", _ECHO_SQL)
def lookup_sync(spark, sf_dir):
    return _echo_join(spark, sf_dir, async_polling=False)


@query("lookup_async", _ECHO_SQL)
def lookup_async(spark, sf_dir):
    return _echo_join(spark, sf_dir, async_polling=True)


@query(
    "lookup_uncached",
    """
    select l_orderkey, l_linenumber, l_partkey, l_suppkey, case when l_partkey % 10 <> 0 then 2 * l_partkey end as twice
    from lineitem""",
)
def lookup_uncached(spark, sf_dir):
    """One call per row, as without a cache; a left join."""
    spec = LookupSpec(
        url="http://parts.example.com/double",
        schema="part bigint, twice bigint",
        ignored_codes="404",
        cache="NONE",
    )
    keep = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return lookup_join(
        table(spark, sf_dir, "lineitem"),
        spec,
        {"part": "l_partkey"},
        CallableTransport(echo),
        how="left",
        select=["twice"],
        keep=keep,
    )


@query(
    "lookup_sql",
    """
    select p_partkey, case when p_partkey % 10 = 0 then 404 else 200 end as status,
           case when p_partkey % 10 <> 0 then 2 * p_partkey end as twice
    from part""",
)
def lookup_sql(spark, sf_dir):
    """The calls of a table from SQL, eight at a time in each task."""
    spec = LookupSpec(url="http://parts.example.com/double", schema="part bigint, twice bigint", async_polling=True)
    register_fetch_table(spark, "fetch_parts", spec, echo, carry="p_partkey bigint")
    planned = plan_requests(table(spark, sf_dir, "part"), spec, {"part": "p_partkey"}, ["p_partkey"])
    planned.createOrReplaceTempView("part_requests")
    return spark.sql(
        """
        select p_partkey, status, from_json(body, 'twice bigint').twice as twice
        from fetch_parts(table(part_requests))"""
    )


@query(
    "lookup_sql_row",
    """
    select p_partkey, case when p_partkey % 10 = 0 then 404 else 200 end as status,
           case when p_partkey % 10 <> 0 then 2 * p_partkey end as twice
    from part""",
)
def lookup_sql_row(spark, sf_dir):
    """The same by a lateral join, one call for each row."""
    spec = LookupSpec(url="http://parts.example.com/double", schema="part bigint, twice bigint")
    register_fetch(spark, "fetch_part", spec, echo)
    planned = plan_requests(table(spark, sf_dir, "part"), spec, {"part": "p_partkey"}, ["p_partkey"])
    return spark.sql(
        """
        select r.p_partkey, f.status, from_json(f.body, 'twice bigint').twice as twice
        from {requests} r join lateral fetch_part(r.method, r.url, r.body) f on true""",
        requests=planned,
    )


def _captured(spark, sf_dir):
    """Captured attempts for the lineitem requests: one fails first, some never succeed."""
    spec = LookupSpec(url="http://parts.example.com/stock", schema="part bigint, qty bigint", ignored_codes="404")
    lines = table(spark, sf_dir, "lineitem")
    parts = table(spark, sf_dir, "part").withColumnRenamed("p_partkey", "part")
    requests = plan_requests(parts, spec, ["part"], ["part"])
    attempts = requests.selectExpr(
        "request_id",
        "part",
        "explode(sequence(1, case when part % 3 = 0 then 2 else 1 end)) as attempt",
    ).selectExpr(
        "request_id",
        "attempt",
        "case when part % 3 = 0 and attempt = 1 then 503 when part % 5 = 0 then 404 else 200 end as status",
        "cast(null as map<string,array<string>>) as headers",
        "concat('{\"part\":', part, ',\"qty\":', part * 3, '}') as body",
        "cast(null as string) as io_error",
    )
    return spec, lines, attempts


@query(
    "replay_responses",
    """
    select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_partkey * 3 as qty
    from lineitem where l_partkey % 5 <> 0 and l_partkey in (select p_partkey from part)""",
)
def replay_responses(spark, sf_dir):
    spec, lines, attempts = _captured(spark, sf_dir)
    keep = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return lookup_join(
        lines, spec, {"part": "l_partkey"}, ReplayTransport(attempts), select=["qty"], keep=keep
    )


@query(
    "audit_log",
    """
    select p_partkey, 'HTTP GET Request: URL: http://parts.example.com/double?part=' || p_partkey
             || ', Headers: X-Client:[restframe]' as request_line,
           'HTTP GET Response: URL: http://parts.example.com/double?part=' || p_partkey
             || case when p_partkey % 10 = 0
                then ', Response Headers: None, status code: 404, Response Body: no such part'
                else ', Response Headers: X-Part:[' || p_partkey || '], status code: 200, Response Body: {"part": '
                     || p_partkey || ', "twice": ' || 2 * p_partkey || '}' end as response_line
    from part""",
)
def audit_log_query(spark, sf_dir):
    spec = LookupSpec(
        url="http://parts.example.com/double", schema="part bigint", headers={"X-Client": "restframe"}
    )
    requests = plan_requests(table(spark, sf_dir, "part"), spec, {"part": "p_partkey"}, ["p_partkey"])
    responses = CallableTransport(echo).fetch(requests, spec)
    log = audit_log(requests, responses, "MAX").join(requests.select("request_id", "p_partkey"), "request_id")
    return log.select("p_partkey", "request_line", "response_line")


@query(
    "lookup_stream",
    "select o_orderkey, c_name, c_mktsegment from orders join customer on o_custkey = c_custkey",
)
def lookup_stream(spark, sf_dir):
    path, checkpoint = new_dir(spark, "enriched"), new_dir(spark, "enriched-state")
    running = enrich_stream(
        stream(spark, sf_dir, "orders"),
        CUSTOMER,
        {"c_custkey": "o_custkey"},
        _customer_endpoint(spark, sf_dir),
        path,
        checkpoint,
        select=["c_name", "c_mktsegment"],
        keep=["o_orderkey"],
    )
    running.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(path).select("o_orderkey", "c_name", "c_mktsegment")



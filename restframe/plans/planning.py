"""Queries over request planning: keys, query creators, URLs, headers, tokens."""

from __future__ import annotations

from pyspark.sql import functions as F

from restframe.functions.formats import encode_csv, register_format
from restframe.functions.headers import basic_auth
from restframe.functions.urls import (
    add_parameter,
    form_encode,
    is_valid_url,
    query_params,
    url_query,
)
from restframe.operators.keys import lookup_args, resolve_keys
from restframe.operators.request import (
    RequestParts,
    assemble_url,
    flexible_query,
    get_query,
    json_query,
    plan_requests,
    query_parts,
    register_query_creator,
    search_query,
)
from restframe.operators.tokens import assign_tokens
from restframe.plans.base import encode_sql, query, table
from restframe.spec import LookupSpec

ORDER_URL = "http://orders.example.com/v1/order"


def _spec(**changes) -> LookupSpec:
    return LookupSpec(url=ORDER_URL, schema="id bigint").replace(**changes)


@query(
    "key_args",
    """
    with args as (
      select c_custkey, list_filter([
          {'name': 'c_custkey', 'value': c_custkey::varchar},
          {'name': 'c_nationkey', 'value': case when c_nationkey % 5 <> 0 then c_nationkey::varchar end},
          {'name': 'segment', 'value':
             case when c_nationkey % 5 <> 0 and c_custkey % 3 <> 0 then c_mktsegment end},
          {'name': 'c_name', 'value': case when c_custkey % 7 <> 0 then c_name end}
        ], lambda x: x.value is not null) as args
      from customer)
    select c_custkey, pos::int as pos, args[pos + 1].name as name, args[pos + 1].value as value
    from (select c_custkey, args, unnest(range(len(args))) as pos from args)""",
)
def key_args(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey",
        "case when c_nationkey % 5 <> 0 then named_struct('c_nationkey', c_nationkey, 'inner', "
        "case when c_custkey % 3 <> 0 then named_struct('segment', c_mktsegment) end) end as place",
        "case when c_custkey % 7 <> 0 then c_name end as c_name",
    )
    keys = resolve_keys(customers, ["c_custkey", "place", "c_name"])
    exploded = customers.select("c_custkey", F.posexplode(lookup_args(keys)).alias("pos", "arg"))
    return exploded.select("c_custkey", "pos", "arg.name", "arg.value")


@query(
    "query_get",
    f"""
    select o_orderkey, 'id=' || o_orderkey || '&priority=' || {encode_sql('o_orderpriority')}
           || case when o_orderkey % 4 <> 0 then '&state=' || {encode_sql('o_orderstatus')} else '' end
           as query
    from orders""",
)
def query_get(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    keys = resolve_keys(
        orders,
        {
            "id": "o_orderkey",
            "priority": "o_orderpriority",
            "state": F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderstatus")),
        },
    )
    return orders.select("o_orderkey", get_query(keys, _spec()).query.alias("query"))


@query(
    "query_json",
    """
    select c_custkey, json_object('id', c_custkey, 'name', c_name,
             'segment', case when c_custkey % 3 <> 0 then c_mktsegment end,
             'place', json_object('nation', c_nationkey))::varchar as body
    from customer""",
)
def query_json(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    keys = resolve_keys(
        customers,
        {
            "id": "c_custkey",
            "name": "c_name",
            "segment": F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment")),
            "place": F.struct(F.col("c_nationkey").alias("nation")),
        },
    )
    return customers.select("c_custkey", json_query(keys, _spec(method="POST")).query.alias("body"))


@query(
    "query_jsonurl_get",
    f"""
    select o_orderkey, 'priority=' || {encode_sql('o_orderpriority')}
           || '&state=' || case when o_orderkey % 4 <> 0 then {encode_sql('o_orderstatus')} else 'null' end
           || '&absent=null' || case when o_orderkey % 3 = 0 then '&place=null' else '&place=' end as query
    from orders""",
)
def query_jsonurl_get(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    keys = resolve_keys(
        orders,
        {
            "state": F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderstatus")),
            "priority": "o_orderpriority",
            "place": F.when(F.col("o_orderkey") % 3 != 0, F.struct(F.col("o_custkey").alias("cust"))),
        },
    )
    spec = _spec(query_param_fields=("priority", "state", "absent", "place"))
    return orders.select("o_orderkey", flexible_query(keys, spec).query.alias("query"))


def _flexible_keys(orders):
    return resolve_keys(
        orders,
        {
            "id": "o_orderkey",
            "state": F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderstatus")),
            "priority": "o_orderpriority",
            "cust": "o_custkey",
        },
    )


@query(
    "query_jsonurl_body",
    """
    select o_orderkey, json_object('state', case when o_orderkey % 4 <> 0 then o_orderstatus end,
           'cust', o_custkey)::varchar as body
    from orders""",
)
def query_jsonurl_body(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    spec = _spec(method="PUT", body_fields=("cust", "state", "unknown"))
    return orders.select("o_orderkey", flexible_query(_flexible_keys(orders), spec).query.alias("body"))


@query(
    "query_jsonurl_params",
    f"""
    select o_orderkey, 'cust=' || o_custkey || '&priority=' || {encode_sql('o_orderpriority')}
           || case when o_orderkey % 4 <> 0 then '&state=' || o_orderstatus else '' end as params
    from orders""",
)
def query_jsonurl_params(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    spec = _spec(
        method="POST", query_creator="generic-json-url", query_param_fields=("state", "priority", "cust", "unknown")
    )
    parts = query_parts(_flexible_keys(orders), spec)
    return orders.select("o_orderkey", parts.url_params.alias("params"))


@query(
    "url_path_template",
    """
    select o_orderkey, 'http://orders.example.com/customers/' || o_custkey || '/orders/' || o_orderkey
           || '?echo={order}' as url
    from orders""",
)
def url_path_template(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    keys = _flexible_keys(orders)
    # The second {order} stays: only the first occurrence is replaced.
    base = "http://orders.example.com/customers/{cust}/orders/{order}?echo={order}"
    spec = _spec(url=base, method="POST", url_map={"id": "order", "cust": "cust"})
    url, problem = assemble_url(base, None, flexible_query(keys, spec).path_params)
    assert problem is None
    return orders.select("o_orderkey", url.alias("url"))


@query(
    "query_lucene",
    """
    select o_orderkey, 'q=id:%22' || o_orderkey || '%22%20AND%20priority:%22' || o_orderpriority || '%22'
           || case when o_orderkey % 4 <> 0 then '%20AND%20state:%22' || o_orderstatus || '%22' else '' end
           as query
    from orders""",
)
def query_lucene(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    keys = resolve_keys(
        orders,
        {
            "id": "o_orderkey",
            "priority": "o_orderpriority",
            "state": F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderstatus")),
        },
    )
    return orders.select("o_orderkey", search_query(keys, _spec()).query.alias("query"))


@query(
    "url_assemble",
    """
    select o_orderkey, 'http://a.example.com/x' || case when o_orderkey % 4 <> 0 then '?s=' || o_orderstatus else '' end
             as plain_url,
           'http://a.example.com/x?v=1' || case when o_orderkey % 4 <> 0 then '&s=' || o_orderstatus else '' end
             as extended_url
    from orders""",
)
def url_assemble(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    params = F.when(F.col("o_orderkey") % 4 != 0, F.concat(F.lit("s="), F.col("o_orderstatus"))).otherwise("")
    plain, _ = assemble_url("http://a.example.com/x", params)
    extended, _ = assemble_url("http://a.example.com/x?v=1", params)
    return orders.select("o_orderkey", plain.alias("plain_url"), extended.alias("extended_url"))


@query(
    "request_plan",
    """
    with planned as (
      select l_orderkey, l_linenumber, l_partkey, l_suppkey, 'POST' as method,
             'http://parts.example.com/supply/' || l_suppkey || '?line=' || l_linenumber as url,
             json_object('l_orderkey', l_orderkey, 'l_partkey', l_partkey, 'l_returnflag', l_returnflag)::varchar
               as body
      from lineitem)
    select *, sha256(method || '|' || url || '|' || body) as request_id, null::varchar as error
    from planned""",
)
def request_plan(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    spec = LookupSpec(
        url="http://parts.example.com/supply/{supplier}",
        schema="l_orderkey bigint",
        method="post",
        query_creator="generic-json-url",
        query_param_fields=("line",),
        body_fields=("l_orderkey", "l_partkey", "l_returnflag"),
        url_map={"l_suppkey": "supplier"},
    )
    keys = {
        "l_orderkey": "l_orderkey",
        "l_partkey": "l_partkey",
        "l_returnflag": "l_returnflag",
        "line": "l_linenumber",
        "l_suppkey": "l_suppkey",
    }
    keep = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return plan_requests(lines, spec, keys, keep).select(*keep, "method", "url", "body", "request_id", "error")


@query("form_encode", f"select doc_id, {encode_sql('text')} as encoded from documents")
def form_encode_query(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", form_encode(F.col("text")).alias("encoded"))


@query(
    "query_parse",
    """
    with q as (select page_id, regexp_extract(url, '[?]([^#]*)', 1) as q from pages where url like '%?%'),
    p as (select page_id, pieces, unnest(range(len(pieces))) as i
          from (select page_id, string_split_regex(q, '[&;]') as pieces from q)),
    kv as (select page_id, i, split_part(pieces[i + 1], '=', 1) as name,
                  case when pieces[i + 1] like '%=%'
                       then substr(pieces[i + 1], strpos(pieces[i + 1], '=') + 1) end as value from p)
    select page_id, (row_number() over (partition by page_id order by i) - 1)::int as pos,
           url_decode(replace(name, '+', ' ')) as name, url_decode(replace(value, '+', ' ')) as value
    from kv where name <> ''""",
)
def query_parse(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    params = query_params(url_query(F.col("url")))
    exploded = pages.select("page_id", F.posexplode(params).alias("pos", "p"))
    return exploded.select("page_id", "pos", "p.name", "p.value")


@query(
    "url_add_param",
    f"""
    with u as (select page_id, url, regexp_extract(url, '^([^?#]*)', 1) as base,
                      regexp_extract(url, '[?]([^#]*)', 1) as q, regexp_extract(url, '(#.*)$', 1) as frag
               from pages),
    kv as (select page_id, i, pieces[i + 1] as piece from (
             select page_id, pieces, unnest(range(len(pieces))) as i
             from (select page_id, string_split_regex(q, '[&;]') as pieces from u where q <> ''))),
    enc as (select page_id, string_agg(
              {encode_sql("url_decode(replace(split_part(piece, '=', 1), '+', ' '))")}
              || case when piece like '%=%' then '=' ||
                 {encode_sql("url_decode(replace(substr(piece, strpos(piece, '=') + 1), '+', ' '))")}
                 else '' end, '&' order by i) as q
            from kv where split_part(piece, '=', 1) <> '' group by page_id)
    select page_id, base || '?' || coalesce(enc.q || '&', '') || 'page+id=' || page_id || frag as url
    from u left join enc using (page_id)""",
)
def url_add_param(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    value = F.col("page_id").cast("string")
    return pages.select("page_id", add_parameter(F.col("url"), F.lit("page id"), value).alias("url"))


@query(
    "url_invalid",
    """
    select page_id, page_id % 4 not in (1, 2) as is_valid
    from pages""",
)
def url_invalid(spark, sf_dir):
    # Every second URL is broken: by a blank, or by a brace.
    broken = F.expr(
        "concat(url, case page_id % 4 when 1 then ' x' when 2 then '{id}' when 3 then '%20x' else '' end)"
    )
    return table(spark, sf_dir, "pages").select("page_id", is_valid_url(broken).alias("is_valid"))


@query(
    "request_headers",
    """
    select o_orderkey, 'application/json' as content_type, '*' as origin,
           'Basic ' || base64(encode('svc:secret')) as auth, o_orderstatus as state,
           4 as n_headers
    from orders""",
)
def request_headers(spark, sf_dir):
    spec = LookupSpec.from_options(
        {
            "connector": "rest-lookup",
            "url": ORDER_URL,
            "format": "json",
            "connector.http.source.lookup.header.Content-Type": "application/json",
            "connector.http.source.lookup.header.Origin": "*",
            "connector.http.source.lookup.header.Authorization": "svc:secret",
        },
        "id bigint",
    )
    orders = table(spark, sf_dir, "orders")
    planned = plan_requests(
        orders, spec, {"id": "o_orderkey"}, ["o_orderkey"], {"X-State": F.col("o_orderstatus")}
    )
    return planned.select(
        "o_orderkey",
        F.col("headers")["Content-Type"].alias("content_type"),
        F.col("headers")["Origin"].alias("origin"),
        F.col("headers")["Authorization"].alias("auth"),
        F.col("headers")["X-State"].alias("state"),
        F.size("headers").alias("n_headers"),
    )


@query(
    "auth_basic",
    """
    select c_custkey,
           case when c_custkey % 3 = 0 then 'Basic abc' else 'Basic ' || base64(encode(c_name || ':' || c_mktsegment)) end
             as encoded,
           case when c_custkey % 3 = 0 then 'Basic abc' else c_name || ':' || c_mktsegment end as kept
    from customer""",
)
def auth_basic(spark, sf_dir):
    login = F.when(F.col("c_custkey") % 3 == 0, "Basic abc").otherwise(F.concat_ws(":", "c_name", "c_mktsegment"))
    return table(spark, sf_dir, "customer").select(
        "c_custkey", basic_auth(login).alias("encoded"), basic_auth(login, raw=True).alias("kept")
    )


@query(
    "auth_bearer_asof",
    """
    with tokens as (
      select user_id % 8 as client, 'tok-' || event_id as token, ts as issued,
             ts + to_seconds((case when life > 1 then life - 1 else life end)::bigint) as expires
      from (select *, case when event_id % 50 = 0 then 1 else 3600 + event_id % 600 end as life
            from events where event_type = 'signup'))
    select e.event_id, case when e.ts <= t.expires then 'Bearer ' || t.token end as bearer
    from (select event_id, ts, user_id % 8 as client from events) e
    asof left join tokens t on e.client = t.client and e.ts >= t.issued""",
)
def auth_bearer_asof(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("client", F.col("user_id") % 8)
    tokens = events.where("event_type = 'signup'").selectExpr(
        "client",
        "concat('tok-', event_id) as token",
        "ts as issued",
        "case when event_id % 50 = 0 then 1 else 3600 + event_id % 600 end as expires_in",
    )
    asked = events.select("event_id", "ts", "client")
    bearer = assign_tokens(asked, tokens, "ts", ["client"], order=["event_id"])
    return bearer.select("event_id", F.concat(F.lit("Bearer "), F.col("token")).alias("bearer"))


@query(
    "query_custom",
    """
    select o_orderkey, 'http://orders.example.com/v1/order?filter=' || upper(o_orderstatus) || '.' || o_custkey as url
    from orders""",
)
def query_custom(spark, sf_dir):
    def dotted(keys, spec):
        return RequestParts(F.concat(F.lit("filter="), F.concat_ws(".", *[F.upper(c.cast("string")) for _, c, _ in keys])))

    register_query_creator("dotted-filter", dotted)
    orders = table(spark, sf_dir, "orders")
    planned = plan_requests(
        orders, _spec(query_creator="dotted-filter"), {"state": "o_orderstatus", "cust": "o_custkey"}, ["o_orderkey"]
    )
    return planned.select("o_orderkey", "url")


@query(
    "format_custom",
    """
    select o_orderkey, o_orderkey || ';' || o_orderstatus || ';' || o_custkey as csv_body,
           '<' || o_orderkey || '|' || o_orderstatus || '|' || o_custkey || '>' as own_body
    from orders""",
)
def format_custom(spark, sf_dir):
    def angle(fields, options):
        mark = options.get("separator", ",")
        return F.concat(F.lit("<"), F.concat_ws(mark, *[c.cast("string") for _, c, _ in fields]), F.lit(">"))

    register_format("angle", encoder=angle)
    orders = table(spark, sf_dir, "orders")
    keys = resolve_keys(orders, {"id": "o_orderkey", "state": "o_orderstatus", "cust": "o_custkey"})
    own = _spec(
        method="POST", request_format="angle", options={"lookup-request.format.angle.separator": "|"}
    )
    return orders.select(
        "o_orderkey",
        encode_csv(keys, {"sep": ";"}).alias("csv_body"),
        query_parts(keys, own).query.alias("own_body"),
    )

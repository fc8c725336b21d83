"""Queries over the lookup cache."""

from __future__ import annotations

from pyspark.sql import functions as F

from restframe.operators.cache import access_ttl, calls_made, is_storable, lru, split_by_store, write_ttl
from restframe.operators.lookup import call_counter
from restframe.operators.request import distinct_requests, plan_requests
from restframe.operators.response import process_responses
from restframe.plans.base import ROW_GROUP, query, table
from restframe.plans.joins import CUSTOMER, _customer_endpoint
from restframe.session import new_dir
from restframe.spec import LookupSpec
from restframe.streaming.cache_state import CachedStream

SIX_HOURS_MS = 6 * 3600 * 1000


def _order_requests(spark, sf_dir):
    requests, _ = distinct_requests(table(spark, sf_dir, "orders"), CUSTOMER, {"c_custkey": "o_custkey"})
    return requests


@query(
    "cache_distinct",
    """
    select o_custkey, count(*) as n_rows, 1 as calls, count(*) - 1 as calls_saved
    from orders group by o_custkey""",
)
def cache_distinct(spark, sf_dir):
    requests = _order_requests(spark, sf_dir)
    key = F.regexp_extract("url", r"=(\d+)$", 1).cast("bigint")
    return requests.select(
        key.alias("o_custkey"), "n_rows", F.lit(1).alias("calls"), (F.col("n_rows") - 1).alias("calls_saved")
    )


@query(
    "lookup_calls",
    """
    select count(*) as probe_rows, count(distinct o_custkey) as calls,
           count(*) - count(distinct o_custkey) as calls_saved
    from orders""",
)
def lookup_calls(spark, sf_dir):
    return call_counter(_order_requests(spark, sf_dir))


@query(
    "cache_access_ttl",
    """
    select event_id, user_id,
           coalesce(ts - lag(ts) over (partition by user_id order by ts, event_id) <= interval 6 hours, false) as hit
    from events""",
)
def cache_access_ttl(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "ts", "event_id")
    hits = access_ttl(events, "user_id", "ts", ["event_id"], F.expr("interval '6' hour"))
    return hits.select("event_id", "user_id", "hit")


_WRITE_TTL = """
    with recursive a as (
      select user_id, event_id, ts, row_number() over (partition by user_id order by ts, event_id) as rn from events),
    walk as (
      select user_id, event_id, ts, rn, ts as loaded, false as hit from a where rn = 1
      union all
      select a.user_id, a.event_id, a.ts, a.rn,
             case when a.ts - w.loaded <= interval 6 hours then w.loaded else a.ts end,
             a.ts - w.loaded <= interval 6 hours
      from walk w join a on a.user_id = w.user_id and a.rn = w.rn + 1)
    select event_id, user_id, hit from walk"""


@query("cache_write_ttl", _WRITE_TTL)
def cache_write_ttl(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "ts", "event_id")
    hits = write_ttl(events, "user_id", "ts", ["event_id"], SIX_HOURS_MS)
    return hits.select("event_id", "user_id", "hit")


@query("cache_stream", _WRITE_TTL)
def cache_stream_query(spark, sf_dir):
    """The table as files in the order of time, but up to three hours out of it, one micro-batch each."""
    path, state, checkpoint, parts = (new_dir(spark, label) for label in ("cache", "cache-state", "cache-log", "cache-parts"))
    events = table(spark, sf_dir, "events").select("user_id", "event_id", F.col("ts").cast("timestamp"))
    seen = F.unix_seconds("ts") + F.pmod(F.xxhash64("event_id"), F.lit(3 * 3600))
    low, high = events.agg(F.min(seen), F.max(seen)).first()
    for i in range(4):
        part = events.where(F.floor((seen - low) * 4 / (high - low + 1)) == i)
        part.repartition(1).write.mode("append").option("parquet.block.size", ROW_GROUP).parquet(parts)
    source = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(parts)
    cache = CachedStream("user_id", "ts", "event_id", SIX_HOURS_MS, "3 hours", path, state)
    cache.start(source, checkpoint).trigger(availableNow=True).start().awaitTermination()
    cache.finish(spark)
    return cache.answers(spark, "key long, ident long").select("event_id", "user_id", "hit")


@query(
    "cache_max_rows",
    """
    with a as (
      select event_id, user_id, user_id % 4 as lane,
             row_number() over (partition by user_id % 4 order by ts, event_id) as rn from events),
    b as (select *, lag(rn) over (partition by lane, user_id order by rn) as prev from a)
    select b.event_id, b.user_id,
           b.prev is not null and
           (select count(distinct c.user_id) from a c where c.lane = b.lane and c.rn > b.prev and c.rn < b.rn) < 3 as hit
    from b""",
)
def cache_max_rows(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("lane", F.col("user_id") % 4)
    hits = lru(events, "lane", "user_id", "ts", ["event_id"], max_rows=3)
    return hits.select("event_id", "user_id", "hit")


@query(
    "cache_missing_key",
    """
    select (o_custkey % 3 = 0) as is_empty, count(distinct o_custkey) as calls_cached,
           (case when o_custkey % 3 = 0 then count(*) else count(distinct o_custkey) end)::bigint as calls_uncached,
           (case when o_custkey % 3 = 0 then 0 else count(distinct o_custkey) end)::bigint as stored
    from orders group by o_custkey % 3 = 0""",
)
def cache_missing_key(spark, sf_dir):
    requests = _order_requests(spark, sf_dir)
    endpoint = _customer_endpoint(spark, sf_dir, "c_custkey % 3 <> 0")
    answers = process_responses(endpoint.fetch(requests, CUSTOMER, ["n_rows"]), CUSTOMER)
    empty = F.size("rows") == 0
    answers = answers.withColumn("is_empty", empty)
    # The option as a table definition gives it.
    off = LookupSpec.from_options(
        {"url": "http://c", "format": "json", "lookup.partial-cache.cache-missing-key": "false"}, "c_custkey bigint"
    ).cache_missing_key
    is_empty = F.col("is_empty")
    return answers.groupBy("is_empty").agg(
        F.sum(calls_made(answers, is_empty, cache_missing_key=True)).alias("calls_cached"),
        F.sum(calls_made(answers, is_empty, cache_missing_key=off)).cast("bigint").alias("calls_uncached"),
        F.count_if(is_storable(is_empty, cache_missing_key=off)).alias("stored"),
    )


@query(
    "cache_store",
    """
    select o_custkey, case when o_custkey % 2 = 0 then 'store' else 'call' end as source, c_name
    from (select distinct o_custkey from orders) join customer on c_custkey = o_custkey""",
)
def cache_store(spark, sf_dir):
    # An earlier run answered the requests of the even customers.
    customers = table(spark, sf_dir, "customer")
    earlier = plan_requests(customers.where("c_custkey % 2 = 0"), CUSTOMER, {"c_custkey": "c_custkey"})
    endpoint = _customer_endpoint(spark, sf_dir)
    known, missing = split_by_store(_order_requests(spark, sf_dir), endpoint.fetch(earlier, CUSTOMER))
    fetched = endpoint.fetch(missing, CUSTOMER)
    both = known.withColumn("source", F.lit("store")).unionByName(fetched.withColumn("source", F.lit("call")))
    outcome = process_responses(both, CUSTOMER).where(F.size("rows") > 0)
    row = F.get("rows", F.lit(0))
    return outcome.select(row["c_custkey"].alias("o_custkey"), "source", row["c_name"].alias("c_name"))

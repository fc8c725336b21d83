"""Queries over sink elements, batch plans and delivery."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from restframe.operators.batches import (
    element_bytes,
    make_requests,
    method_error,
    plan_batches,
    plan_byte_flushes,
    plan_then_elements,
    split_elements,
    with_elements,
)
from restframe.plans.base import LINE_METHOD, ROW_GROUP, query, stream, table
from restframe.session import new_dir
from restframe.sources.delivery import deliver, sink_metrics
from restframe.sources.http_sink import register_sink
from restframe.sources.transport import CallableTransport
from restframe.spec import SinkSpec
from restframe.streaming.enrich import deliver_stream

URL = "http://sink.example.com/rows"
SPEC = SinkSpec(url=URL)

LINE_COLUMNS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus"]
# A lane per supplier group, sliced by order range and part, so that neither a hot supplier
# nor a hot order is one task.
LANE, SLICES = ["lane"], ["order_range", "part_group"]
ORDER = [*LINE_COLUMNS, "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate"]


def _lines(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").selectExpr(
        "*",
        "l_suppkey % 4 as lane",
        "l_orderkey div 100000 as order_range",
        "l_partkey % 8 as part_group",
        f"{LINE_METHOD} as verb",
    )


def _line_elements(spark, sf_dir, spec=SPEC, methods=False):
    verb = F.col("verb") if methods else None
    return with_elements(_lines(spark, sf_dir), spec, LINE_COLUMNS, verb)


_ELEMENT = "json_object(" + ", ".join(f"'{c}', {c}" for c in LINE_COLUMNS) + ")::varchar"
# Rows in lane order.
_NUMBERED = f"""
    select *, l_suppkey % 4 as lane, {_ELEMENT} as element, {LINE_METHOD} as method,
           row_number() over (partition by l_suppkey % 4
                              order by l_orderkey // 100000, l_partkey % 8, {', '.join(ORDER)}) - 1 as seq
    from lineitem"""


def _batches_sql(batch_start: str, source: str) -> str:
    return f"""
    select lane, batch_seq, min_by(method, seq) as method, count(*) as n_records,
           sum(strlen(element))::bigint as n_bytes,
           md5('[' || string_agg(element, ',' order by seq) || ']') as body_md5
    from (select *, {batch_start} as batch_seq from ({source})) group by lane, batch_seq"""


def _summary(requests):
    return requests.select("lane", "batch_seq", "method", "n_records", "n_bytes", F.md5("body").alias("body_md5"))


@query("sink_batch_count", _batches_sql("seq - seq % 500", _NUMBERED.replace(LINE_METHOD, "'POST'")))
def sink_batch_count(spark, sf_dir):
    planned = plan_then_elements(_lines(spark, sf_dir), SPEC, LANE, SLICES, ORDER, LINE_COLUMNS, by_method=False)
    return _summary(make_requests(planned, SPEC, LANE))


_RUNS = f"""
    select *, max(case when starts then seq end) over (partition by lane order by seq) as run_seq
    from (select *, lag(method) over (partition by lane order by seq) is distinct from method as starts
          from ({_NUMBERED}))"""


@query(
    "sink_batch_method_runs",
    _batches_sql("seq - (seq - greatest(run_seq, seq - seq % 500)) % 50", _RUNS),
)
def sink_batch_method_runs(spark, sf_dir):
    spec = SPEC.replace(request_batch_size=50)
    planned = plan_then_elements(_lines(spark, sf_dir), spec, LANE, SLICES, ORDER, LINE_COLUMNS, F.col("verb"))
    return _summary(make_requests(planned, spec, LANE))


@query(
    "sink_batch_two_level",
    f"""
    select lane, flush_seq, count(distinct batch_seq) as n_requests, count(*) as n_records
    from (select *, seq - seq % 200 as flush_seq, seq - (seq % 200) % 75 as batch_seq from ({_NUMBERED}))
    group by lane, flush_seq""",
)
def sink_batch_two_level(spark, sf_dir):
    spec = SPEC.replace(max_batch_size=200, request_batch_size=75)
    planned = plan_batches(_line_elements(spark, sf_dir, spec), spec, LANE, SLICES, ORDER)
    requests = planned.groupBy("lane", "flush_seq", "batch_seq").agg(F.count(F.lit(1)).alias("n"))
    return requests.groupBy("lane", "flush_seq").agg(
        F.count(F.lit(1)).alias("n_requests"), F.sum("n").alias("n_records")
    )


@query(
    "sink_batch_bytes",
    """
    with recursive d as (
      select doc_id, doc_id % 4 as lane, strlen(text) as n_bytes,
             row_number() over (partition by doc_id % 4 order by doc_id) - 1 as seq from documents),
    walk as (
      select doc_id, lane, n_bytes, seq, seq as flush_seq, n_bytes as held, 1 as rows from d where seq = 0
      union all
      select d.doc_id, d.lane, d.n_bytes, d.seq,
             case when w.held + d.n_bytes > 20000 or w.rows = 25 then d.seq else w.flush_seq end,
             case when w.held + d.n_bytes > 20000 or w.rows = 25 then d.n_bytes else w.held + d.n_bytes end,
             case when w.held + d.n_bytes > 20000 or w.rows = 25 then 1 else w.rows + 1 end
      from walk w join d on d.lane = w.lane and d.seq = w.seq + 1)
    select doc_id, lane, n_bytes::bigint as n_bytes, seq, flush_seq from walk""",
)
def sink_batch_bytes(spark, sf_dir):
    spec = SPEC.replace(format="raw", max_batch_bytes=20_000, max_batch_size=25)
    documents = table(spark, sf_dir, "documents").selectExpr(
        "doc_id", "text", "doc_id % 4 as lane", "doc_id div 1000 as id_range"
    )
    elements = with_elements(documents, spec, ["text"])
    flushes = plan_byte_flushes(elements, spec, LANE, "id_range", ["doc_id"])
    return flushes.select("doc_id", "lane", "n_bytes", "seq", "flush_seq")


@query(
    "sink_element_json",
    """
    select o_orderkey, json_object('o_orderkey', o_orderkey, 'o_custkey', o_custkey,
             'o_orderstatus', case when o_orderkey % 5 <> 0 then o_orderstatus end,
             'o_orderdate', strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'),
             'detail', json_object('placed', strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'),
                                   'priority', o_orderpriority))::varchar as element
    from orders""",
)
def sink_element_json(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "o_custkey",
        "case when o_orderkey % 5 <> 0 then o_orderstatus end as o_orderstatus",
        "o_orderdate",
        "named_struct('placed', o_orderdate, 'priority', o_orderpriority) as detail",
    )
    return with_elements(orders, SPEC).select("o_orderkey", "element")


@query("sink_element_raw", "select doc_id, 'POST' as method, text as element from documents")
def sink_element_raw(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return with_elements(documents, SPEC.replace(format="raw"), ["text"]).select("doc_id", "method", "element")


@query(
    "sink_element_custom",
    """
    select conv_id, turn, case when role = 'user' then 'PUT' else 'POST' end as method,
           upper(role) || ':' || length(text) as element
    from conversations""",
)
def sink_element_custom(spark, sf_dir):
    def converter(df):
        method = F.when(F.col("role") == "user", "PUT").otherwise("POST")
        return method, F.concat(F.upper("role"), F.lit(":"), F.length("text").cast("string"))

    talks = table(spark, sf_dir, "conversations")
    return with_elements(talks, SPEC, converter=converter).select("conv_id", "turn", "method", "element")


@query(
    "sink_single",
    f"""
    select o_orderkey, '{URL}' as url, 'PUT' as method, 1::bigint as n_records,
           json_object('o_orderkey', o_orderkey, 'o_custkey', o_custkey)::varchar as body
    from orders""",
)
def sink_single(spark, sf_dir):
    spec = SinkSpec(url=URL, mode="single", method="PUT")
    elements = with_elements(table(spark, sf_dir, "orders"), spec, ["o_orderkey", "o_custkey"])
    requests = make_requests(elements.withColumn("batch_seq", F.col("o_orderkey")), spec, ["o_orderkey"])
    return requests.select("o_orderkey", "url", "method", "n_records", "body")


@query(
    "sink_oversize",
    """
    select doc_id, strlen(text)::bigint as n_bytes, strlen(text) > 5000 as rejected from documents""",
)
def sink_oversize(spark, sf_dir):
    spec = SPEC.replace(format="raw", max_record_bytes=5000)
    good, bad = split_elements(with_elements(table(spark, sf_dir, "documents"), spec, ["text"]), spec)
    columns = ["doc_id", element_bytes().alias("n_bytes")]
    return good.select(*columns, F.lit(False).alias("rejected")).unionByName(
        bad.select(*columns, F.lit(True).alias("rejected"))
    )


@query(
    "sink_method",
    """
    select conv_id, turn, case turn % 4 when 0 then 'POST' when 1 then 'PUT' when 2 then 'put' end as method,
           case turn % 4 when 2 then 'method not allowed: put' when 3 then 'method not allowed: null' end as problem
    from conversations""",
)
def sink_method(spark, sf_dir):
    verb = F.expr("case turn % 4 when 0 then 'POST' when 1 then 'PUT' when 2 then 'put' end")
    elements = with_elements(table(spark, sf_dir, "conversations"), SPEC, ["text"], verb)
    return elements.select("conv_id", "turn", "method", method_error().alias("problem"))


def _part(index: int):
    """A part of the name of a request: its lane's columns, then its place in the lane."""
    return F.get(F.from_json("batch_id", "array<string>"), F.lit(index))


def answer_by_size(request):
    """An endpoint that answers from the request alone: by the length of its body."""
    size = len(request["body"].encode())
    if size % 7 == 0:
        raise ConnectionResetError("connection reset")
    if size % 3 == 0:
        return {"status": 500 if size % 2 == 0 else 404, "body": "refused"}
    return {"status": 201, "body": ""}


# What that endpoint does to a request whose body has s bytes.
_ANSWERED = """case when s % 7 = 0 then null when s % 3 = 0 then case when s % 2 = 0 then 500 else 404 end
               else 201 end::int as status, case when s % 7 = 0 then 'connection reset' end as io_error"""

_SENT = f"""
    select lane, '["' || lane || '","' || batch_seq || '"]' as batch_id, method, n_records, n_bytes, flush_seq, {_ANSWERED}
    from (select lane, batch_seq, min_by(method, seq) as method, count(*) as n_records,
                 sum(strlen(element))::bigint as n_bytes, max(seq - seq % 500) as flush_seq,
                 (sum(strlen(element)) + count(*) + 1)::bigint as s
          from (select *, seq - (seq - greatest(run_seq, seq - seq % 500)) % 50 as batch_seq from ({_RUNS}))
          group by lane, batch_seq)"""

_DELIVERY = SinkSpec(url=URL, request_batch_size=50, error_exclude="404")


def _delivery_log(spark, sf_dir, **options):
    return deliver(
        _lines(spark, sf_dir),
        _DELIVERY,
        CallableTransport(answer_by_size),
        LANE,
        SLICES,
        ORDER,
        columns=LINE_COLUMNS,
        method=F.col("verb"),
        **options,
    )


@query(
    "sink_deliver",
    f"""
    select batch_id, method, n_records, n_bytes, status, io_error, coalesce(status = 500, true) as is_error
    from ({_SENT})""",
)
def sink_deliver(spark, sf_dir):
    log = _delivery_log(spark, sf_dir, log_path=new_dir(spark, "delivery"))
    return log.select("batch_id", "method", "n_records", "n_bytes", "status", "io_error", "is_error")


@query(
    "sink_outcome",
    f"""
    select coalesce(status::varchar, io_error) as answer, coalesce(status = 500, true) as is_error,
           count(*) as requests, sum(n_records)::bigint as records
    from ({_SENT}) group by all""",
)
def sink_outcome(spark, sf_dir):
    log = _delivery_log(spark, sf_dir)
    answer = F.coalesce(F.col("status").cast("string"), F.col("io_error"))
    return log.groupBy(answer.alias("answer"), "is_error").agg(
        F.count(F.lit(1)).alias("requests"), F.sum("n_records").alias("records")
    )


@query(
    "sink_metrics",
    f"""
    with s as (select * replace (lane::varchar as lane) from ({_SENT})),
    f as (select lane, flush_seq, count(*) as requests, sum(n_records) as records,
                 count(*) filter (where status is null or status = 500) as requests_failed,
                 sum(case when status is null or status = 500 then n_records else 0 end) as records_failed,
                 count(*) filter (where status = 500) as refused, max(status is null) as lost
          from s group by all)
    select lane, sum(requests)::bigint as requests, sum(records)::bigint as records,
           sum(requests_failed)::bigint as requests_failed, sum(records_failed)::bigint as records_failed,
           sum(case when lost then records else refused end)::bigint as num_records_send_errors
    from f group by lane""",
)
def sink_metrics_query(spark, sf_dir):
    log = _delivery_log(spark, sf_dir)
    placed = log.withColumn("lane", _part(0)).withColumn("flush_seq", _part(1).cast("bigint"))
    placed = placed.withColumn("flush_seq", F.col("flush_seq") - F.col("flush_seq") % _DELIVERY.max_batch_size)
    return sink_metrics(placed, ["lane"], "flush_seq")


def in_order(request):
    """An endpoint that reports when it was called, on the clock of its machine."""
    return {"status": 200, "body": str(time.monotonic_ns())}


@query(
    "sink_order",
    f"""
    select lane, batch_seq, lag(batch_seq) over (partition by lane order by batch_seq) as sent_before
    from (select distinct lane, seq - seq % 500 as batch_seq from ({_NUMBERED}))""",
)
def sink_order(spark, sf_dir):
    from pyspark.sql import Window

    log = deliver(
        _lines(spark, sf_dir),
        SPEC,
        CallableTransport(in_order),
        LANE,
        SLICES,
        ORDER,
        columns=LINE_COLUMNS,
        ordered=True,
        log_path=new_dir(spark, "ordered"),
    )
    lane, batch_seq = _part(0).cast("bigint"), _part(1).cast("bigint")
    calls = log.select(lane.alias("lane"), batch_seq.alias("batch_seq"), F.col("response").cast("bigint").alias("call"))
    before = F.lag("batch_seq").over(Window.partitionBy("lane").orderBy("call"))
    return calls.select("lane", "batch_seq", before.alias("sent_before"))


@query(
    "sink_stream",
    """
    select event_id % 4 as lane, sum(1)::bigint as n_records, count(distinct event_id)::bigint as n_requests
    from events group by event_id % 4""",
)
def sink_stream(spark, sf_dir):
    path, checkpoint = new_dir(spark, "stream-log"), new_dir(spark, "stream-state")
    events = stream(spark, sf_dir, "events").selectExpr(
        "event_id", "event_type", "event_id % 4 as lane", "event_id div 1000 as id_range"
    )
    spec = SinkSpec(url=URL, mode="single")
    writer = deliver_stream(
        events,
        spec,
        CallableTransport(answer_by_size),
        path,
        checkpoint,
        ["lane"],
        ["id_range"],
        ["event_id"],
        columns=["event_id", "event_type"],
    )
    writer.trigger(availableNow=True).start().awaitTermination()
    log = spark.read.parquet(path)
    return log.groupBy(_part(0).cast("bigint").alias("lane")).agg(
        F.sum("n_records").alias("n_records"), F.count(F.lit(1)).alias("n_requests")
    )


@query(
    "sink_stream_batch",
    """
    select event_id % 4 as lane, count(*)::bigint as n_records, true as keys_differ, true as in_epochs from events
    group by event_id % 4""",
)
def sink_stream_batch(spark, sf_dir):
    """Batch mode over several micro-batches: no two requests under one key."""
    path, checkpoint = new_dir(spark, "stream-log"), new_dir(spark, "stream-state")
    parts = new_dir(spark, "stream-parts")
    # The table as files of their own, one micro-batch each.
    files = table(spark, sf_dir, "events").select("event_id", "event_type").repartitionByRange(4, "event_id")
    files.write.option("parquet.block.size", ROW_GROUP).parquet(parts)
    events = (
        spark.readStream.schema("event_id long, event_type string")
        .option("maxFilesPerTrigger", 1)
        .parquet(parts)
        .selectExpr("*", "event_id % 4 as lane", "event_id div 1000 as id_range")
    )
    spec = SinkSpec(url=URL, request_batch_size=50)
    writer = deliver_stream(
        events, spec, CallableTransport(answer_by_size), path, checkpoint, ["lane"], ["id_range"], ["event_id"],
        columns=["event_id", "event_type"],
    )
    writer.trigger(availableNow=True).start().awaitTermination()
    log = spark.read.parquet(path)
    keys = log.agg(
        (F.count_distinct("idempotency_key") == F.count("*")).alias("keys_differ"),
        (F.count_distinct("epoch") >= 3).alias("in_epochs"),
    )
    lanes = log.groupBy(_part(0).cast("bigint").alias("lane")).agg(F.sum("n_records").alias("n_records"))
    return lanes.crossJoin(F.broadcast(keys))


# What the table form delivers of the events, one request for each; its methods are POST and PUT, others are refused.
_TABLE_WRITE = """
    with e as (select event_id, case when event_id % 97 = 0 then 'DELETE' when event_id % 2 = 0 then 'PUT' else 'POST' end as verb,
                      strlen('{"event_id":' || event_id || ',"event_type":"' || event_type || '"}') as s from events),
    sent as (select * from e where verb <> 'DELETE')
    select count(*)::bigint as records, count(*)::bigint as requests,
           count(*) filter (s % 7 = 0 or s % 3 = 0)::bigint as requests_failed,
           (select count(*) from e where verb = 'DELETE')::bigint as rejected"""
_WRITE_COUNTS = ["records", "requests", "requests_failed", "rejected"]
_SENDER = {"url": URL, "format": "json", "sink.writer.request.mode": "single", "sender": "restframe.plans.sinks:answer_by_size"}


def _table_elements(events, spec):
    verb = F.when(F.col("event_id") % 97 == 0, "DELETE").when(F.col("event_id") % 2 == 0, "PUT").otherwise("POST")
    return with_elements(events, spec, ["event_id", "event_type"], verb).select("method", "element")


def _write_log(spark, path):
    log = spark.read.schema("records long, requests long, requests_failed long, rejected long").json(path)
    return log.agg(*[F.sum(c).alias(c) for c in _WRITE_COUNTS])


@query("sink_table", _TABLE_WRITE + " from sent")
def sink_table(spark, sf_dir):
    """``df.write.format("http-sink")``, one record a request, and its log."""
    register_sink(spark)
    path = new_dir(spark, "table-log")
    rows = _table_elements(table(spark, sf_dir, "events"), SinkSpec(url=URL))
    rows.write.format("http-sink").mode("append").options(**_SENDER, **{"log-path": path}).save()
    return _write_log(spark, path)


@query(
    "sink_table_stream",
    _TABLE_WRITE + ", 3::bigint as epochs from sent",
)
def sink_table_stream(spark, sf_dir):
    """``writeStream.format("http-sink")`` over three micro-batches, and the log of their epochs."""
    register_sink(spark)
    path, checkpoint, parts = (new_dir(spark, label) for label in ("table-log", "stream-state", "stream-parts"))
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    files = events.repartition(3, "event_id")
    files.write.option("parquet.block.size", ROW_GROUP).parquet(parts)
    source = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(parts)
    writer = _table_elements(source, SinkSpec(url=URL)).writeStream.format("http-sink")
    writer = writer.options(**_SENDER, **{"log-path": path}).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()
    epochs = spark.read.schema("write string").json(path).agg(F.count_distinct("write").alias("epochs"))
    return _write_log(spark, path).crossJoin(F.broadcast(epochs))


_ODD_LANES = [
    "case event_id % 4 when 0 then 'a-b' when 1 then 'a' when 2 then 'null' end as one",
    "case event_id % 4 when 0 then 'c' when 1 then 'b-c' when 2 then 'z' when 3 then 'z' end as two",
]


@query(
    "sink_lane_keys",
    f"""
    select one, two, count(*)::bigint as n_records, ((count(*) + 499) // 500)::bigint as keys
    from (select {", ".join(_ODD_LANES)} from events) group by all""",
)
def sink_lane_keys(spark, sf_dir):
    """Lanes with dashes, nulls and the text null: keys of their own for each."""
    events = table(spark, sf_dir, "events").selectExpr("event_id", "event_id div 1000 as id_range", *_ODD_LANES)
    log = deliver(
        events, SPEC, CallableTransport(answer_by_size), ["one", "two"], ["id_range"], ["event_id"], columns=["event_id"]
    )
    return log.groupBy(_part(0).alias("one"), _part(1).alias("two")).agg(
        F.sum("n_records").alias("n_records"), F.count_distinct("idempotency_key").alias("keys")
    )


@query(
    "sink_reject",
    """
    select io_error, count(*)::bigint as n_records from (
      select case when event_id % 7 = 0 then 'no element' when event_id % 5 = 0 then 'method not allowed: DELETE'
                  when event_id % 3 = 0 then 'method not allowed: null'
                  when strlen(props) > 12 then 'record too large' end as io_error
      from events) where io_error is not null group by io_error""",
)
def sink_reject(spark, sf_dir):
    """Null elements, methods outside the table form and large records are logged, not sent and not lost."""
    events = table(spark, sf_dir, "events").selectExpr(
        "event_id", "event_id % 4 as lane", "event_id div 1000 as id_range",
        "case when event_id % 7 <> 0 then props end as text",
        "case when event_id % 5 = 0 then 'DELETE' when event_id % 3 <> 0 then 'PUT' end as verb",
    )
    spec = SinkSpec(url=URL, format="raw", max_record_bytes=12)
    log = deliver(
        events, spec, CallableTransport(answer_by_size), ["lane"], ["id_range"], ["event_id"], ["text"], F.col("verb")
    )
    rejected = log.where(F.get_json_object("batch_id", "$[0]") == "rejected")
    return rejected.groupBy("io_error").agg(F.sum("n_records").alias("n_records"))


@query(
    "sink_deliver_bytes",
    "select count(*)::bigint as n_records, sum(strlen(text))::bigint as n_bytes, true as within from documents",
)
def sink_deliver_bytes(spark, sf_dir):
    """The byte limit holds without being asked for."""
    documents = table(spark, sf_dir, "documents").selectExpr(
        "doc_id", "text", "doc_id % 4 as lane", "doc_id div 1000 as id_range"
    )
    spec = SinkSpec(url=URL, format="raw", max_batch_bytes=200_000)
    log = deliver(documents, spec, CallableTransport(answer_by_size), ["lane"], ["id_range"], ["doc_id"], ["text"])
    return log.agg(
        F.sum("n_records").alias("n_records"),
        F.sum("n_bytes").alias("n_bytes"),
        F.min((F.col("n_records") == 1) | (F.col("n_bytes") <= 200_000)).alias("within"),
    )

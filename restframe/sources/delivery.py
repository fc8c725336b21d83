"""Deliver rows to an HTTP endpoint and account for every request."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from restframe.functions.codes import is_sink_error
from restframe.functions.headers import header_column
from restframe.operators.batches import (
    Converter,
    element_bytes,
    make_requests,
    name_of,
    plan_batches,
    plan_then_elements,
    reject_reason,
    split_elements,
    with_elements,
)
from restframe.sources.transport import Transport
from restframe.spec import INSERT_METHODS, SinkSpec

LOG_COLUMNS = [
    "batch_id", "idempotency_key", "method", "url", "n_records", "n_bytes", "status", "headers", "response",
    "io_error", "is_error",
]


def delivery_outcome(sent: DataFrame, spec: SinkSpec) -> DataFrame:
    """Add ``is_error``: no response, or a status the sink's rules count as failed."""
    answered = F.col("io_error").isNull() & F.col("status").isNotNull()
    failed = is_sink_error(F.col("status"), spec.error_codes, spec.error_exclude)
    return sent.withColumn("is_error", F.when(answered, failed).otherwise(True))


def deliver(
    df: DataFrame,
    spec: SinkSpec,
    transport: Transport,
    lane: Sequence[str],
    slices: Sequence[str],
    order: Sequence[str],
    columns: Sequence[str] | None = None,
    method: Column | None = None,
    converter: Converter | None = None,
    ordered: bool = False,
    by_bytes: bool | None = None,
    keep_body: bool = False,
    log_path: str | None = None,
    delivery_id: str | None = None,
) -> DataFrame:
    """Serialize, batch and send ``df``; gives the delivery log, one row per request.

    The log is lazy and every action on it sends again, so give ``log_path``, a new folder, to send
    once and read the written log back. Failed requests are logged, not retried, and do not fail the
    job. Rows without an element or an allowed method, and records that are too large, are logged as
    rejected. A flush holds at most ``max_batch_bytes``; ``by_bytes`` says whether that needs a plan
    of its own, by default the largest element tells (one pass over the rows).

    Delivery is at least once. The ``Idempotency-Key`` header names the delivery, the lane and the
    request in it: it repeats when a task or an action is repeated, and with the same
    ``delivery_id`` given again; by default every call of this function is another delivery.
    ``ordered`` keeps the order of a lane with one sender per lane.
    """
    delivery = delivery_id or uuid.uuid4().hex
    elements = with_elements(df, spec, columns, method, converter)
    # A converter may use any method; the table form has the two.
    allowed = INSERT_METHODS if converter is None else None
    good, rejected = split_elements(elements, spec, allowed)
    any_rejected = True
    if spec.mode == "single" and not ordered:
        # One record, one request: nothing to number, so nothing to shuffle.
        planned = good.withColumn("batch_seq", name_of(*map(F.col, order)))
    else:
        if by_bytes is None:
            reason = reject_reason(spec, allowed)
            seen = elements.agg(
                F.max(F.when(reason.isNull(), element_bytes())).alias("largest"), F.count_if(reason.isNotNull()).alias("bad")
            ).first()
            by_bytes = (seen.largest or 0) * spec.max_batch_size > spec.max_batch_bytes
            any_rejected = seen.bad > 0
        if any_rejected or by_bytes or converter is not None:
            planned = plan_batches(good, spec, lane, slices, order, by_bytes=by_bytes)
        else:
            planned = plan_then_elements(df, spec, lane, slices, order, columns, method)
    requests = make_requests(planned, spec, lane).withColumn("request_id", F.col("batch_id"))
    requests = requests.withColumn("idempotency_key", F.sha2(name_of(F.lit(delivery), F.col("batch_id")), 256))
    requests = requests.withColumn(
        "headers", header_column(spec.headers, {"Idempotency-Key": F.col("idempotency_key")})
    )
    if ordered:
        requests = requests.repartition(*lane).sortWithinPartitions(*lane, "batch_seq")
        spec = spec.replace(writer_threads=1)
    carry = ["batch_id", "idempotency_key", "method", "url", "n_records", "n_bytes"]
    if keep_body:
        requests = requests.withColumn("request_body", F.col("body"))
        carry.append("request_body")
    sent = transport.fetch(requests, spec, carry)
    log = delivery_outcome(sent.withColumnRenamed("body", "response"), spec)
    log = log.select(*LOG_COLUMNS, *(["request_body"] if keep_body else []))
    refused = rejected.select(
        name_of(F.lit("rejected"), *map(F.col, [*lane, *order])).alias("batch_id"),
        "method",
        F.lit(spec.url).alias("url"),
        F.lit(1).cast("bigint").alias("n_records"),
        F.octet_length("element").cast("bigint").alias("n_bytes"),
        F.col("reject_reason").alias("io_error"),
        F.lit(True).alias("is_error"),
    )
    log = log.unionByName(refused.where(F.lit(any_rejected)), allowMissingColumns=True)
    if log_path is None:
        return log
    # The log of an earlier delivery is the only source for a redrive: never written over.
    log.write.mode("errorifexists").parquet(log_path)
    return df.sparkSession.read.schema(log.schema).parquet(log_path)


def sink_metrics(log: DataFrame, by: Sequence[str] = ("url",), flush: str | None = None) -> DataFrame:
    """Request and record counters of a delivery log.

    ``num_records_send_errors`` counts as the sink's metric does: a failed status is one error
    per request, a transport error one per record of its flush. ``records_failed`` is exact.
    """
    lost = F.col("io_error").isNotNull()
    scope = [*by, flush] if flush else list(by)
    per_flush = log.groupBy(*scope).agg(
        F.count(F.lit(1)).alias("requests"),
        F.sum("n_records").alias("records"),
        F.count_if("is_error").alias("requests_failed"),
        F.sum(F.when(F.col("is_error"), F.col("n_records")).otherwise(0)).alias("records_failed"),
        F.count_if(F.col("is_error") & ~lost).alias("_refused"),
        F.sum(F.when(lost, F.col("n_records")).otherwise(0)).alias("_lost"),
        F.max(lost).alias("_any_lost"),
    )
    counted = F.when(F.col("_any_lost"), F.col("records") if flush else F.col("_lost") + F.col("_refused"))
    per_flush = per_flush.withColumn("num_records_send_errors", counted.otherwise(F.col("_refused")))
    names = ["requests", "records", "requests_failed", "records_failed", "num_records_send_errors"]
    return per_flush.groupBy(*by).agg(*[F.sum(n).alias(n) for n in names])


def delivery_counters() -> list[Column]:
    """The counters of ``sink_metrics`` over a whole log, as one aggregation."""
    lost = F.col("io_error").isNotNull()
    errors = F.when(lost, F.col("n_records")).when(F.col("is_error"), F.lit(1)).otherwise(F.lit(0))
    failed = F.when(F.col("is_error"), F.col("n_records")).otherwise(F.lit(0))
    return [
        F.count(F.lit(1)).alias("requests"),
        F.coalesce(F.sum("n_records"), F.lit(0)).alias("records"),
        F.count_if("is_error").alias("requests_failed"),
        F.coalesce(F.sum(failed), F.lit(0)).alias("records_failed"),
        F.coalesce(F.sum(errors), F.lit(0)).alias("num_records_send_errors"),
    ]


def observe_delivery(log: DataFrame) -> tuple[DataFrame, Observation]:
    """The log with its counters observed: ``get`` has them once an action on the log has run.

    They are counted as the rows go by, so neither a pass of their own nor a second delivery is made
    for them. Rows of another action on the same log are not counted again.
    """
    seen = Observation()
    return log.observe(seen, *delivery_counters()), seen


def redrive(log: DataFrame, source: DataFrame) -> DataFrame:
    """Planned requests whose delivery failed, to be sent again (both sides by batch_id)."""
    return source.join(log.where("is_error").select("batch_id").distinct(), "batch_id", "left_semi")

"""Streaming enrichment and streaming delivery, one micro-batch at a time."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql.streaming import DataStreamWriter

from restframe.operators.lookup import Keys, lookup_join
from restframe.sources.delivery import deliver, observe_delivery
from restframe.sources.transport import Transport
from restframe.spec import LookupSpec, SinkSpec


def epoch_writer(work: Callable[[DataFrame, int], DataFrame], path: str) -> Callable[[DataFrame, int], None]:
    """Write each micro-batch to a folder of its own, so a repeated batch replaces itself."""

    def write(batch: DataFrame, epoch: int) -> None:
        work(batch, epoch).write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    return write


def enrich_stream(
    stream: DataFrame, spec: LookupSpec, keys: Keys, transport: Transport, path: str, checkpoint: str, **options: object
) -> DataStreamWriter:
    """Lookup-join an unbounded probe; equal requests of a micro-batch are sent once.

    A partial cache with limits belongs to the stream: workers keep it from one micro-batch to the next.
    """
    if spec.limits_cache and spec.cache_scope is None:
        spec = spec.replace(cache_scope=uuid.uuid4().hex)

    def work(batch: DataFrame, epoch: int) -> DataFrame:
        return lookup_join(batch, spec, keys, transport, **options)

    return stream.writeStream.foreachBatch(epoch_writer(work, path)).option("checkpointLocation", checkpoint)


def deliver_stream(
    stream: DataFrame,
    spec: SinkSpec,
    transport: Transport,
    path: str,
    checkpoint: str,
    lane: Sequence[str],
    slices: Sequence[str],
    order: Sequence[str],
    observed: Callable[[int, dict[str, int]], None] | None = None,
    **options: object,
) -> DataStreamWriter:
    """Deliver an unbounded stream; the delivery log grows below ``path``.

    ``observed`` is told the counters of every epoch, taken from the rows of the log as they are written.

    The trigger interval is the flush time. After a failure the whole micro-batch is sent
    again under the same idempotency keys: at least once. ``checkpoint``, which belongs to one
    stream, and the epoch name a micro-batch, so no other one has its keys.
    """

    def work(batch: DataFrame, epoch: int) -> DataFrame:
        named = json.dumps([checkpoint, epoch])
        return deliver(batch, spec, transport, lane, slices, order, delivery_id=named, **options)

    def write(batch: DataFrame, epoch: int) -> None:
        counted: list[Observation] = []

        def watched(rows: DataFrame, number: int) -> DataFrame:
            log, seen = observe_delivery(work(rows, number))
            counted.append(seen)
            return log

        epoch_writer(watched, path)(batch, epoch)
        if observed is not None:
            observed(epoch, dict(counted[0].get))

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(processingTime=f"{spec.max_time_ms} milliseconds")

"""``df.write`` and ``writeStream`` with ``format("http-sink")``: a data source over (element[, method]) rows."""

from __future__ import annotations

import hashlib
import importlib
import itertools
import json
import logging
import uuid
from collections.abc import Iterator
from concurrent.futures import Future, ThreadPoolExecutor, wait
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage

from restframe.functions.codes import parse_sink_codes
from restframe.operators.batches import with_elements
from restframe.spec import INSERT_METHODS, SinkSpec

_LOG = logging.getLogger(__name__)


@dataclass
class Delivered(WriterCommitMessage):
    requests: int
    records: int
    requests_failed: int
    records_failed: int
    rejected: int = 0


def as_elements(df: DataFrame, spec: SinkSpec) -> DataFrame:
    """The two columns the writer takes, in the sink's format."""
    return with_elements(df, spec).select("method", "element")


class HttpSinkSource(DataSource):
    """Batches every partition as it streams by. Options are the sink option keys.

    Records without an element, with a method the table form does not allow, or above the largest
    size are counted as rejected and not sent. The counts of the whole write, of a stream those of
    each epoch, are logged; with ``log-path``, a folder, they are also written to it as a file of
    JSON. With ``fail-on-error`` true a write with a failed request or a rejected record fails.
    ``sender`` names a ``module:function`` giving the call to use, for tests.

    Delivery is at least once. The ``Idempotency-Key`` of a request names the write (of a stream the
    query and its epoch, which are those of the checkpoint), the partition and the request in it, so a
    task or an epoch that is repeated repeats its keys.
    """

    @classmethod
    def name(cls) -> str:
        return "http-sink"

    def _arguments(self, schema: T.StructType) -> tuple[SinkSpec, str | None, bool, str | None]:
        options = dict(self.options)
        sender, log_path = options.pop("sender", None), options.pop("log-path", None)
        strict = str(options.pop("fail-on-error", "false")).lower() == "true"
        for extra in ("path", "checkpointlocation", "checkpointLocation"):
            options.pop(extra, None)
        if "element" not in schema.fieldNames():
            raise ValueError("http-sink writes an element column (and a method column); see as_elements")
        return SinkSpec.from_options(options), sender, strict, log_path

    def writer(self, schema: T.StructType, overwrite: bool) -> HttpSinkWriter:
        return HttpSinkWriter(*self._arguments(schema))

    def streamWriter(self, schema: T.StructType, overwrite: bool) -> HttpSinkStreamWriter:  # noqa: N802
        return HttpSinkStreamWriter(*self._arguments(schema))


class _Sending:
    """What the writers of tables and of streams have in common."""

    def __init__(self, spec: SinkSpec, sender: str | None, strict: bool = False, log_path: str | None = None) -> None:
        self.spec = spec
        self.sender = sender
        self.strict = strict
        self.log_path = log_path
        # Made once for the write and sent to its tasks: a repeated task repeats its keys.
        self.delivery = uuid.uuid4().hex

    def _named(self, context: TaskContext | None) -> list[str]:
        """What names the write."""
        return [self.delivery]

    def _send(self):
        from restframe.sources.transport import _call, make_opener

        if self.sender:
            module, _, name = self.sender.partition(":")
            return getattr(importlib.import_module(module), name)
        opener = make_opener(self.spec)
        return lambda request: _call(opener, request, self.spec, self.spec.headers)

    def _batches(self, iterator: Iterator[pa.RecordBatch], total: Delivered) -> Iterator[tuple[str, list[str]]]:
        """Requests in order: full, at the byte limit, or ended by a change of method."""
        spec = self.spec
        held: list[str] = []
        verb, size = spec.method, 0
        for batch in iterator:
            elements = batch.column("element").to_pylist()
            named = "method" in batch.schema.names
            verbs = batch.column("method").to_pylist() if named else [spec.method] * len(elements)
            for element, method in zip(elements, verbs, strict=True):
                length = -1 if element is None or method not in INSERT_METHODS else len(element.encode())
                if length < 0 or length > spec.max_record_bytes:
                    total.rejected += 1
                    continue
                if held and (
                    len(held) == spec.batch_size
                    or size + length > spec.max_batch_bytes
                    or method.upper() != verb.upper()
                ):
                    yield verb, held
                    held, size = [], 0
                held.append(element)
                verb, size = method, size + length
        if held:
            yield verb, held

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Delivered:
        from restframe.sources.transport import send_with_retry

        spec, send = self.spec, self._send()
        classes, singles, excluded = parse_sink_codes(spec.error_codes, spec.error_exclude)
        total = Delivered(0, 0, 0, 0)

        context = TaskContext.get()
        part, written = context.partitionId() if context else 0, self._named(context)

        def post(number: int, item: tuple[str, list[str]]) -> tuple[int, bool]:
            verb, elements = item
            body = elements[0] if spec.mode == "single" else f"[{','.join(elements)}]"
            name = json.dumps([*written, part, number])
            headers = {"Idempotency-Key": hashlib.sha256(name.encode()).hexdigest()}
            request = {"request_id": name, "method": verb.upper(), "url": spec.url, "body": body, "headers": headers}
            status = send_with_retry(send, request, spec)["status"]
            bad = status is None or (
                (status // 100 in classes or status in singles) and status not in excluded
            )
            return len(elements), bad

        def post_all(items: list[tuple[int, tuple[str, list[str]]]]) -> list[tuple[int, bool]]:
            return [post(*item) for item in items]

        # One client thread per partition keeps the order of submission. It takes requests by the portion, as
        # handing over each of them costs more than a short one: one is under way while the next is made.
        portion = max(1, spec.max_in_flight // 2)
        under_way: Future | None = None
        with ThreadPoolExecutor(1) as pool:
            requests = enumerate(self._batches(iterator, total))
            while items := list(itertools.islice(requests, portion)):
                if under_way is not None:
                    for sent in under_way.result():
                        _count(total, *sent)
                under_way = pool.submit(post_all, items)
                if spec.max_in_flight == 1:
                    wait([under_way])
            if under_way is not None:
                for sent in under_way.result():
                    _count(total, *sent)
        return total

    def _account(self, messages: list[WriterCommitMessage | None], name: str) -> None:
        """Log what was sent, under the name of the write or of the epoch."""
        parts = [m for m in messages if m is not None]
        counts = {field: sum(getattr(m, field) for m in parts) for field in Delivered.__dataclass_fields__}
        bad = counts["requests_failed"] or counts["rejected"]
        _LOG.log(logging.WARNING if bad else logging.INFO, "http-sink to %s: %s", self.spec.url, json.dumps(counts))
        if self.log_path:
            _write_file(self.log_path, f"{name}.json", json.dumps({"write": name} | counts))
        if self.strict and bad:
            raise RuntimeError(f"http-sink to {self.spec.url}: {json.dumps(counts)}")


class HttpSinkWriter(_Sending, DataSourceArrowWriter):
    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        self._account(messages, self.delivery)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None: ...


class HttpSinkStreamWriter(_Sending, DataSourceStreamArrowWriter):
    def _named(self, context: TaskContext | None) -> list[str]:
        # Set by Spark for the tasks of a micro-batch; a restart from the checkpoint has the same ones.
        known = [context.getLocalProperty(p) for p in ("sql.streaming.queryId", "streaming.sql.batchId")] if context else []
        return [str(x) for x in known] if known and None not in known else [self.delivery]

    def commit(self, messages: list[WriterCommitMessage | None], batchId: int) -> None:  # noqa: N803
        # An epoch that is repeated writes its own file again.
        self._account(messages, f"epoch-{batchId}")

    def abort(self, messages: list[WriterCommitMessage | None], batchId: int) -> None: ...  # noqa: N803


def _write_file(folder: str, name: str, text: str) -> None:
    files, path = pyarrow.fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (pyarrow.fs.LocalFileSystem(), folder)
    files.create_dir(path, recursive=True)
    with files.open_output_stream(f"{path.rstrip('/')}/{name}") as out:
        out.write(text.encode())


def _count(total: Delivered, records: int, bad: bool) -> None:
    total.requests += 1
    total.records += records
    total.requests_failed += bad
    total.records_failed += records * bad


def register_sink(spark: SparkSession) -> None:
    spark.dataSource.register(HttpSinkSource)

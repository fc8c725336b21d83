"""Lookups from SQL: table functions for the calls, a view for the whole join."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udtf, udtf
from pyspark.sql.pandas.types import to_arrow_schema

from restframe.operators.lookup import Keys, lookup_join
from restframe.sources.calls import Calls
from restframe.sources.transport import Send, Transport, _call, make_opener, send_with_retry
from restframe.spec import LookupSpec

FETCH_DDL = "status int, headers map<string,array<string>>, body string, io_error string, n_attempts int"


def register_fetch(spark: SparkSession, name: str, spec: LookupSpec, send: Send | None = None) -> None:
    """``SELECT .. FROM requests r JOIN LATERAL name(r.method, r.url, r.body) ON true``.

    No call is made while a query is planned; Spark evaluates equal arguments once.
    """

    @udtf(returnType=FETCH_DDL)
    class Fetch:
        def __init__(self) -> None:
            self._send = send

        def eval(self, method: str, url: str, body: str) -> Iterator[tuple]:
            if self._send is None:
                opener = make_opener(spec)
                self._send = lambda request: _call(opener, request, spec, spec.headers)
            request = {"request_id": "", "method": method, "url": url, "body": body}
            got = send_with_retry(self._send, request, spec)
            yield got["status"], got["headers"], got["body"], got["io_error"], got["attempt"]

    spark.udtf.register(name, Fetch)


def register_fetch_table(spark: SparkSession, name: str, spec: LookupSpec, send: Send | None = None, carry: str = "") -> None:
    """``SELECT .. FROM name(TABLE(requests))``: the calls of a whole table, a batch of rows at a time.

    ``requests`` has the columns method, url and body, and may have request_id and headers; ``carry`` are
    other columns of it, with their types, that are handed on with the answers. The calls of a batch are
    made by as many threads as the spec has requests in flight, retries wait without holding one. No
    call is made while a query is planned. The rows stay in the partitions they are in.
    """
    fields = [*T.StructType.fromDDL(carry).fields] if carry else []
    schema = T.StructType([*fields, *T.StructType.fromDDL(FETCH_DDL).fields])
    carried = [f.name for f in fields]
    arrow = to_arrow_schema(schema)

    @arrow_udtf(returnType=schema)
    class FetchTable:
        def __init__(self) -> None:
            self._send = send

        def eval(self, batch: pa.RecordBatch) -> Iterator[pa.Table]:
            if self._send is None:
                opener = make_opener(spec)
                self._send = lambda request: _call(opener, request, spec, spec.headers)
            names = [c for c in ("request_id", "method", "url", "body", "headers") if c in batch.schema.names]
            columns = [batch.column(c).to_pylist() for c in names]
            requests = [{"request_id": ""} | dict(zip(names, row, strict=True)) for row in zip(*columns, strict=True)]
            for request in requests:
                if request.get("headers") is not None:
                    request["headers"] = dict(request["headers"])
            done = list(Calls(self._send, spec, spec.threads).run(iter(enumerate(requests))))
            answers = [answer for _, answer in done]
            made = [batch.column(c).take(pa.array([place for place, _ in done], pa.int64())) for c in carried]
            for column in ("status", "headers", "body", "io_error", "attempt"):
                values = [answer[column] for answer in answers]
                if column == "headers":
                    values = [None if v is None else list(v.items()) for v in values]
                made.append(pa.array(values, arrow.field(len(made)).type))
            yield pa.Table.from_arrays(made, names=arrow.names)

    spark.udtf.register(name, FetchTable)


def create_lookup_view(
    name: str, probe: DataFrame, spec: LookupSpec, keys: Keys, transport: Transport, **options: object
) -> None:
    """Make the lookup join of ``probe`` a temporary view."""
    lookup_join(probe, spec, keys, transport, **options).createOrReplaceTempView(name)

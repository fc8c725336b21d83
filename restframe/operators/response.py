"""Responses -> completion state, error text, decoded rows. Columns only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from restframe.functions.codes import status_in
from restframe.functions.formats import DECODERS, decode_wire, is_object, wire_failed, wire_json
from restframe.spec import ARRAY, LookupSpec

# Completion states and metadata column names.
SUCCESS = "SUCCESS"
HTTP_ERROR_STATUS = "HTTP_ERROR_STATUS"
EXCEPTION = "EXCEPTION"
UNABLE_TO_DESERIALIZE = "UNABLE_TO_DESERIALIZE_RESPONSE"
IGNORED_STATUS = "IGNORE_STATUS_CODE"

METADATA = {
    "error-string": "error_string",
    "http-status-code": "status",
    "http-headers": "headers",
    "http-headers-map": "headers",
    "http-completion-state": "completion_state",
}

FAILED_STATES = (HTTP_ERROR_STATUS, EXCEPTION, UNABLE_TO_DESERIALIZE)


def pruned_schema(schema: T.StructType, select: Sequence[str] | None) -> T.StructType:
    """The declared schema cut to the wanted top-level and nested (``a.b.c``) fields."""
    if select is None:
        return schema
    wanted: dict[str, list[str]] = {}
    for path in select:
        head, _, rest = path.partition(".")
        wanted.setdefault(head, []).append(rest)
    unknown = sorted(set(wanted) - set(schema.fieldNames()))
    if unknown:
        raise ValueError(f"fields {unknown} are not in the lookup schema")
    fields = []
    for f in schema.fields:
        if f.name not in wanted:
            continue
        dtype = f.dataType
        if isinstance(dtype, T.StructType) and "" not in wanted[f.name]:
            dtype = pruned_schema(dtype, wanted[f.name])
        fields.append(T.StructField(f.name, dtype))
    return T.StructType(fields)


def _state(spec: LookupSpec, decode_failed: Column) -> Column:
    """The decision order: exception, error status, ignored status, blank body, decode failure."""
    return (
        F.when(F.col("io_error").isNotNull() | F.col("status").isNull(), EXCEPTION)
        .when(~status_in(F.col("status"), spec.success_set), HTTP_ERROR_STATUS)
        .when(status_in(F.col("status"), spec.ignored_set), IGNORED_STATUS)
        .when(_blank(F.col("body")), SUCCESS)
        .when(decode_failed, UNABLE_TO_DESERIALIZE)
        .otherwise(SUCCESS)
    )


def _blank(body: Column) -> Column:
    """No data: nothing but blanks, or the JSON null literal."""
    return F.coalesce(body, F.lit("")).rlike(r"^\s*(null\s*)?$")


def _readable(spec: LookupSpec) -> Column:
    """Responses whose body is worth decoding."""
    status = F.col("status")
    usable = F.col("io_error").isNull() & status_in(status, spec.success_set)
    return usable & ~status_in(status, spec.ignored_set) & ~_blank(F.col("body"))


def process_responses(
    responses: DataFrame, spec: LookupSpec, select: Sequence[str] | None = None
) -> DataFrame:
    """Add completion_state, error_string and ``rows`` (``array<struct>``, empty = no data)."""
    schema = pruned_schema(spec.row_type, select)
    body = F.when(_readable(spec), F.col("body"))
    if spec.response_format != "json":
        decoded = responses.withColumn(
            "_one", DECODERS[spec.response_format](body, schema, spec.response_options)
        )
        failed = F.col("_one").isNull()
        rows = F.array(F.col("_one"))
        keep = ~failed
    elif spec.result_type == ARRAY:
        # Each element is parsed on its own, so one bad element is known as such.
        elements = F.from_json(body, T.ArrayType(T.StringType()))
        decoded = responses.withColumn("_elements", elements).withColumn(
            "_wires",
            F.transform(
                F.filter(F.col("_elements"), lambda e: e.isNotNull()),
                lambda e: F.struct(e.alias("text"), wire_json(e, schema).alias("wire")),
            ),
        )
        if spec.ignore_parse_errors:
            failed = F.col("_elements").isNull()
            good = F.filter(F.col("_wires"), lambda e: is_object(e["text"]))
        else:
            failed = F.col("_elements").isNull() | F.exists(
                F.col("_wires"), lambda e: wire_failed(e["wire"], schema)
            )
            good = F.col("_wires")
        rows = F.transform(good, lambda e: decode_wire(e["wire"], schema))
        keep = ~failed
    else:
        decoded = responses.withColumn("_wire", wire_json(body, schema))
        broken = wire_failed(F.col("_wire"), schema)
        rows = F.array(decode_wire(F.col("_wire"), schema))
        if spec.ignore_parse_errors:
            # A bad field is null; a body that is no object at all gives no row.
            failed = F.lit(False)
            keep = ~broken | is_object(F.col("body"))
        else:
            failed = broken
            keep = ~broken
    element = T.ArrayType(schema).simpleString()
    empty = F.expr(f"cast(array() as {element})")
    state = _state(spec, failed)
    return (
        decoded.withColumn("completion_state", state)
        .withColumn(
            "rows",
            F.when(
                (F.col("completion_state") == SUCCESS) & _readable(spec) & F.coalesce(keep, F.lit(False)), rows
            ).otherwise(empty),
        )
        .withColumn(
            "error_string",
            F.when(F.col("completion_state") == EXCEPTION, F.coalesce(F.col("io_error"), F.lit("no response")))
            .when(F.col("completion_state").isin(HTTP_ERROR_STATUS, UNABLE_TO_DESERIALIZE), F.col("body")),
        )
        .drop("_one", "_elements", "_wires", "_wire")
    )


def fail_on_error(outcome: DataFrame, spec: LookupSpec) -> DataFrame:
    """Unless errors are to be survived, stop the job on the first failed lookup."""
    if spec.continue_on_error:
        return outcome
    # The check sits in the rows, which emission always reads. As a filter it would be pushed
    # down and decode every body a second time.
    problem = F.concat_ws(
        " ", F.lit("lookup failed:"), F.col("completion_state"), F.col("status"), F.col("error_string")
    )
    failed = F.col("completion_state").isin(*FAILED_STATES)
    return outcome.withColumn("rows", F.when(failed, F.raise_error(problem)).otherwise(F.col("rows")))


def metadata_columns(names: Sequence[str]) -> list[Column]:
    """Requested metadata in the requested order, under their metadata names."""
    unknown = [n for n in names if n not in METADATA]
    if unknown:
        raise ValueError(f"unknown metadata {unknown}; known: {list(METADATA)}")
    return [F.col(METADATA[n]).alias(n) for n in names]


def emit_rows(
    outcome: DataFrame,
    spec: LookupSpec,
    metadata: Sequence[str] = (),
    carry: Sequence[str] = ("request_id",),
    select: Sequence[str] | None = None,
    keep_empty: bool = False,
) -> DataFrame:
    """Carried columns, decoded columns, metadata columns; one output row per decoded row.

    Without data there is no row, unless metadata was asked for (or ``keep_empty``): then one
    row of nulls.
    """
    fields = pruned_schema(spec.row_type, select).fieldNames()
    rows = F.col("rows")
    if spec.max_rows_per_key == 1:
        rows = F.slice(rows, 1, 1)
    # Outer, then filtered: a plain explode adds a test of the rows that decodes them twice.
    exploded = outcome.withColumn("_row", F.explode_outer(rows))
    if not metadata and not keep_empty:
        exploded = exploded.where(F.col("_row").isNotNull())
    return exploded.select(
        *carry, *[F.col("_row")[name].alias(name) for name in fields], *metadata_columns(metadata)
    )

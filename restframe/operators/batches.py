"""Sink planning: rows -> elements -> flushes and request batches. Columns and windows only."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from restframe.functions.formats import ENCODERS, format_options
from restframe.operators.greedy import greedy_marks
from restframe.operators.sequence import number_runs, running_totals
from restframe.spec import INSERT_METHODS, SinkSpec

Converter = Callable[[DataFrame], tuple[Column, Column]]


def element_column(df: DataFrame, spec: SinkSpec, columns: Sequence[str] | None = None) -> Column:
    """The chosen columns of a row as one element in the sink's format."""
    names = list(columns or df.columns)
    types = {f.name: f.dataType for f in df.schema.fields}
    fields = [(n, F.col(f"`{n}`"), types[n]) for n in names]
    return ENCODERS[spec.format](fields, format_options(spec.options, spec.format))


def with_elements(
    df: DataFrame,
    spec: SinkSpec,
    columns: Sequence[str] | None = None,
    method: Column | None = None,
    converter: Converter | None = None,
) -> DataFrame:
    """Add ``method`` and ``element``; a converter gives both from the row itself."""
    if converter is not None:
        verb, element = converter(df)
    else:
        verb, element = (F.lit(spec.method) if method is None else method), element_column(df, spec, columns)
    return df.withColumn("method", verb).withColumn("element", element)


def element_bytes() -> Column:
    return F.octet_length("element").cast("bigint")


def is_oversize(spec: SinkSpec) -> Column:
    return element_bytes() > spec.max_record_bytes


def method_error(allowed: Sequence[str] = INSERT_METHODS) -> Column:
    """Why a record's method is not allowed in the table form; null when it is."""
    return F.when(
        ~F.coalesce(F.col("method").isin(*allowed), F.lit(False)),
        F.concat(F.lit("method not allowed: "), F.coalesce(F.col("method"), F.lit("null"))),
    )


def reject_reason(spec: SinkSpec, allowed: Sequence[str] | None = None) -> Column:
    """Why a row cannot be delivered; null when it can. ``allowed``: the methods of the table form."""
    no_method = F.when(F.col("method").isNull(), "method not allowed: null")
    return F.coalesce(
        F.when(F.col("element").isNull(), "no element"),
        no_method if allowed is None else method_error(allowed),
        F.when(is_oversize(spec), "record too large"),
    )


def split_elements(
    elements: DataFrame, spec: SinkSpec, allowed: Sequence[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(deliverable rows, rejected rows with a ``reject_reason``)."""
    marked = elements.withColumn("reject_reason", reject_reason(spec, allowed))
    good = marked.where(F.col("reject_reason").isNull()).drop("reject_reason")
    return good, marked.where(F.col("reject_reason").isNotNull())


def plan_batches(
    elements: DataFrame,
    spec: SinkSpec,
    lane: Sequence[str],
    slices: Sequence[str],
    order: Sequence[str],
    by_method: bool = True,
    by_bytes: bool = False,
    upper: bool = False,
) -> DataFrame:
    """Add ``seq``, ``flush_seq`` and ``batch_seq`` to every row of a lane.

    A lane is one ordered stream to the endpoint. It is cut into flushes of ``max_batch_size``
    rows (and of ``max_batch_bytes``, if ``by_bytes``), a flush into runs of equal method, a run
    into requests of ``batch_size`` rows; each is named by the position of its first row. ``slices`` are the leading columns of the
    ordering by which a lane of any size is spread over tasks. ``upper``: methods are in upper case already.
    """
    # With a limit of bytes, their running total comes from the windows that number the rows.
    totals = {"_bytes": element_bytes()} if by_bytes else {}
    if by_method:
        placed = number_runs(elements, lane, slices, order, "method" if upper else F.upper("method"), weights=totals)
    else:
        placed = running_totals(elements, lane, slices, order, {"seq": F.lit(1).cast("bigint")} | totals)
        placed = placed.withColumn("run_seq", F.lit(0).cast("bigint"))
    if by_bytes:
        reached = placed.withColumn("_after", F.col("_bytes") + element_bytes())
        marked = greedy_marks(
            reached, lane, slices[0], ["seq"], "_bytes", "_after", spec.max_batch_bytes, seq="seq",
            max_rows=spec.max_batch_size, keep=placed.columns,
        )
        placed = marked.withColumnRenamed("mark_seq", "flush_seq").drop("is_mark", "mark_lo", "_bytes")
    else:
        placed = placed.withColumn("flush_seq", F.col("seq") - F.col("seq") % spec.max_batch_size)
    start = F.greatest(F.col("flush_seq"), F.col("run_seq"))
    return (
        placed.withColumn("_start", start)
        .withColumn("batch_seq", F.col("seq") - (F.col("seq") - F.col("_start")) % spec.batch_size)
        .drop("_start", "run_seq")
    )


def plan_byte_flushes(
    elements: DataFrame,
    spec: SinkSpec,
    lane: Sequence[str],
    slice_column: str,
    order: Sequence[str],
) -> DataFrame:
    """(lane, slice, order, n_bytes, seq, flush_seq): flushes of at most ``max_batch_bytes`` and ``max_batch_size`` rows."""
    sized = elements.select(*dict.fromkeys([*lane, slice_column, *order]), element_bytes().alias("n_bytes"))
    placed = running_totals(
        sized, lane, [slice_column], order, {"seq": F.lit(1).cast("bigint"), "_before": F.col("n_bytes")}
    ).withColumn("_after", F.col("_before") + F.col("n_bytes"))
    marked = greedy_marks(
        placed,
        lane,
        slice_column,
        ["seq"],
        "_before",
        "_after",
        spec.max_batch_bytes,
        seq="seq",
        max_rows=spec.max_batch_size,
        keep=[*order, "n_bytes"],
    )
    return marked.withColumnRenamed("mark_seq", "flush_seq").drop("is_mark", "mark_lo")


#: Columns that a plan adds or works on; elements made of such columns are made before it.
PLANNED = {"method", "element", "seq", "run_seq", "flush_seq", "batch_seq"}


def plan_then_elements(
    df: DataFrame,
    spec: SinkSpec,
    lane: Sequence[str],
    slices: Sequence[str],
    order: Sequence[str],
    columns: Sequence[str] | None = None,
    method: Column | None = None,
    by_method: bool = True,
) -> DataFrame:
    """``plan_batches`` of rows that are all deliverable: elements are made of the rows in their places, so the
    columns are moved to them, which take less room than the elements."""
    names = list(columns or df.columns)
    if PLANNED & set(names):
        return plan_batches(with_elements(df, spec, names, method), spec, lane, slices, order, by_method)
    told = df.withColumn("method", F.upper(F.lit(spec.method) if method is None else method))
    planned = plan_batches(told, spec, lane, slices, order, by_method, upper=True)
    return planned.withColumn("element", element_column(planned, spec, names))


def name_of(*parts: Column) -> Column:
    """A JSON array of texts: other parts give another name, null is not the text ``null``."""
    return F.to_json(F.array(*[p.cast("string") for p in parts]))


def batch_id(lane: Sequence[str]) -> Column:
    """A name for a request that stays the same when the plan is run again."""
    return name_of(*map(F.col, lane), F.col("batch_seq"))


def make_requests(planned: DataFrame, spec: SinkSpec, lane: Sequence[str]) -> DataFrame:
    """One row per request: batch_id, method, url, n_records, n_bytes, body."""
    if spec.mode == "single":
        return planned.select(
            *lane,
            "batch_seq",
            batch_id(lane).alias("batch_id"),
            F.upper("method").alias("method"),
            F.lit(spec.url).alias("url"),
            F.lit(1).cast("bigint").alias("n_records"),
            element_bytes().alias("n_bytes"),
            F.col("element").alias("body"),
        )
    # A group holds at most batch_size elements.
    ordered = F.sort_array(F.collect_list(F.struct("seq", "element")))
    body = F.concat(F.lit("["), F.array_join(ordered["element"], ","), F.lit("]"))
    return (
        planned.groupBy(*lane, "batch_seq")
        .agg(
            F.upper(F.min_by("method", "seq")).alias("method"),
            F.count(F.lit(1)).alias("n_records"),
            F.sum(element_bytes()).alias("n_bytes"),
            body.alias("body"),
        )
        .select(
            *lane,
            "batch_seq",
            batch_id(lane).alias("batch_id"),
            "method",
            F.lit(spec.url).alias("url"),
            "n_records",
            "n_bytes",
            "body",
        )
    )

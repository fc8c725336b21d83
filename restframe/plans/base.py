"""Registry of queries and their checking SQL, and derivations both sides share as SQL text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``; ``sql`` is the same result in ANSI SQL."""

    def add(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same table as a stream of its files, at most a gigabyte per micro-batch."""
    source = spark.readStream.schema(table(spark, sf_dir, name).schema)
    # As a pattern the path may be one file or a folder of files.
    return source.option("maxBytesPerTrigger", str(1 << 30)).parquet(f"{sf_dir}/{name}.parque[t]")


#: Bytes of a row group in the files a stream is made of. A file can be read by as many tasks as it has row groups, so
#: a micro-batch of one file is not one task.
ROW_GROUP = 1 << 18

# Derivations that read the same in both SQL dialects.
EVENT_STATUS = "case event_type when 'error' then 503 when 'click' then 404 when 'view' then 201 else 200 end"
# Bodies of every kind: an object, blank, no JSON, an object with a field of another type.
EVENT_BODY = (
    "case when event_id % 11 = 0 then '  ' when event_id % 7 = 0 then concat('oops ', event_type) "
    "when event_id % 5 = 0 then concat('{\"k\":\"x', event_type, '\"}') else props end"
)
EVENT_IO_ERROR = "case when event_id % 13 = 0 then concat('connection reset by ', event_type) end"
LINE_METHOD = "case when l_linenumber % 3 = 0 then 'PUT' else 'POST' end"


def encode_sql(text: str) -> str:
    """Form encoding of a SQL text expression, on the checking side."""
    return f"replace(replace(replace(url_encode({text}), '%20', '+'), '%2A', '*'), '~', '%7E')"


def event_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table read as a table of responses."""
    return table(spark, sf_dir, "events").selectExpr(
        "cast(event_id as string) as request_id",
        "event_id",
        "1 as attempt",
        f"case when event_id % 13 <> 0 then {EVENT_STATUS} end as status",
        "case when event_id % 13 <> 0 then map('X-Type', array(event_type, 'v1')) end as headers",
        f"case when event_id % 13 <> 0 then {EVENT_BODY} end as body",
        f"{EVENT_IO_ERROR} as io_error",
    )


# The same table on the checking side.
RESPONSES_SQL = f"""
    select event_id, event_type, props,
           case when event_id % 13 <> 0 then {EVENT_STATUS} end as status,
           case when event_id % 13 <> 0 then {EVENT_BODY} end as body,
           {EVENT_IO_ERROR} as io_error
    from events"""

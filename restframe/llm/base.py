"""Registry of the queries of this subpackage, the tables they read, and tables kept between steps."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField, StructType

from restframe.session import keep

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

__all__ = ["ORACLES", "QUERIES", "WORD", "extended", "keep", "query", "release_memory", "returns_memory", "table"]

#: Fixed value: a word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``; ``sql`` is the same result in DuckDB's SQL."""

    def add(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def extended(df: DataFrame, added: str) -> StructType:
    """The schema of a Python stage that passes on the columns of a frame and adds others, written as text."""
    passed = [StructField(f.name, f.dataType) for f in df.schema.fields]
    return StructType(passed + StructType.fromDDL(added).fields)


def release_memory() -> None:
    """Give back to the system what earlier tasks of this Python worker have freed; called as a heavy one starts.

    Workers outlive their tasks, and the allocator keeps what it was given: without this a worker holds
    the largest of all stages it has run, not that of the one it runs.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def returns_memory(run: Callable[..., Iterator[pa.RecordBatch]]) -> Callable[..., Iterator[pa.RecordBatch]]:
    """For the function of a heavy Python stage: memory is released as its task starts, and again when it has ended.

    A worker that no later task takes up would else hold what its last task had.
    """

    @wraps(run)
    def call(*args) -> Iterator[pa.RecordBatch]:
        release_memory()
        yield from run(*args)
        release_memory()

    return call

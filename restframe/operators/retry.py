"""Retry schedules and resolution over a table of attempts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from restframe.functions.codes import status_in
from restframe.spec import EXPONENTIAL_DELAY, LookupSpec


def backoff(attempt: int, spec: LookupSpec) -> float:
    """Seconds to wait after the given attempt (1-based) before the next one."""
    if spec.retry_strategy == EXPONENTIAL_DELAY:
        return min(spec.max_backoff, spec.initial_backoff * spec.backoff_multiplier ** (attempt - 1))
    return spec.fixed_delay


def wait_ms(attempt: Column, spec: LookupSpec) -> Column:
    """Planned wait before an attempt, in milliseconds; 0 before the first."""
    # The schedule is one array per spec, so a row only looks its attempt up.
    waits = [0, *[round(1000 * backoff(n, spec)) for n in range(1, spec.max_retries + 1)]]
    return F.get(F.array(*[F.lit(w).cast("bigint") for w in waits]), attempt - 1)


def cumulative_wait_ms(attempt: Column, spec: LookupSpec) -> Column:
    """Planned wait from the first attempt to this one, in milliseconds."""
    total, sums = 0, [0]
    for n in range(1, spec.max_retries + 1):
        total += round(1000 * backoff(n, spec))
        sums.append(total)
    return F.get(F.array(*[F.lit(s).cast("bigint") for s in sums]), attempt - 1)


def with_schedule(attempts: DataFrame, spec: LookupSpec) -> DataFrame:
    """Allowed attempts with planned waits; attempts past the limit never happen."""
    allowed = attempts.where(F.col("attempt").between(1, spec.max_retries + 1))
    return allowed.withColumn("wait_ms", wait_ms(F.col("attempt"), spec)).withColumn(
        "cumulative_wait_ms", cumulative_wait_ms(F.col("attempt"), spec)
    )


def is_terminal(spec: LookupSpec) -> Column:
    """An attempt after which nothing is retried: an answer that is no retry code."""
    return F.col("io_error").isNull() & ~status_in(F.col("status"), spec.retry_set)


def resolve_attempts(
    attempts: DataFrame, spec: LookupSpec, key: Sequence[str] = ("request_id",)
) -> DataFrame:
    """One row per request: its final attempt and the number of attempts made.

    Final is the first terminal attempt, or else the last one allowed. A plain aggregation:
    attempts fold on the map side, so a request with very many rows is no hot spot.
    """
    allowed = attempts.where(F.col("attempt") <= spec.max_retries + 1)
    rest = [c for c in attempts.columns if c not in key and c != "attempt"]
    record = F.struct("attempt", *rest)
    first_terminal = F.min_by(record, F.when(is_terminal(spec), F.col("attempt")))
    last = F.max_by(record, F.col("attempt"))
    return (
        allowed.groupBy(*key)
        .agg(first_terminal.alias("_first"), last.alias("_last"))
        .withColumn("_final", F.coalesce("_first", "_last"))
        .select(*key, F.col("_final.attempt").alias("n_attempts"), *[F.col(f"_final.{c}").alias(c) for c in rest])
    )


def retry_counters(final: DataFrame, spec: LookupSpec, by: Sequence[str] = ()) -> DataFrame:
    """Successful calls with and without a retry, and failed calls."""
    good = F.col("io_error").isNull() & status_in(F.col("status"), spec.success_set)
    return final.groupBy(*by).agg(
        F.count_if(good & (F.col("n_attempts") > 1)).alias("successful_with_retry"),
        F.count_if(good & (F.col("n_attempts") == 1)).alias("successful_without_retry"),
        F.count_if(~good).alias("failed"),
    )

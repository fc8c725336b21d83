"""Bearer tokens from an issue log: which token a request would carry."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from restframe.operators.sequence import last_value_before, time_slices


def token_expiry(issued: Column, expires_in: Column, reduction: int = 1) -> Column:
    """issued + lifetime, shortened by ``reduction`` seconds unless the life is no longer than that."""
    life = F.when(expires_in > reduction, expires_in - reduction).otherwise(expires_in)
    return issued + F.make_dt_interval(secs=life.cast("decimal(18,6)"))


def assign_tokens(
    requests: DataFrame,
    tokens: DataFrame,
    at: str,
    lane: Sequence[str] = (),
    slice_of: str = "day",
    hot_slice_of: str = "minute",
    order: Sequence[str] = (),
    reduction: int = 1,
) -> DataFrame:
    """As-of join: the newest token issued at or before ``at``, null once it has expired.

    ``tokens`` has (lane..., token, issued, expires_in). ``order`` breaks ties of ``at``; of tokens
    issued at the same time the greatest wins, of equal ones the one that lives longest.
    """
    width = [f for f in requests.schema.fields]
    stamped = tokens.select(
        *lane,
        F.col("issued").alias("_at"),
        F.struct("token", token_expiry(F.col("issued"), F.col("expires_in"), reduction).alias("expires")).alias(
            "_issued"
        ),
    )
    # Only tokens have a tie to break; requests come after all tokens of their time.
    stamped = stamped.withColumn("_tie", F.struct("_issued.token", "_issued.expires"))
    asked = requests.withColumn("_at", F.col(at)).withColumn("_asks", F.lit(1))
    slices = time_slices(requests, lane, "_at", slice_of, hot_slice_of)
    merged = asked.unionByName(stamped, allowMissingColumns=True).withColumns(
        {"_slice": slices, "_asks": F.coalesce("_asks", F.lit(0))}
    )
    matched = last_value_before(
        merged, lane, ["_slice"], ["_at", "_asks", "_tie", *order], F.col("_issued"), "_token", inclusive=True
    )
    fresh = F.when(F.col("_at") <= F.col("_token.expires"), F.col("_token.token"))
    return matched.where(F.col("_asks") == 1).select(*[f.name for f in width], fresh.alias("token"))

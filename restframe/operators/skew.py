"""Joins that stay balanced when a few keys hold a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key is hot when it holds more than one in HOT_KEYS of all rows, so there are fewer than
# HOT_KEYS hot keys whatever the data; each is kept as an eight-byte hash.
HOT_KEYS = 1000
# Keys that get salts of their own, the largest first (16 bytes each, sent to every task), and rows
# below which no key is worth it.
SALTED_KEYS = 10_000
LEAST_ROWS = 256


def hot_hashes(counts: DataFrame, keys: Sequence[str], n: str) -> Column:
    """The hashes of the hot keys of a (keys, n) count table, as one small array."""
    total = counts.select(F.sum(n)).scalar()
    hot = counts.where(F.col(n) * HOT_KEYS > total)
    return hot.select(F.collect_set(F.xxhash64(*keys))).scalar()


def key_salts(counts: DataFrame, keys: Sequence[str], n: str, target_rows: int | None = None) -> DataFrame:
    """(_hash, _salts): how many tasks the rows of a large key are spread over, so that each gets ``target_rows``.

    By default a quarter of what a shuffle partition holds on average, so a few times as many keys as
    there are partitions can be that large; the ``SALTED_KEYS`` largest get salts.
    """
    if target_rows is None:
        places = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        total = counts.select(F.sum(n)).scalar()
        target = F.greatest(F.lit(LEAST_ROWS), F.ceil(F.coalesce(total, F.lit(0)) / (4 * places)))
    else:
        target = F.lit(target_rows)
    large = counts.where(F.col(n) > target).orderBy(F.desc(n)).limit(SALTED_KEYS)
    salted = large.select(F.xxhash64(*keys).alias("_salted_hash"), F.ceil(F.col(n) / target).cast("long").alias("_salts"))
    # Keys that share their hash are treated alike on both sides.
    return salted.groupBy("_salted_hash").agg(F.max("_salts").alias("_salts"))


def salted_join(
    big: DataFrame,
    small: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    counts: DataFrame | None = None,
    n: str = "n",
    target_rows: int | None = None,
    broadcast: bool = True,
) -> DataFrame:
    """``big JOIN small USING (keys)``, large keys of ``big`` spread over as many tasks as their rows need.

    ``how`` is inner, left or right. Only rows of large keys get a salt and only the matching rows of
    ``small`` are copied, once per salt; with no large key this is the plain join. The salt is a
    hash of the row, so a task that is run again sends every row to the same place. ``counts`` is a
    (keys, n) table of ``big`` when the caller already has one. Without ``broadcast`` both sides are
    shuffled and sorted, whatever size the optimizer takes them for: it guesses from the files they come
    from, and text made of their columns may be many times larger.
    """
    if counts is None:
        counts = big.groupBy(*keys).agg(F.count(F.lit(1)).alias(n))
    # At most SALTED_KEYS rows.
    salts = F.broadcast(key_salts(counts, keys, n, target_rows))

    def with_salts(side: DataFrame) -> DataFrame:
        return side.withColumn("_salted_key", F.xxhash64(*keys)).join(salts, F.col("_salted_key") == F.col("_salted_hash"), "left").drop("_salted_key", "_salted_hash")

    row_hash = F.xxhash64(*[F.col(c) for c in hashable(big)])
    # A null key matches nothing, so its rows may go anywhere.
    null_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    free = F.when(null_key, F.greatest(F.coalesce("_salts", F.lit(1)), F.lit(64))).otherwise(F.coalesce("_salts", F.lit(1)))
    left = with_salts(big.withColumn("_row", row_hash)).withColumn("_salt", F.pmod("_row", free)).drop("_row", "_salts")
    if not broadcast:
        left = left.hint("merge")
    right = with_salts(small).withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("_salts", F.lit(1)) - 1)))
    if how != "right":
        return left.join(right.drop("_salts"), [*keys, "_salt"], how).drop("_salt")
    # A large key has matches, though maybe not under every salt: those copies are no misses.
    joined = left.withColumn("_found", F.lit(True)).join(right, [*keys, "_salt"], "right")
    missed_copy = F.col("_found").isNull() & F.col("_salts").isNotNull()
    return joined.where(~missed_copy).drop("_salt", "_found", "_salts")


def hashable(df: DataFrame) -> list[str]:
    """Columns a row hash can use (maps cannot be hashed)."""
    return [f"`{f.name}`" for f in df.schema.fields if "map<" not in f.dataType.simpleString()]

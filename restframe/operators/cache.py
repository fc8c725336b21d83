"""Lookup cache as analysis over an access log, and a cross-run store."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from restframe.operators.greedy import greedy_marks, group_bounds
from restframe.operators.sequence import is_hot, last_value_before, number_rows, running_totals, time_slices
from restframe.session import keep as kept_table


def access_ttl(
    accesses: DataFrame,
    key: str,
    at: str,
    order: Sequence[str],
    ttl: Column,
    slice_of: str = "day",
    hot_slice_of: str = "minute",
) -> DataFrame:
    """expire-after-access: a hit when the gap to the previous access of the key is within ``ttl``."""
    sliced = accesses.withColumn("_slice", time_slices(accesses, [key], at, slice_of, hot_slice_of))
    seen = last_value_before(sliced, [key], ["_slice"], [at, *order], F.col(at), "_seen")
    hit = F.coalesce(F.col(at) - F.col("_seen") <= ttl, F.lit(False))
    return seen.withColumn("hit", hit).drop("_slice", "_seen")


def write_ttl(
    accesses: DataFrame,
    key: str,
    at: str,
    order: Sequence[str],
    ttl_ms: int,
    slice_of: str = "day",
    hot_slice_of: str = "minute",
) -> DataFrame:
    """expire-after-write: an entry lives ``ttl_ms`` from the miss that loaded it.

    A slice of a hot key is held in memory; the accesses of any other key stream through one task.
    """
    sliced = accesses.select(
        key,
        at,
        *order,
        time_slices(accesses, [key], at, slice_of, hot_slice_of).alias("_slice"),
        F.unix_micros(F.col(at).cast("timestamp")).alias("_us"),
        is_hot(accesses, [key]).alias("_hot"),
    )
    marked = greedy_marks(sliced, [key], "_slice", [at, *order], "_us", "_us", ttl_ms * 1000, cut=F.col("_hot"))
    return marked.select(key, at, *order, (~F.col("is_mark")).alias("hit"))


def smaller_before(values: np.ndarray) -> np.ndarray:
    """For each element, how many before it are smaller: a merge sort that counts, all runs of a level at once."""
    n, base = len(values), 32
    if n < 2:
        return np.zeros(n, np.int64)
    ranks = np.unique(values, return_inverse=True)[1].astype(np.int64)
    size = base
    while size < n:
        size *= 2
    # Padding stands behind everything and is not smaller than anything.
    runs = np.append(ranks, np.full(size - n, n, np.int64)).reshape(-1, base)
    earlier = np.tri(base, k=-1, dtype=bool)
    found = np.concatenate([((part[:, None, :] < part[:, :, None]) & earlier).sum(axis=2).ravel() for part in np.array_split(runs, -(-len(runs) // 256))])
    places = np.argsort(runs, axis=1, kind="stable") + np.arange(len(runs))[:, None] * base
    runs = np.sort(runs, axis=1, kind="stable")
    while len(runs) > 1:
        length = runs.shape[1]
        left, right = runs[0::2], runs[1::2]
        # One search for all pairs of runs: each pair has a range of numbers of its own.
        apart = np.arange(len(left))[:, None] * (n + 1)
        smaller = np.searchsorted((left + apart).ravel(), (right + apart).ravel(), side="left").reshape(right.shape)
        found[places[1::2].ravel()] += (smaller - np.arange(len(left))[:, None] * length).ravel()
        runs, places = np.concatenate([left, right], axis=1), np.concatenate([places[0::2], places[1::2]], axis=1)
        order = np.argsort(runs, axis=1, kind="stable")
        runs, places = np.take_along_axis(runs, order, axis=1), np.take_along_axis(places, order, axis=1)
    return found[:n]


def _counted(rows: DataFrame, group: Sequence[str], order: str, value: str, into: str) -> DataFrame:
    """Add, within each group, how many rows before this one (by ``order``) have a smaller ``value``.

    Rows with a null value are not counted and get 0. A group is held in one task, as two numbers a row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def done() -> Iterator[pa.RecordBatch]:
            whole = pa.Table.from_batches(held).combine_chunks()
            if whole.num_rows:
                values = whole.column(value).to_numpy()
                known = ~np.isnan(values) if values.dtype.kind == "f" else np.ones(len(values), bool)
                counts = np.zeros(len(values), np.int64)
                counts[known] = smaller_before(values[known])
                yield from whole.append_column(into, pa.array(counts)).to_batches()

        current = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.select(list(group)).to_pandas()
            for start, end in group_bounds(keys):
                key = tuple(keys.iloc[start])
                if held and key != current:
                    yield from done()
                    held = []
                current = key
                held.append(batch.slice(start, end - start))
        if held:
            yield from done()

    ddl = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields] + [f"{into} bigint"])
    return rows.repartition(*group).sortWithinPartitions(*group, order).mapInArrow(run, ddl)


def lru(
    accesses: DataFrame,
    lane: str,
    key: str,
    at: str,
    order: Sequence[str],
    max_rows: int,
    slice_of: str = "day",
    hot_slice_of: str = "hour",
    block_rows: int = 1 << 18,
) -> DataFrame:
    """max-rows: a cache per lane that keeps the ``max_rows`` most recently used keys.

    An access hits if fewer than ``max_rows`` other keys were used since the last access of its own:
    its reuse distance. With positions i in the lane and p(i) of the previous access of the key, the
    distance is the number of j < i with p(j) < p(i), less the p(i) + 1 positions up to p(i), which
    all count among them; a first access has no p and counts as smaller than any. So the work is to
    count, for each row, the rows before it with a smaller number, and that is done offline:

    * first accesses by a running total;
    * pairs with p in the same block of ``block_rows`` positions, block by block (a position is the
      previous access of one row at most, so such a group is no larger than a block);
    * pairs with p in different blocks: within a block of i by the numbers of p's blocks, and across
      blocks from a table that counts rows by (block of i, block of p).

    No list of keys is kept, whatever ``max_rows`` is, and a task holds one block. Lane and key may be null.
    """
    kept = list(dict.fromkeys([lane, key, at, *order]))
    sliced = accesses.select(*kept, time_slices(accesses, [lane], at, slice_of, hot_slice_of).alias("_slice"))
    one = F.lit(1).cast("bigint")
    placed = number_rows(sliced, [lane], ["_slice"], [at, *order], "_i")
    own = F.struct(lane, key)
    before = last_value_before(placed.withColumn("_own", own), ["_own"], ["_slice"], [at, *order], F.col("_i"), "_p")
    firsts = running_totals(before, [lane], ["_slice"], [at, *order], {"_first": F.when(F.col("_p").isNull(), one).otherwise(0 * one)})
    rows = firsts.drop("_slice", "_own").withColumn("_lane", F.xxhash64(F.col(lane).isNull(), lane))
    block = lambda c: F.floor(F.col(c) / block_rows)
    rows = rows.withColumn("_bi", block("_i")).withColumn("_bp", block("_p"))
    # First accesses have no block of p; they go along under numbers of their own.
    rows = rows.withColumn("_g", F.coalesce("_bp", -1 - F.col("_bi")))
    rows = _counted(rows, ["_lane", "_g"], "_i", "_p", "_same")
    rows = _counted(rows.drop("_g"), ["_lane", "_bi"], "_i", "_bp", "_inside")
    rows = kept_table(rows, "reuse")

    cells = rows.where("_p is not null").groupBy("_lane", "_bi", "_bp").agg(F.count("*").alias("_n"))
    by_column = Window.partitionBy("_lane", "_bp").orderBy("_bi").rowsBetween(Window.unboundedPreceding, -1)
    by_row = Window.partitionBy("_lane", "_bi").orderBy("_bp").rowsBetween(Window.unboundedPreceding, -1)
    # Every block of i needs the counts of every block of p before it, also where it has no rows of its own.
    columns = cells.groupBy("_lane").agg(F.max("_bi").alias("_last"))
    grid = columns.select(
        "_lane", F.explode(F.sequence(F.lit(0).cast("bigint"), "_last")).alias("_bi"), "_last"
    ).select("_lane", "_bi", F.explode(F.sequence(F.lit(0).cast("bigint"), "_bi")).alias("_bp"))
    grid = grid.join(cells, ["_lane", "_bi", "_bp"], "left")
    earlier = grid.withColumn("_up", F.coalesce(F.sum("_n").over(by_column), F.lit(0)))
    across = earlier.withColumn("_across", F.coalesce(F.sum("_up").over(by_row), F.lit(0)))
    across = across.where("_n is not null").select("_lane", "_bi", "_bp", "_across")
    joined = rows.join(across, ["_lane", "_bi", "_bp"], "left")
    distance = F.col("_first") + F.col("_same") + F.col("_inside") + F.col("_across") - (F.col("_p") + 1)
    return joined.select(*kept, F.coalesce(distance < max_rows, F.lit(False)).alias("hit"))


def calls_made(requests: DataFrame, empty: Column, cache_missing_key: bool) -> Column:
    """Calls for a (request, n_rows) table: one per request, or one per row of an uncached empty answer."""
    return F.lit(1) if cache_missing_key else F.when(empty, F.col("n_rows")).otherwise(F.lit(1))


def split_by_store(requests: DataFrame, store: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(answers found in the store, requests still to be sent). Both sides are unique by request_id."""
    known = store.join(requests.select("request_id"), "request_id", "left_semi")
    missing = requests.join(store.select("request_id"), "request_id", "left_anti")
    return known, missing


def is_storable(empty: Column, cache_missing_key: bool = True) -> Column:
    """Whether a response is worth keeping for the next run."""
    return F.lit(True) if cache_missing_key else ~empty


def storable(responses: DataFrame, empty: Column, cache_missing_key: bool = True) -> DataFrame:
    """Responses worth keeping for the next run."""
    return responses.where(is_storable(empty, cache_missing_key))

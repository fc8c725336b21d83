"""Links between items that share a bucket, and connected components of links, at any skew.

Items that share a bucket are candidates; ``near`` decides. What is wanted is connectivity, so only
a spanning forest of the links of a bucket is written, and only pairs that are not yet known to be
connected are looked at: no pairs of a group are ever listed.

First every bucket is held against one of its items, its leader, which settles a group of near
copies in one pass, and the components of these links are found. Buckets whose items now all lie in
one component are done. In the others items of different components are compared: a bucket of up to
``block`` items as one piece of work, a larger one in blocks, where the items connected to the leader
need no comparison with each other. So every pair of a bucket is compared or known to be connected,
whatever the bucket's size, and no task holds more than two blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from restframe.llm.base import keep, returns_memory

#: Items of a bucket that are compared in one piece of work.
BLOCK = 1024
#: Pairs of one item that are decided before what they connect is taken into account.
ASKED = 64


class Near(Protocol):
    """Decides which items are linked; sent to the workers."""

    def items(self, batch: pa.RecordBatch):
        """The items of a batch in the form the other methods take."""

    def to_many(self, items, one: int, many: np.ndarray) -> np.ndarray:
        """For each of ``many`` positions whether it is linked to position ``one``."""


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """The runs of rows with equal keys of a sorted partition; a run may go over several batches."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        if held:
            same = all(held[-1].column(k)[-1].as_py() == batch.column(k)[0].as_py() for k in keys)
            if not same:
                yield _one(held)
                held = []
        change = np.zeros(batch.num_rows - 1, bool)
        for k in keys:
            values = batch.column(k).to_numpy(zero_copy_only=False)
            change |= values[1:] != values[:-1]
        starts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for a, b in zip(starts, starts[1:], strict=False):
            held.append(batch.slice(a, b - a))
            if b < batch.num_rows:
                yield _one(held)
                held = []
    if held:
        yield _one(held)


def _one(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def forest(
    left: np.ndarray,
    right: np.ndarray,
    linked: Callable[[int, np.ndarray], np.ndarray],
    group: np.ndarray | None = None,
) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links between two sets of positions (or within one, given twice).

    ``linked`` is asked, for a few positions at once, only about those that are not yet connected;
    positions with the same number in ``group`` are connected from the start.
    """
    size = int(max(left.max(initial=-1), right.max(initial=-1))) + 1
    group = np.arange(size) if group is None else np.unique(group, return_inverse=True)[1]
    edges, within = [], left is right
    for at, one in enumerate(left):
        many = right[at + 1 :] if within else right
        while True:
            many = many[group[many] != group[one]]
            if not len(many):
                break
            part, many = many[:ASKED], many[ASKED:]
            hit = part[linked(int(one), part)]
            if len(hit):
                names, first = np.unique(group[hit], return_index=True)
                edges += [(int(one), int(hit[i])) for i in first]
                group[np.isin(group, names)] = group[one]
    return edges


def _edge_batch(u: list[int], v: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])


def bucket_links(
    members: DataFrame, near: Near, payload: DataFrame | None = None, block: int = BLOCK, at_once: bool = False
) -> DataFrame:
    """A spanning forest (u, v) of the links between items that share a bucket.

    ``members`` has the columns bucket and id (both long), one row for each item of a bucket;
    ``payload`` has for each id once what ``near`` needs besides the id. Both are read several times.
    Repeated edges are possible. With ``at_once`` buckets of up to ``block`` items are compared in one
    piece of work from the start, many buckets together; that suits many small buckets, of which few lie
    in one component. ``near`` then also has ``weights`` and ``linked_pairs``.
    """
    cell_keys = ["bucket", "row", "col"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        u: list[int] = []
        v: list[int] = []
        for run in runs(batches, cell_keys):
            ids, side = run.column("id").to_numpy(), run.column("side").to_numpy()
            left = np.flatnonzero(side == 0)
            right = left if run.column("row")[0] == run.column("col")[0] else np.flatnonzero(side == 1)
            asked = partial(near.to_many, near.items(run))
            for a, b in forest(left, right, asked, run.column("known").to_numpy()):
                u.append(int(ids[a]))
                v.append(int(ids[b]))
            if len(u) >= 1 << 16:
                yield _edge_batch(u, v)
                u, v = [], []
        yield _edge_batch(u, v)

    places = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def compared(cells: DataFrame) -> DataFrame:
        """Cells: bucket, row, col, side, id, and known, the component so far."""
        loaded = cells.join(payload, "id") if payload is not None else cells
        return (
            loaded.repartition(places, *cell_keys)
            .sortWithinPartitions(*cell_keys, "side", "id")
            .mapInArrow(compare, "u long, v long")
        )

    def cell(row: Column, col: Column, side: Column) -> Column:
        return F.struct(row.cast("int").alias("row"), col.cast("int").alias("col"), side.cast("int").alias("side"))

    def spread(rows: DataFrame, cells: Column, known: Column) -> DataFrame:
        wide = rows.select("bucket", F.explode(cells).alias("cell"), "id", known.alias("known"))
        return wide.select("bucket", "cell.row", "cell.col", "cell.side", "id", "known")

    sizes = members.groupBy("bucket").agg(F.count("*").alias("n"), F.min("id").alias("lead")).where("n > 1")
    rows = keep(members.join(sizes, "bucket"), "members")
    nought = F.lit(0)
    done = None
    if at_once:
        small = rows.where(F.col("n") <= block)
        loaded = small.select("lead", "bucket", "id")
        loaded = loaded.join(payload, "id") if payload is not None else loaded
        # Buckets with one leader have most items in common, which are then prepared and compared once.
        loaded = loaded.repartition(places, "lead").sortWithinPartitions("lead", "bucket", "id")
        done = keep(loaded.mapInArrow(partial(_within_buckets, near), "u long, v long"), "small-buckets")
        rows = rows.where(F.col("n") > block)
        if rows.isEmpty():
            return done

    # The leader goes to every block of its bucket; row and col differ, so sides are compared.
    parts = F.ceil(F.col("n") / block)
    is_lead = F.col("id") == F.col("lead")
    blocks = F.transform(F.sequence(F.lit(1), parts), lambda i: cell(nought, i, nought))
    mine = F.array(cell(nought, F.pmod(F.xxhash64("id"), parts) + 1, F.lit(1)))
    first = keep(compared(spread(rows, F.when(is_lead, blocks).otherwise(mine), F.col("id"))), "leaders")

    known = components(first)
    label = F.coalesce("component", "id")
    rows = rows.join(known, "id", "left").select("bucket", "id", "lead", label.alias("label"))
    open_ = (
        rows.groupBy("bucket")
        .agg(F.min("label").alias("low"), F.max("label").alias("high"), F.max(F.when(is_lead, F.col("label"))).alias("main"))
        .where("low <> high")
        .select("bucket", "main")
    )
    rows = keep(rows.join(open_, "bucket").select("bucket", "id", "label", (F.col("label") == F.col("main")).alias("hit")), "open")
    split = rows.groupBy("bucket").agg(F.count_if("hit").alias("n_hit"), F.count_if(~F.col("hit")).alias("n_rest")).select(
        "bucket",
        (F.col("n_hit") + F.col("n_rest") <= block).alias("small"),
        F.ceil(F.col("n_hit") / block).cast("int").alias("hit_blocks"),
        F.ceil(F.col("n_rest") / block).cast("int").alias("rest_blocks"),
    )
    number = F.when(F.col("hit"), F.col("hit_blocks")).otherwise(F.col("rest_blocks"))
    numbered = rows.join(split, "bucket").withColumn("own", F.pmod(F.xxhash64("id"), number).cast("int"))
    own, rest = F.col("own"), F.sequence(nought, F.col("rest_blocks") - 1)
    to_rest = F.transform(rest, lambda i: cell(F.least(i, own), F.greatest(i, own), own > i))
    to_hit = F.transform(F.sequence(nought, F.col("hit_blocks") - 1), lambda j: cell(own, -1 - j, nought))
    from_hit = F.transform(rest, lambda i: cell(i, -1 - own, F.lit(1)))
    cells = (
        F.when(F.col("small"), F.array(cell(nought, nought, nought)))
        .when(F.col("hit"), from_hit)
        .otherwise(F.concat(to_rest, to_hit))
    )
    links = first.unionByName(compared(spread(numbered, cells, F.col("label"))))
    return links if done is None else links.unionByName(done)


@returns_memory
def _within_buckets(near: Near, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links that connect what is linked within each small bucket, the pairs of many buckets decided together."""
    for some, starts in _whole_buckets(near, batches):
        ids = some.column("id").to_numpy()
        different, first, item = np.unique(ids, return_index=True, return_inverse=True)
        decide = near.linked_pairs(some.take(pa.array(first))) if len(starts) > 1 else None
        sizes = np.diff([*starts, len(ids)])
        u: list[np.ndarray] = []
        v: list[np.ndarray] = []
        if decide is not None:
            left, right = _stepped(sizes, decide, item)
            u.append(different[left])
            v.append(different[right])
        for start, size in zip(starts.tolist(), sizes.tolist(), strict=True) if decide is None else ():
            own = np.arange(size)
            asked = partial(near.to_many, near.items(some.slice(start, size)))
            edges = [(a + start, b + start) for a, b in forest(own, own, asked)] if size > 1 else []
            u.append(ids[[a for a, _ in edges]] if edges else ids[:0])
            v.append(ids[[b for _, b in edges]] if edges else ids[:0])
        if u:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(u)), pa.array(np.concatenate(v))], ["u", "v"])


def _stepped(
    sizes: np.ndarray, decide: Callable[[np.ndarray, np.ndarray], np.ndarray], item: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs that connect all that is linked within runs of these sizes.

    ``item`` numbers what is at each position, from 0, so that several runs may hold the same; without it
    every position is an item of its own. Items are held against the next of their run, the one after it and
    so on, all runs at once; pairs that are known to be connected, or have been asked about, are not asked about.
    """
    last = np.repeat(np.cumsum(sizes), sizes)
    active, step = np.arange(len(last)), 1
    item = active if item is None else item
    label = np.arange(int(item.max(initial=-1)) + 1)
    refused = item[:0]
    us, vs = [item[:0]], [item[:0]]
    while True:
        active = active[active + step < last[active]]
        if not len(active):
            return np.concatenate(us), np.concatenate(vs)
        one, other = item[active], item[active + step]
        open_ = label[one] != label[other]
        if open_.any():
            one, other = one[open_], other[open_]
            pairs = np.unique(np.minimum(one, other) * len(label) + np.maximum(one, other))
            if len(refused):
                pairs = pairs[refused[np.minimum(np.searchsorted(refused, pairs), len(refused) - 1)] != pairs]
            one, other = np.divmod(pairs, len(label))
            linked = decide(one, other) if len(pairs) else np.zeros(0, bool)
            refused = np.sort(np.concatenate([refused, pairs[~linked]]))
            us.append(one[linked])
            vs.append(other[linked])
            low, high = label[one[linked]], label[other[linked]]
            label = label.copy()
            np.minimum.at(label, np.maximum(low, high), np.minimum(low, high))
            while (label[label] != label).any():
                label = label[label]
        step += 1


#: Weight of the items compared together.
TOGETHER = 1 << 18


def _whole_buckets(near: Near, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Rows of whole buckets and where each begins, up to about ``TOGETHER`` in weight; a heavier bucket comes alone."""
    held: list[pa.RecordBatch] = []
    weight = 0
    for batch in batches:
        # A batch may be cut anywhere; only its last bucket can go on.
        for start in range(0, batch.num_rows, 2048):
            part = batch.slice(start, 2048)
            if held and weight >= TOGETHER:
                whole = _one(held)
                bucket = whole.column("bucket").to_numpy()
                last = int(np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))[-1])
                if last:
                    yield from _by_weight(near, whole.slice(0, last))
                    held = [whole.slice(last)]
                    weight = int(near.weights(held[0]).sum())
            held.append(part)
            weight += int(near.weights(part).sum())
    if held:
        yield from _by_weight(near, _one(held))


def _by_weight(near: Near, whole: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    bucket = whole.column("bucket").to_numpy()
    if not len(bucket):
        return
    starts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    weights = np.add.reduceat(near.weights(whole), starts)
    bounds = np.append(starts, len(bucket))
    at = 0
    while at < len(starts):
        upto = at + max(1, int(np.searchsorted(np.cumsum(weights[at:]), TOGETHER, side="right")))
        yield whole.slice(bounds[at], bounds[upto] - bounds[at]), starts[at:upto] - bounds[at]
        at = upto


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(id, component) for every node of ``edges`` (u, v long): the smallest id reachable.

    Large-star and small-star steps by turns: each hangs the neighbours of a node under the smallest
    of them, until every component is a star. Each round is written to the shared folder, which cuts
    the lineage. Nodes without an edge to another node are not in the result.
    """
    now = keep(_down(edges), "edges")
    last = None
    for _ in range(max_rounds):
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == last or not state[0]:
            return _stars(now)
        last = state
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = _down(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = keep(_down(small.unionByName(low.select("u", F.col("m").alias("v")))), "edges")
    raise RuntimeError("components did not settle")


def _down(edges: DataFrame) -> DataFrame:
    """Each edge once, from the larger id to the smaller; no loops."""
    return edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _stars(edges: DataFrame) -> DataFrame:
    roots = edges.select(F.col("v").alias("id")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        roots.select("id", F.col("id").alias("component"))
    )

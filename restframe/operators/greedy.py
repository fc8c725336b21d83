"""Greedy chains: marks in an ordered stream, each a set distance after the one before.

A mark is the first row whose ``hi`` lies more than ``reach`` beyond the ``lo`` of the
previous mark, or that comes ``max_rows`` rows after it. Expiry after write (``lo`` = ``hi`` =
time) and flushes by size (``lo``/``hi`` = running total before and after the row) are both of
this kind. What happens in one block depends on the mark before it, so a block first works out its
*chain*: for each row that could be its first mark, what its last mark would then be. That is a
function from the mark in force before the block to the mark in force after it, and functions of
neighbouring blocks compose to one of the same form. They are composed in a tree: blocks that agree
in the leading bits of their position become one, level by level, until a lane has one left. Then the
tree is walked down: a node that knows its entry tells its children theirs, and at last every block,
knowing its entry, sets its marks. A task holds one block, or one chain while it reads the
4,096 or fewer below it, however long the lane is. A lane with so few rows that one task can go
through it needs none of this: its marks are set from its first row on, as the rows stream by.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from restframe.session import keep as kept_table

#: Bits of a block's position that one level of the tree takes off, which bounds the children of a node.
FAN_BITS = 12

#: Bytes of marked rows that are handed on at once.
MARKED_BYTES = 8 << 20

_NONE_YET = np.iinfo(np.int64).min


def group_bounds(groups: pd.DataFrame) -> list[tuple[int, int]]:
    """(start, end) of every stretch of equal rows."""
    changed = (groups != groups.shift()).any(axis=1).to_numpy()
    starts = np.flatnonzero(changed)
    return list(zip(starts, np.append(starts[1:], len(groups)), strict=True))


def block_code(block: str, kind: T.DataType) -> Column:
    """The position of a block as a whole number that grows as the block does."""
    if isinstance(kind, T.IntegralType):
        return F.col(block).cast("bigint")
    if isinstance(kind, T.DateType):
        return F.unix_date(block).cast("bigint")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(block).cast("timestamp"))
    raise ValueError(f"the blocks of a lane are whole numbers, dates or times, not {kind.simpleString()}")


def last_in_chain(follow: np.ndarray) -> np.ndarray:
    """Where the chain i -> follow[i] -> ... ends before it leaves the array, by pointer doubling."""
    n = len(follow)
    jump = np.append(np.minimum(follow, n), n)
    last = np.arange(n + 1)
    while (jump[:n] < n).any():
        inside = jump < n
        last[inside] = last[jump[inside]]
        jump = jump[jump]
    return last[:n]


class Chain:
    """The mark in force after some blocks, as a function of the one in force before them.

    ``his`` and ``ats`` are the rows an entry can reach, ``los`` and ``last`` the mark in force at the
    end if that row is the first mark. ``whole``: an entry may reach beyond all rows, and then stays.
    """

    def __init__(self, reach: int, max_rows: int | None, first: tuple[int, int], whole: bool,
                 his: np.ndarray, ats: np.ndarray, los: np.ndarray, last: np.ndarray) -> None:
        self.reach, self.max_rows, self.first, self.whole = reach, max_rows, first, whole
        self.his, self.ats, self.los, self.last = his, ats, los, last

    def next_mark(self, lo, at):  # noqa: ANN001, ANN201 - numbers or arrays
        return next_mark(self.his, self.ats, lo, at, self.reach, self.max_rows)

    def after(self, lo: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The marks in force after the blocks, for marks in force before them."""
        first = self.next_mark(lo, at)
        inside = first < len(self.his)
        place = np.minimum(first, len(self.his) - 1)
        return np.where(inside, self.los[place], lo), np.where(inside, self.last[place], at)

    def then(self, other: Chain) -> Chain:
        """This one and the blocks behind it."""
        los, last = other.after(self.los, self.last)
        his, ats, whole = self.his, self.ats, self.whole
        if whole:
            his, ats = np.concatenate([his, other.his]), np.concatenate([ats, other.ats])
            los, last = np.concatenate([los, other.los]), np.concatenate([last, other.last])
            # No entry lies beyond the first row, which bounds what it reaches.
            reached = int(next_mark(his, ats, *self.first, self.reach, self.max_rows)) + 1
            whole = other.whole and reached > len(his)
            his, ats, los, last = his[:reached], ats[:reached], los[:reached], last[:reached]
        return Chain(self.reach, self.max_rows, self.first, whole, his, ats, los, last)


def next_mark(his, ats, lo, at, reach, max_rows):  # noqa: ANN001, ANN201
    """Index of the row that follows the given mark as a mark; takes arrays of marks too."""
    found = np.searchsorted(his, lo + reach, side="right")
    if max_rows is not None:
        found = np.minimum(found, np.searchsorted(ats, at + max_rows, side="left"))
    return found


def chain_of(values: np.ndarray, reach: int, max_rows: int | None) -> Chain:
    """The chain of one block from its rows (lo, hi, at)."""
    los, his, ats = values.T
    n = len(los)
    follow = np.maximum(next_mark(his, ats, los, ats, reach, max_rows), np.arange(1, n + 1))
    reached = int(next_mark(his, ats, los[0], ats[0], reach, max_rows)) + 1
    last = last_in_chain(follow)[:reached]
    first = (int(los[0]), int(ats[0]))
    return Chain(reach, max_rows, first, reached > n, his[:reached], ats[:reached], los[last], ats[last])


def greedy_marks(
    df: DataFrame,
    lane: Sequence[str],
    block: str,
    order: Sequence[str],
    lo: str,
    hi: str,
    reach: int,
    seq: str | None = None,
    max_rows: int | None = None,
    keep: Sequence[str] = (),
    cut: Column | None = None,
) -> DataFrame:
    """(lane, block, order, keep) of every row with ``is_mark`` and ``mark_lo``, its mark's ``lo``.

    ``lane`` and ``block`` are never null and ``block``, a whole number, date or time, grows along the
    lane; ``lo`` <= ``hi`` are bigint and never fall along it. With ``max_rows``, ``seq`` numbers the
    rows of the lane and ``mark_seq`` is added. ``cut`` tells, by the columns of the lane, which lanes are cut
    into blocks (by default all); each other one goes through one task, in order, without being held there.
    The chains are written to the shared folder.
    """
    if (max_rows is None) != (seq is None):
        raise ValueError("max_rows and seq go together")
    group = [*lane, block]
    kept = [c for c in dict.fromkeys([*order, *keep]) if c not in group]
    rows = df.select(
        *group,
        *kept,
        F.col(lo).cast("bigint").alias("_lo"),
        F.col(hi).cast("bigint").alias("_hi"),
        (F.col(seq) if seq else F.lit(0)).cast("bigint").alias("_at"),
        F.lit(1).alias("_kind"),
        (F.lit(True) if cut is None else cut).alias("_cut"),
    )
    types = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    group_ddl = ", ".join(f"`{c}` {types[c]}" for c in group)

    chain_ddl = "_lo0 bigint, _at0 bigint, _whole boolean, his array<bigint>, ats array<bigint>, los array<bigint>, last array<bigint>"
    fields = ["_lo0", "_at0", "_whole", "his", "ats", "los", "last"]

    def record(chain: Chain) -> tuple:
        return *chain.first, chain.whole, chain.his, chain.ats, chain.los, chain.last

    def restored(row: tuple) -> Chain:
        arrays = [np.asarray(a, np.int64) for a in row[3:]]
        return Chain(reach, max_rows, (row[0], row[1]), bool(row[2]), *arrays)

    def chains(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Rows arrive sorted, so a block is complete when the next one begins.
        held_key: tuple | None = None
        held: list[np.ndarray] = []
        for pdf in batches:
            done = []
            values = pdf[["_lo", "_hi", "_at"]].to_numpy(dtype=np.int64)
            keys = pdf[group]
            for start, end in group_bounds(keys):
                key = tuple(keys.iloc[start])
                if key != held_key and held:
                    done.append((*held_key, *record(chain_of(np.concatenate(held), reach, max_rows))))
                    held = []
                held_key = key
                held.append(values[start:end])
            yield pd.DataFrame(done, columns=[*group, *fields])
        if held:
            yield pd.DataFrame([(*held_key, *record(chain_of(np.concatenate(held), reach, max_rows)))], columns=[*group, *fields])

    lane_ddl = "".join(f"`{c}` {types[c]}, " for c in lane)
    node = [*lane, "_node"]
    per_block = (
        rows.where("_cut")
        .select(*dict.fromkeys([*group, *order, "_lo", "_hi", "_at"]))
        .repartition(*group)
        .sortWithinPartitions(*group, *order)
        .select(*group, "_lo", "_hi", "_at")
        .mapInPandas(chains, f"{group_ddl}, {chain_ddl}")
    )
    code = block_code(block, rows.schema[block].dataType)
    levels = [kept_table(per_block.withColumn("_node", code), "chains")]
    low, high, count = levels[0].agg(F.min("_node"), F.max("_node"), F.count("*")).first()
    if count:
        # Positions count from the first one.
        levels[0] = levels[0].withColumn("_node", F.col("_node") - F.lit(low))
        low, high = 0, high - low
    # As many blocks as one node may have need no bits to be told apart by.
    bits = FAN_BITS if count > 1 << FAN_BITS else 63

    def compose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Children arrive in order within their node.
        held_key: tuple | None = None
        held: Chain | None = None
        for pdf in batches:
            done = []
            for row in pdf[[*node, *fields]].itertuples(index=False):
                key, child = tuple(row[: len(node)]), restored(row[len(node) :])
                if key != held_key:
                    if held is not None:
                        done.append((*held_key, *record(held)))
                    held_key, held = key, child
                else:
                    held = held.then(child)
            yield pd.DataFrame(done, columns=[*node, *fields])
        if held is not None:
            yield pd.DataFrame([(*held_key, *record(held))], columns=[*node, *fields])

    def below(level: DataFrame) -> DataFrame:
        """A level with the node each chain belongs to, under the position of its own."""
        return level.withColumn("_child", F.col("_node")).withColumn("_node", F.shiftright("_node", bits))

    while low is not None and low != high:
        level = below(levels[-1]).repartition(*node).sortWithinPartitions(*node, "_child")
        levels.append(kept_table(level.mapInPandas(compose, f"{lane_ddl}_node bigint, {chain_ddl}"), "chains"))
        low, high = low >> bits, high >> bits

    def enter(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # The entry of a node comes before its children.
        lo = at = np.int64(_NONE_YET)
        for pdf in batches:
            entry_lo, entry_at, is_child = [], [], []
            for row in pdf[["_kind", *fields]].itertuples(index=False):
                if row[0] == 0:
                    lo, at = np.int64(row[1]), np.int64(row[2])
                is_child.append(row[0] == 1)
                entry_lo.append(lo)
                entry_at.append(at)
                if row[0] == 1:
                    lo, at = (v[()] for v in restored(row[1:]).after(lo, at))
            own = pdf[[*lane, "_child"]].rename(columns={"_child": "_node"}).assign(_lo0=entry_lo, _at0=entry_at)
            yield own[pd.Series(is_child, index=own.index, dtype=bool)]

    none_yet = F.lit(_NONE_YET).cast("bigint")
    entries = levels[-1].select(*node, none_yet.alias("_lo0"), none_yet.alias("_at0"))
    for level in levels[-2::-1]:
        told = below(level).withColumn("_kind", F.lit(1)).drop(*([block] if block not in lane else []))
        told = told.unionByName(entries.withColumn("_kind", F.lit(0)), allowMissingColumns=True)
        entries = (
            told.repartition(*node)
            .sortWithinPartitions(*node, "_kind", "_child")
            .mapInPandas(enter, f"{lane_ddl}_node bigint, _lo0 bigint, _at0 bigint")
        )
    entries = entries.select(*[F.col(c).alias(f"_of_{c}") for c in lane], F.col("_node").alias("_of"), "_lo0", "_at0")
    same = [F.col("_node") == F.col("_of"), *[F.col(c) == F.col(f"_of_{c}") for c in lane]]
    entered = levels[0].drop("_lo0", "_at0").join(entries, same).select(
        *group,
        F.col("_lo0").alias("_lo"),
        F.col("_at0").alias("_at"),
        F.lit(0).cast("bigint").alias("_hi"),
        F.lit(0).alias("_kind"),
        F.lit(True).alias("_cut"),
    )
    if cut is not None:
        # Nothing is in force before the first row of a lane.
        opened = rows.where("not _cut").select(*lane).distinct().select(*lane, none_yet.alias("_lo"), none_yet.alias("_at"))
        opened = opened.select("*", F.lit(0).cast("bigint").alias("_hi"), F.lit(0).alias("_kind"), F.lit(False).alias("_cut"))
        entered = entered.unionByName(opened, allowMissingColumns=True)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The entry row of a block comes before its rows; the state is the mark in force.
        mark_lo = mark_at = _NONE_YET
        for batch in batches:
            kinds, los, his, ats = (batch.column(c).to_numpy() for c in ("_kind", "_lo", "_hi", "_at"))
            is_mark = np.zeros(len(kinds), dtype=bool)
            mark_los, mark_ats = np.empty(len(kinds), np.int64), np.empty(len(kinds), np.int64)
            cuts = np.flatnonzero(kinds == 0)
            for start, end in zip([0, *(cuts + 1)], [*cuts, len(kinds)], strict=True):
                if start > 0:
                    mark_lo, mark_at = los[start - 1], ats[start - 1]
                at = start
                while at < end:
                    if mark_lo == _NONE_YET:
                        stop = at
                    else:
                        stop = at + int(next_mark(his[at:end], ats[at:end], mark_lo, mark_at, reach, max_rows))
                    mark_los[at:stop], mark_ats[at:stop] = mark_lo, mark_at
                    if stop < end:
                        mark_lo, mark_at = los[stop], ats[stop]
                        is_mark[stop], mark_los[stop], mark_ats[stop] = True, mark_lo, mark_at
                    at = stop + 1
            marked = pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in (*group, *kept)],
                    pa.array(is_mark),
                    pa.array(mark_los),
                    pa.array(mark_ats),
                ],
                names=[*group, *kept, "is_mark", "mark_lo", "mark_seq"],
            )
            # Filtering copies, so wide rows go on a few at a time.
            portion = max(1, MARKED_BYTES * len(kinds) // max(1, batch.nbytes))
            for start in range(0, len(kinds), portion):
                yield marked.slice(start, portion).filter(pa.array(kinds[start : start + portion] == 1))

    kept_ddl = "".join(f", `{c}` {types[c]}" for c in kept)
    # The rows of a lane that is not cut stay together.
    marked = (
        rows.unionByName(entered, allowMissingColumns=True)
        .withColumn("_own", F.when(F.col("_cut"), F.col(block)))
        .repartition(*lane, "_own")
        .sortWithinPartitions(*lane, "_own", "_kind", block, *order)
        .drop("_own", "_cut")
        .mapInArrow(mark, f"{group_ddl}{kept_ddl}, is_mark boolean, mark_lo bigint, mark_seq bigint")
    )
    return marked if seq else marked.drop("mark_seq")

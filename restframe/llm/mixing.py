"""Mixing sources to target weights by weighted fair queueing, in DataFrame operations only.

Every source gets a target number of words. Its documents are shuffled by a hash and laid out one
after the other, as often as repeats are allowed; a copy's *virtual finish time* is the number of
words of the source up to its end divided by the target. All copies of all sources are then put in
one global order of finish time, and the order is cut where the total budget is used up.

Both running sums (within a source, and over the global order) are taken in two levels: totals of a
few thousand ranges of the order, a running sum over these totals, and a window inside each range.
So a source that holds a third of all rows is spread over thousands of ranges.

All this is done on keys and sizes. What the mix takes of a source are the first of its documents in
the order of the shuffle, once for each repeat, so the rows themselves are held against the last one
taken of their source where they are: they are neither shuffled nor written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from restframe.llm.base import WORD, keep, query, table

#: Ranges of each order: hexadecimal digits of the shuffling hash, and as many of finish times.
RANGE_DIGITS = 3
RANGES = 16**RANGE_DIGITS
#: Sources whose last rows taken may be sent to all executors (some hundred bytes each); above, they are joined by a shuffle.
SENT_SOURCES = 100_000


def count_words(text: Column) -> Column:
    """The number of words of a text; 0 if it is null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: list[float], max_repeats: int) -> DataFrame:
    """Targets of sources: ``sizes`` has one row (source, source_size) for each.

    Sources by code point, null last, get the weights in turn. They share the total of all sizes by
    weight; a target above ``max_repeats`` times its source is cut to that, and what is left over is
    shared by weight again until no target is above. That fixed point is found at once: in ascending
    order of size / weight the sources that are cut come first, so the share of the first one that
    is not cut, after taking off those before it, is the share of a unit of weight.
    Returns source, source_size, source_no (from 1), weight, target.
    """
    whole = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.array(*[F.lit(float(w)) for w in weights])
    ranked = sizes.withColumn("source_no", F.row_number().over(by_name)).withColumn(
        "weight", F.element_at(turn, ((F.col("source_no") - 1) % len(weights) + 1).cast("int"))
    )
    cap = F.lit(max_repeats) * F.col("source_size")
    order = Window.orderBy(cap / F.col("weight"), "source_no")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(0, Window.unboundedFollowing)
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum(cap).over(before), F.lit(0))
    share = ranked.withColumn("share", left / F.sum("weight").over(onward)).withColumn("cap_share", cap / F.col("weight"))
    first = F.min_by(F.when(F.col("share") <= F.col("cap_share"), F.col("share")), F.struct(
        F.col("share") > F.col("cap_share"), "cap_share", "source_no"
    )).over(whole)
    return share.withColumn("target", F.least(cap.cast("double"), first * F.col("weight"))).select(
        "source", "source_size", "source_no", "weight", "target"
    )


def mix(
    rows: DataFrame,
    size: Column,
    source: str = "source",
    key: str = "doc_id",
    weights: tuple[float, ...] = (1, 2, 3),
    max_repeats: int = 3,
    seed: str = "mix",
) -> DataFrame:
    """How often the mix takes each row: columns row (the row as it came), size, source_size,
    source_no, weight, target and copies.

    The budget is the total of all sizes. The order of the shuffle is the MD5 of key and seed, ties
    by key (null last) and size; equal rows may change places, which changes no result. Null is a
    source of its own. A null size counts as 0; rows of size 0 cost nothing and are taken once where
    their place in the order comes before the cut. Reruns agree. An empty table gives an empty one.
    """
    name, whole_key = F.col(f"`{source}`"), F.col(f"`{key}`")
    spread = rows.select(
        F.struct("*").alias("row"),
        name.alias("source"),
        F.struct(whole_key.isNull().alias("none"), whole_key.alias("key")).alias("key"),
        F.coalesce(size, F.lit(0)).cast("long").alias("size"),
        F.md5(F.concat(F.coalesce(whole_key.cast("string"), F.lit("null")), F.lit(f":{seed}"))).alias("h"),
    )
    # The sizes cost a pass over the texts; what follows reads them several times.
    sized = keep(spread.drop("row").withColumn("range", F.substring("h", 1, RANGE_DIGITS)), "mix-sizes")
    ranges = sized.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    totals = ranges.groupBy("source").agg(F.sum("range_size").alias("source_size"))
    targets = source_targets(totals, list(weights), max_repeats)
    earlier = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranges.withColumn("start", F.coalesce(F.sum("range_size").over(earlier), F.lit(0)))
        .join(targets.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
        .select(
            F.col("source").alias("s"), F.col("range").alias("r"), "start", "source_size", "source_no", "weight", "target"
        )
    )
    inside = Window.partitionBy("source", "range").orderBy("h", "key", "size")
    placed = (
        sized.withColumn("within", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        .join(starts, F.col("source").eqNullSafe(F.col("s")) & (F.col("range") == F.col("r")))
        .withColumn("ends", F.col("start") + F.col("within"))
        .select("source", "key", "size", "h", "source_size", "source_no", "weight", "target", "ends")
    )
    placed = keep(placed, "mix-places")

    epochs = F.when(F.col("size") > 0, F.sequence(F.lit(0), F.lit(max_repeats - 1))).otherwise(F.array(F.lit(0)))
    items = placed.withColumn("epoch", F.explode(epochs)).withColumn("finish", _finish(F.col("epoch")))
    # Finish times have no upper end: x / (1 + x) brings them into [0, 1) and keeps their order.
    items = items.withColumn("part", F.floor(F.lit(RANGES) * F.col("finish") / (F.col("finish") + 1)))
    parts = items.groupBy("part").agg(F.sum("size").alias("part_size"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("before", F.coalesce(F.sum("part_size").over(earlier), F.lit(0)))
    budget = totals.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("budget"))
    # Only the range in which the budget runs out needs its items in order.
    last = parts.crossJoin(F.broadcast(budget)).where("before <= budget").orderBy(F.desc("part")).limit(1)
    last = last.select(F.col("part").alias("p"), "before", "budget")
    run = Window.partitionBy("part").orderBy(*_ORDER).rowsBetween(Window.unboundedPreceding, 0)
    cut = (
        items.join(F.broadcast(last), F.col("part") == F.col("p"))
        .withColumn("used", F.col("before") + F.sum("size").over(run))
        .where("used <= budget")
        .agg(F.max(F.struct(*_ORDER)).alias("cut"))
        .crossJoin(F.broadcast(last.select("p")))
    )
    taken = [
        F.when(
            (F.floor(F.lit(RANGES) * _finish(F.lit(e)) / (_finish(F.lit(e)) + 1)) < F.col("p"))
            | (F.struct(_finish(F.lit(e)).alias("finish"), "source_no", "h", "key", "size", F.lit(e).alias("epoch")) <= F.col("cut")),
            1,
        ).otherwise(0)
        for e in range(max_repeats)
    ]
    taken = [taken[0], *[F.when(F.col("size") > 0, t).otherwise(0) for t in taken[1:]]]
    about = ["source", "source_size", "source_no", "weight", "target"]
    # Equal places: of their rows so many are taken, of so many.
    places = (
        placed.crossJoin(F.broadcast(cut))
        .groupBy(*about, F.struct("h", "key", "size").alias("at"))
        .agg(F.count("*").alias("n"), *[F.sum(t).alias(f"taken_{e}") for e, t in enumerate(taken)])
    )
    lasts = places.groupBy(*about).agg(
        *[
            F.max(F.when(F.col(f"taken_{e}") > 0, F.struct("at", F.col(f"taken_{e}").alias("taken"), "n"))).alias(f"last_{e}")
            for e in range(max_repeats)
        ]
    )
    lasts = keep(lasts.withColumnRenamed("source", "s"), "mix-lasts")
    few = lasts.count() <= SENT_SOURCES
    at = F.struct("h", "key", "size")
    held = spread.join(F.broadcast(lasts) if few else lasts, F.col("source").eqNullSafe(F.col("s"))).withColumn("nth", F.lit(1))
    # Of rows with the same place some are taken and some are not: only these are numbered.
    parted = [F.col(f"last_{e}.taken") < F.col(f"last_{e}.n") for e in range(max_repeats)]
    if not lasts.where(_any(parted)).isEmpty():
        numbered = _any([p & (at == F.col(f"last_{e}.at")) for e, p in enumerate(parted)])
        same = Window.partitionBy("source_no", "h", "key", "size").orderBy(F.to_json("row"))
        held = held.where(~numbered).unionByName(held.where(numbered).withColumn("nth", F.row_number().over(same)))

    def is_taken(e: int) -> Column:
        last = F.col(f"last_{e}")
        before = (at < last["at"]) | ((at == last["at"]) & (F.col("nth") <= last["taken"]))
        return F.coalesce(before, F.lit(False)).cast("int")

    again = sum([is_taken(e) for e in range(1, max_repeats)], F.lit(0))
    copies = is_taken(0) + F.when(F.col("size") > 0, again).otherwise(0)
    return held.select(
        "row", "size", "source_size", "source_no", "weight", "target", copies.cast("int").alias("copies")
    )


def _any(conditions: list[Column]) -> Column:
    return F.greatest(F.lit(False), *[F.coalesce(c, F.lit(False)) for c in conditions])


_ORDER = ("finish", "source_no", "h", "key", "size", "epoch")


def _finish(epoch: Column) -> Column:
    """Words of the source up to the end of this copy, over the target; 0 where nothing is wanted."""
    place = epoch * F.col("source_size") + F.col("ends")
    return F.when(F.col("target") > 0, place / F.col("target")).otherwise(F.lit(0.0))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The documents the mix takes, each as often as it does, with the columns they came with."""
    plan = mix(docs, count_words(F.col("text")), **options).where("copies > 0")
    again = plan.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    return again.select("row.*")


SQL = r"""
with sized as (
  select doc_id, source,
         cast(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as bigint) as size,
         md5(coalesce(cast(doc_id as varchar), 'null') || ':mix') as h
  from documents),
totals as (select source, cast(sum(size) as bigint) as source_size from sized group by source),
ranked as (select *, row_number() over (order by source nulls last) as source_no from totals),
weighed as (select *, cast(1 + (source_no - 1) % 3 as double) as weight from ranked),
shared as (
  select *, 3 * source_size / weight as cap_share,
         (sum(source_size) over () - coalesce(sum(3 * source_size) over (
            order by 3 * source_size / weight, source_no rows between unbounded preceding and 1 preceding), 0))
         / sum(weight) over (order by 3 * source_size / weight, source_no
            rows between current row and unbounded following) as share
  from weighed),
unit as (select share as u from shared where share <= cap_share order by cap_share, source_no limit 1),
targets as (
  select source, source_size, source_no,
         least(cast(3 * source_size as double), (select u from unit) * weight) as target from shared),
placed as (
  select s.doc_id, s.size, s.h, t.source_size, t.source_no, t.target,
         sum(s.size) over (partition by t.source_no order by s.h, s.doc_id nulls last, s.size
                           rows between unbounded preceding and current row) as ends
  from sized s join targets t on s.source is not distinct from t.source),
items as (
  select *, case when target > 0 then (epoch * source_size + ends) / target else 0.0 end as finish
  from (select *, unnest(case when size > 0 then [0, 1, 2] else [0] end) as epoch from placed)),
run as (
  select *, sum(size) over (order by finish, source_no, h, doc_id nulls first, size, epoch
                            rows between unbounded preceding and current row) as used from items)
select doc_id, size, source_size, target,
       cast(sum(case when used <= (select sum(size) from sized) then size else 0 end) as bigint) as taken
from run group by source_no, h, doc_id, size, ends, source_size, target
"""


@query("op9_source_mix", SQL)
def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, mixed with weights 1, 2, 3 and at most three copies of each."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", count_words(F.col("text")).alias("size"))
    plan = mix(docs, F.col("size"))
    return plan.select(
        "row.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )

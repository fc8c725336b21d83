"""Order-dependent columns over lanes of any size, computed slice by slice.

A *lane* is an ordered stream of rows (a writer, a cache, a client). A *slice* is a stretch
of a lane: rows that agree on the leading columns of the ordering. Windows run inside one
(lane, slice), and what has to cross a slice border travels through a table with one row per
slice. A lane that holds a third of all rows is so spread over as many tasks as it has slices.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from restframe.operators.skew import hot_hashes


def time_slices(df: DataFrame, lane: Sequence[str], at: str, slice_of: str, hot_slice_of: str) -> Column:
    """Slices by time, as a number: ``slice_of`` long, or ``hot_slice_of`` in a hot lane."""
    wide, fine = (F.unix_seconds(F.date_trunc(unit, at).cast("timestamp")) for unit in (slice_of, hot_slice_of))
    if not lane:
        return fine
    return F.when(is_hot(df, lane), fine).otherwise(wide)


def is_hot(df: DataFrame, lane: Sequence[str]) -> Column:
    """Whether a row's lane holds more than 1/1000 of the rows of ``df``."""
    counts = df.groupBy(*lane).agg(F.count(F.lit(1)).alias("n"))
    # Without rows there is no total, and no lane is hot.
    return F.coalesce(F.array_contains(hot_hashes(counts, lane, "n"), F.xxhash64(*lane)), F.lit(False))


def with_group(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add ``_group``, the columns as one value that is never null.

    Null lanes and slices so match in a plain equality, and a window and a join over the
    groups share one shuffle.
    """
    return df.withColumn("_group", F.struct(*[F.col(c).alias(f"g{i}") for i, c in enumerate(columns)]))


def _lane_windows(lane: Sequence[str], slices: Sequence[str]) -> tuple[WindowSpec, WindowSpec]:
    """Over a table with one row per group: (all slices of the lane, the earlier ones)."""
    names = [F.col(f"_group.g{i}") for i in range(len(lane) + len(slices))]
    in_lane = Window.partitionBy(*names[: len(lane)]).orderBy(*names[len(lane) :])
    return in_lane, in_lane.rowsBetween(Window.unboundedPreceding, -1)


def running_totals(
    df: DataFrame,
    lane: Sequence[str],
    slices: Sequence[str],
    order: Sequence[str],
    weights: Mapping[str, Column],
) -> DataFrame:
    """For each name, the sum of its weight over the rows before this one in the lane."""
    weighted = with_group(df.withColumns({f"_w_{n}": weight for n, weight in weights.items()}), [*lane, *slices])
    sizes = weighted.groupBy("_group").agg(*[F.sum(f"_w_{n}").alias(f"_t_{n}") for n in weights])
    _, earlier = _lane_windows(lane, slices)
    offsets = sizes.select(
        "_group", *[F.coalesce(F.sum(f"_t_{n}").over(earlier), F.lit(0)).alias(f"_o_{n}") for n in weights]
    )
    inside = Window.partitionBy("_group").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = weighted.withColumns(
        {f"_l_{n}": F.coalesce(F.sum(f"_w_{n}").over(inside), F.lit(0)) for n in weights}
    )
    totals = local.join(offsets, "_group").withColumns({n: F.col(f"_o_{n}") + F.col(f"_l_{n}") for n in weights})
    return totals.drop("_group", *[f"_{kind}_{n}" for kind in "wlo" for n in weights])


def number_rows(
    df: DataFrame, lane: Sequence[str], slices: Sequence[str], order: Sequence[str], into: str = "seq"
) -> DataFrame:
    """0-based position of every row in its lane, ordered by slices, then ``order``."""
    return running_totals(df, lane, slices, order, {into: F.lit(1).cast("bigint")})


def last_value_before(
    df: DataFrame,
    lane: Sequence[str],
    slices: Sequence[str],
    order: Sequence[str],
    value: Column,
    into: str,
    inclusive: bool = False,
) -> DataFrame:
    """The latest non-null ``value`` before each row of its lane (or up to it, if inclusive)."""
    valued = with_group(df.withColumn("_value", value), [*lane, *slices])
    frame = Window.partitionBy("_group").orderBy(*order)
    local = F.last("_value", ignorenulls=True).over(
        frame.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    )
    closing = valued.groupBy("_group").agg(
        F.max_by("_value", F.when(F.col("_value").isNotNull(), F.struct(*order))).alias("_closing")
    )
    _, earlier = _lane_windows(lane, slices)
    carried = closing.select("_group", F.last("_closing", ignorenulls=True).over(earlier).alias("_carried"))
    joined = valued.withColumn("_local", local).join(carried, "_group")
    return joined.withColumn(into, F.coalesce("_local", "_carried")).drop("_group", "_local", "_carried", "_value")


def number_runs(
    df: DataFrame,
    lane: Sequence[str],
    slices: Sequence[str],
    order: Sequence[str],
    value: Column | str,
    seq: str = "seq",
    run: str = "run_seq",
    weights: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Add each row's position in its lane and the position at which its run began.

    A run is a maximal stretch of neighbouring rows with the same ``value``. With ``weights``, also for
    each name the sum of its weight over the rows before this one in the lane, from the same windows.

    Lanes and slices are moved as ``_group`` alone. If ``value`` is the name of a column and ``order`` and it are
    all that is used of the rows afterwards, the rows are shuffled once for both the borders and the result.
    """
    weights = weights or {}
    own = value if isinstance(value, str) else "_value"
    names = [*lane, *slices]
    folded = {c: F.col(f"_group.g{i}") for i, c in enumerate(names) if c not in {*order, own}}
    inside = Window.partitionBy("_group").orderBy(*order)
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    added = {} if isinstance(value, str) else {"_value": value}
    weighted = df.withColumns(added | {f"_w_{n}": weight for n, weight in weights.items()})
    local = (
        with_group(weighted, names)
        .drop(*folded)
        .withColumns({f"_l_{n}": F.coalesce(F.sum(f"_w_{n}").over(before), F.lit(0)) for n in weights})
        .withColumn("_rn", F.row_number().over(inside))
        .withColumn("_prev", F.lag(own).over(inside))
        .withColumn(
            "_change",
            F.when((F.col("_rn") > 1) & ~F.col(own).eqNullSafe(F.col("_prev")), F.col("_rn")),
        )
    )
    borders = local.groupBy("_group").agg(
        F.max("_rn").alias("_n"),
        F.min_by(own, "_rn").alias("_first"),
        F.max_by(own, "_rn").alias("_final"),
        F.max("_change").alias("_last_change"),
        *[F.sum(f"_w_{n}").alias(f"_t_{n}") for n in weights],
    )
    in_lane, earlier = _lane_windows(lane, slices)
    opens = (F.row_number().over(in_lane) == 1) | ~F.col("_first").eqNullSafe(F.lag("_final").over(in_lane))
    last_start = F.coalesce(
        F.col("_before") + F.col("_last_change") - 1, F.when(F.col("_opens"), F.col("_before"))
    )
    entry = F.when(F.col("_opens"), F.col("_before")).otherwise(
        F.last("_last_start", ignorenulls=True).over(earlier)
    )
    borders = (
        borders.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .withColumn("_opens", opens)
        .withColumn("_last_start", last_start)
        .select(
            "_group",
            "_before",
            entry.alias("_entry"),
            *[F.coalesce(F.sum(f"_t_{n}").over(earlier), F.lit(0)).alias(f"_o_{n}") for n in weights],
        )
    )
    last_change = F.last("_change", ignorenulls=True).over(inside)
    joined = local.withColumn("_at", last_change).join(borders, "_group")
    return (
        joined.withColumn(seq, F.col("_before") + F.col("_rn") - 1)
        .withColumn(run, F.coalesce(F.col("_before") + F.col("_at") - 1, F.col("_entry")))
        .withColumns({n: F.col(f"_o_{n}") + F.col(f"_l_{n}") for n in weights} | folded)
        .select(*[F.col(f"`{c}`") for c in dict.fromkeys([*df.columns, seq, run, *weights])])
    )

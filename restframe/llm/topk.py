"""Exact top-k by inner product: a KD-tree for each shard, searched best first.

The rows are dealt into shards of a bounded size. In a task a shard becomes a KD-tree: median splits
along the widest side, and for every node the tight bounding box of its points. The largest inner
product a query can have with a point of a box is a sum over the box's nearer corners, so nodes are
taken in the order of that bound and the rest is left out once it falls below the kth score found.
Every query first goes to one shard only; the kth score it finds there travels with it to the
others, so their boxes are held against it from the start. Queries travel in blocks, so neither a
shard nor a block grows with the tables.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from restframe.llm.base import keep, query, table
from restframe.llm.links import runs
from restframe.llm.vectors import usable_vectors

SHARD_ROWS = 8192
QUERY_ROWS = 2048
LEAF = 256
#: Products whose sums stay below this are exact in double precision, with room for the ranks of ids.
EXACT = 2.0**48


class Tree:
    """A KD-tree over the rows of a matrix."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF) -> None:
        self.order = np.arange(len(points))
        self.low: list[np.ndarray] = []
        self.high: list[np.ndarray] = []
        self.span: list[tuple[int, int]] = []
        self.children: list[tuple[int, int] | None] = []
        waiting = [(0, len(points), None)]
        while waiting:
            start, stop, parent = waiting.pop()
            own = points[self.order[start:stop]]
            low, high, node = own.min(axis=0), own.max(axis=0), len(self.span)
            self.low.append(low)
            self.high.append(high)
            self.span.append((start, stop))
            self.children.append(None)
            if parent is not None:
                self.children[parent] = (*(self.children[parent] or ()), node)
            if stop - start > leaf:
                side, middle = int(np.argmax(high - low)), (stop - start) // 2
                self.order[start:stop] = self.order[start:stop][np.argpartition(own[:, side], middle)]
                waiting += [(start, start + middle, node), (start + middle, stop, node)]

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """The largest inner product of each query with a point of each node's box."""
        up, down = np.maximum(queries, 0), np.minimum(queries, 0)
        return up @ np.array(self.high).T + down @ np.array(self.low).T


def search(points: np.ndarray, ids: np.ndarray, queries: np.ndarray, own: np.ndarray, least: np.ndarray, k: int):
    """(query, point, score) of each query's ``k`` best points, ties to the smaller id, never its own id.

    ``least`` is a score known to be reached by k points elsewhere (-inf: none); points below it are
    of no use. Queries at the same node are scored by one matrix product.
    """
    by_id = np.argsort(ids, kind="stable")
    points, ids = points[by_id], ids[by_id]
    largest = np.abs(points).max() * (np.abs(queries).max() if len(queries) else 0) * points.shape[1]
    kind = np.float64 if largest < EXACT else object
    points, queries = points.astype(kind), queries.astype(kind)
    if kind is object:  # integers of any size
        points, queries = np.vectorize(int, otypes=[object])(points), np.vectorize(int, otypes=[object])(queries)
        return _search_plain(points, ids, queries, own, least, k)
    tree, n = Tree(points), len(points)
    bounds = tree.bounds(queries)
    shift = np.int64(1 << max(1, int(n).bit_length()))
    # One number for score and id: a better score first, then the smaller id.
    lowest = np.iinfo(np.int64).min
    best = np.full((len(queries), k), lowest)
    frontier: dict[int, np.ndarray] = {0: np.arange(len(queries))}
    # A round takes each query to its next best node; open nodes of a query wait in ``opened``.
    opened = np.full(bounds.shape, -np.inf)
    while frontier:
        for node, who in frontier.items():
            if tree.children[node] is not None:
                for child in tree.children[node]:
                    opened[who, child] = bounds[who, child]
                continue
            a, b = tree.span[node]
            rows = tree.order[a:b]
            keys = (queries[who] @ points[rows].T).astype(np.int64) * shift - rows
            keys[ids[rows][None, :] == own[who][:, None]] = lowest
            best[who] = np.partition(np.concatenate([best[who], keys], axis=1), -k, axis=1)[:, -k:]
        kth = best.min(axis=1)
        # Keys are score * shift - rank with 0 <= rank < shift, so this division gives the score back.
        limit = np.maximum(least, np.where(kth == lowest, -np.inf, -((-kth) // shift)))
        for node, who in frontier.items():
            opened[who, node] = -np.inf
        following = opened.argmax(axis=1)
        bound = opened[np.arange(len(queries)), following]
        alive = np.flatnonzero((bound >= limit) & (bound > -np.inf))
        frontier = {}
        if len(alive):
            nodes = following[alive]
            sort = np.argsort(nodes, kind="stable")
            parts = np.split(alive[sort], np.flatnonzero(np.diff(nodes[sort])) + 1)
            frontier = {int(following[part[0]]): part for part in parts}
    who, _ = np.nonzero(best != lowest)
    found = best[best != lowest]
    score = -((-found) // shift)
    rank = score * shift - found
    use = score >= least[who]
    return who[use], ids[rank[use]], score[use]


def _search_plain(points, ids, queries, own, least, k):
    who, what, scores = [], [], []
    for q in range(len(queries)):
        made = sorted((-int(sum(queries[q] * points[i])), int(ids[i])) for i in range(len(ids)) if ids[i] != own[q])[:k]
        for score, i in made:
            who.append(q)
            what.append(i)
            scores.append(-score)
    return np.array(who, np.int64), np.array(what, np.int64), np.array(scores, np.int64)


def _packed(rows: DataFrame, scale: float) -> DataFrame:
    """(id, dim, vec): floor(scale * x) of every component, as bytes of doubles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [None if v is None else np.floor(scale * v).tobytes() for v in usable_vectors(batch.column("vec"))]
            size = pa.array([0 if v is None else len(v) // 8 for v in made], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("id"), size, pa.array(made, pa.binary())], ["id", "dim", "vec"])

    return rows.mapInArrow(run, "id long, dim int, vec binary").where("vec is not null and id is not null")


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    scale: float = 64.0,
    key: str = "vec_id",
    vector: str = "embedding",
    shard_rows: int = SHARD_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """query_id, rank (from 1), key, score: the ``k`` rows with the highest inner products of each query.

    ``is_query`` is a condition on the key, under the name ``id``. Components are floor(scale * x). Ties go to the smaller key; a query is never its own result.
    Vectors that are null, empty or hold a null or non-finite component, and rows without a key,
    take no part; vectors of different lengths do not meet; equal rows count once. Scores must fit a
    long. Other columns are left out. Fewer than ``k`` candidates give them all; none give no row.
    """
    rows = vectors.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{vector}`").alias("vec"))
    packed = keep(_packed(rows, scale).distinct(), "vectors")
    asked = packed.where(F.coalesce(is_query, F.lit(False)))
    shards = max(1, -(-packed.count() // shard_rows))
    blocks = max(1, -(-asked.count() // query_rows))
    home = F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int")
    block = F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(blocks)).cast("int")
    points = packed.select(
        home.alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(0).alias("side"), "*"
    ).withColumn("least", F.lit(None).cast("double"))
    asked = asked.withColumn("home", home).withColumn("block", block)

    first = asked.select(F.col("home").alias("shard"), "block", F.lit(1).alias("side"), "id", "dim", "vec")
    near = keep(_cells(points, first.withColumn("least", F.lit(None).cast("double")), k), "nearest")
    kth = near.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("least")).where(F.col("n") >= k)
    if shards > 1:
        away = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
        rest = (
            asked.select(away, "home", "block", F.lit(1).alias("side"), "id", "dim", "vec")
            .where("shard <> home")
            .join(kth.select(F.col("query_id").alias("id"), F.col("least").cast("double").alias("least")), "id", "left")
        )
        near = near.unionByName(_cells(points, rest.select(points.columns), k))
    order = Window.partitionBy("query_id", "dim").orderBy(F.desc("score"), F.asc("found"))
    ranked = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("found").alias(key), "score")


def _cells(points: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """Each block of queries against each shard it is sent to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in runs(batches, ["shard", "block", "dim"]):
            side = cell.column("side").to_numpy()
            cut = int(np.searchsorted(side, 1))
            if cut in (0, cell.num_rows):
                continue
            dim, ids = cell.column("dim")[0].as_py(), cell.column("id").to_numpy()
            matrix = np.frombuffer(b"".join(cell.column("vec").to_pylist()), np.float64).reshape(-1, dim)
            least = cell.column("least").to_numpy(zero_copy_only=False).astype(np.float64)[cut:]
            least = np.where(np.isnan(least), -np.inf, least)
            who, what, score = search(matrix[:cut], ids[:cut], matrix[cut:], ids[cut:], least, k)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[cut:][who]), pa.array(np.full(len(who), dim, np.int32)), pa.array(what), pa.array(score)],
                ["query_id", "dim", "found", "score"],
            )

    places = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        points.unionByName(asked)
        .repartition(places, "shard", "block")
        .sortWithinPartitions("shard", "block", "dim", "side")
        .mapInArrow(run, "query_id long, dim int, found long, score long")
    )


SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(64 * cast(x as double))) as x from embeddings
  where embedding is not null and vec_id is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
ranked as (
  select q.vec_id as query_id, c.vec_id, cast(list_dot_product(q.x, c.x) as bigint) as score,
         row_number() over (partition by q.vec_id order by list_dot_product(q.x, c.x) desc, c.vec_id) as rank
  from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 20 = 0)
select query_id, cast(rank as integer) as rank, vec_id, score from ranked where rank <= 20
"""


@query("op4_kd_top_k", SQL)
def op4_kd_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best rows for every row whose vec_id is divisible by 20."""
    return top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)

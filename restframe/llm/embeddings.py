"""Near-duplicate vectors by random-hyperplane sign hashing in several tables, with exact verification.

A vector's signature in a table is the signs of its products with a few random directions. Vectors
of one label with equal signatures share a bucket; every pair of a bucket is verified by its cosine.
Buckets larger than a block are compared block by block. The number of directions follows from the
number of vectors, so that buckets stay small, and the number of tables from the wanted recall at
the threshold. A pair that meets in several tables is counted in the first of them only; for the
components each piece of work writes a spanning forest, not its pairs. Equal vectors are one node.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from restframe.llm.base import keep, query, table
from restframe.llm.links import components, forest, runs
from restframe.llm.vectors import usable_vectors

LEAST_COSINE = 0.93
#: Chance that a pair exactly at the threshold shares a bucket in some table; higher above it.
RECALL = 0.9995
#: Different vectors a bucket of unrelated vectors should have at most, on average.
BUCKET = 64
BLOCK = 1024
SEED = 20


def table_shape(count: int, least: float = LEAST_COSINE, recall: float = RECALL) -> tuple[int, int]:
    """(bits of a signature, tables) for this many vectors that may meet."""
    bits = min(62, max(6, math.ceil(math.log2(max(1, count) / BUCKET))))
    same = (1 - math.acos(least) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log(1 - same)))


def directions(dim: int, bits: int, tables: int, seed: int = SEED) -> np.ndarray:
    return np.random.default_rng([seed, dim, bits, tables]).standard_normal((dim, bits * tables))


def signatures(unit: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """A row of one number per table for each row of ``unit``."""
    signs = unit @ directions(unit.shape[1], bits, tables) > 0
    return (signs.reshape(len(unit), tables, bits) * (1 << np.arange(bits, dtype=np.int64))).sum(axis=2)


def _unit(vector: np.ndarray) -> np.ndarray | None:
    """The direction of a vector; the zero vector has none."""
    largest = np.abs(vector).max()
    if largest == 0:
        return None
    scaled = vector / largest  # so that no square overflows
    return scaled / np.sqrt(scaled @ scaled)


def near_vectors(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    least: float = LEAST_COSINE,
    recall: float = RECALL,
    block: int = BLOCK,
) -> DataFrame:
    """One row for each row of ``vectors``: key, n_links, component_id, kept.

    Rows of one label are linked at a cosine of ``least`` or more; n_links counts the other rows
    linked directly, component_id is the smallest key reachable, kept says whether that is the row's
    own. Rows whose key or label is null, and vectors that are null, empty, zero or hold a null or
    non-finite component link with nothing; vectors of different lengths are not linked. Repeated
    rows are linked with each other. Other columns are left out.
    """

    def unify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = usable_vectors(batch.column("vec"))
            made = [None if v is None else _unit(v) for v in given]
            packed = [None if u is None else u.tobytes() for u in made]
            # Equal are vectors with equal components, not those of one direction.
            raw = [None if u is None else xxhash.xxh3_128_digest(v.tobytes()) for u, v in zip(made, given, strict=True)]
            size = pa.array([0 if v is None else len(v) for v in made], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*batch.select(["id", "label"]).columns, size, pa.array(raw, pa.binary()), pa.array(packed, pa.binary())],
                ["id", "label", "dim", "digest", "unit"],
            )

    rows = vectors.select(
        F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{label}`").alias("label"), F.col(f"`{vector}`").alias("vec")
    )
    kind = rows.schema["label"].dataType.simpleString()
    made = keep(rows.mapInArrow(unify, f"id long, label {kind}, dim int, digest binary, unit binary"), "vectors")
    usable = F.col("digest").isNotNull() & F.col("id").isNotNull() & F.col("label").isNotNull()
    nodes = made.where(usable).groupBy("label", "dim", "digest")
    nodes = keep(nodes.agg(F.min("id").alias("id"), F.count("*").alias("copies"), F.first("unit").alias("unit")), "nodes")

    # Only vectors of one label and length meet, so the largest such group sets the size of a bucket.
    groups = nodes.groupBy("label", "dim").agg(F.count("*").alias("n"))
    bits, tables = table_shape(groups.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0], least, recall)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            out = np.zeros((len(dims), tables), np.int64)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                unit = np.frombuffer(b"".join(batch.column("unit").take(pa.array(at)).to_pylist())).reshape(-1, dim)
                out[at] = signatures(unit, bits, tables)
            signs = pa.ListArray.from_arrays(np.arange(len(dims) + 1, dtype=np.int32) * tables, out.ravel())
            yield pa.RecordBatch.from_arrays([*batch.columns, signs], [*batch.schema.names, "signs"])

    signed = keep(
        nodes.mapInArrow(
            sign, f"label {kind}, dim int, digest binary, id long, copies long, unit binary, signs array<long>"
        ),
        "signatures",
    )
    narrow = signed.select("id", F.posexplode("signs").alias("tab", "sign"), "label", "dim")
    bucket = F.xxhash64("tab", "sign", "label", "dim")
    members = narrow.select("id", "tab", bucket.alias("bucket"))
    sizes = members.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    parts = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64("id"), parts).cast("int")
    cells = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda i: F.struct(
            F.least(i, F.col("own")).cast("int").alias("row"),
            F.greatest(i, F.col("own")).cast("int").alias("col"),
            (F.col("own") > i).cast("int").alias("side"),
        ),
    )
    work = (
        members.join(sizes, "bucket")
        .withColumn("parts", parts)
        .withColumn("own", own)
        .select("bucket", "tab", "id", F.explode(cells).alias("cell"))
        .select("bucket", "tab", "cell.row", "cell.col", "cell.side", "id")
        .join(signed.select("id", "label", "dim", "copies", "unit", "signs"), "id")
    )
    places = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The label and length are part of the order too: different ones never meet, whatever their hashes.
    cell_keys = ["bucket", "tab", "label", "dim", "row", "col"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[list[np.ndarray]] = [[], [], []]
        for run in runs(batches, cell_keys):
            for column, values in zip(out, _linked(run, least), strict=True):
                column.append(values)
            if sum(map(len, out[0])) >= 1 << 16:
                yield _triples(out)
                out = [[], [], []]
        yield _triples(out)

    found = keep(
        work.repartition(places, "bucket", "row", "col")
        .sortWithinPartitions(*cell_keys, "side", "id")
        .mapInArrow(compare, "u long, v long, links long"),
        "links",
    )
    counts = found.where("u = v").groupBy(F.col("u").alias("id")).agg(F.sum("links").alias("links"))
    linked = components(found.where("u <> v").select("u", "v"))
    node = (
        nodes.select("label", "dim", "digest", "id", "copies")
        .join(counts, "id", "left")
        .join(linked, "id", "left")
        .select(
            F.col("label").alias("l"),
            F.col("dim").alias("d"),
            F.col("digest").alias("g"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n"),
            F.coalesce("component", "id").alias("c"),
        )
    )
    same = (F.col("label") == F.col("l")) & (F.col("dim") == F.col("d")) & (F.col("digest") == F.col("g"))
    same &= F.col("id").isNotNull()
    return made.drop("unit").join(node, same, "left").select(
        F.col("id").alias(key),
        F.coalesce("n", F.lit(0)).alias("n_links"),
        F.coalesce("c", "id").alias("component_id"),
        F.col("id").eqNullSafe(F.coalesce("c", "id")).alias("kept"),
    )


def _linked(run: pa.RecordBatch, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a block, or of two: edges (u, v, 0) of a spanning forest, and (u, u, links) for newly met partners."""
    dim, tab = run.column("dim")[0].as_py(), run.column("tab")[0].as_py()
    ids, copies, side = (run.column(c).to_numpy() for c in ("id", "copies", "side"))
    unit = np.frombuffer(b"".join(run.column("unit").to_pylist())).reshape(-1, dim)
    one_block = run.column("row")[0] == run.column("col")[0]
    left = np.flatnonzero(side == 0)
    right = left if one_block else np.flatnonzero(side == 1)
    near = np.zeros((len(ids), len(ids)), bool)
    near[np.ix_(left, right)] = unit[left] @ unit[right].T >= least
    if one_block:
        np.fill_diagonal(near, False)
    a, b = np.nonzero(near)
    links = np.zeros(len(ids), np.int64)
    if len(a):
        signs = run.column("signs").flatten().to_numpy().reshape(len(ids), -1)[:, :tab]
        step = max(1, (1 << 24) // max(1, tab))
        for i in range(0, len(a), step):
            x, y = a[i : i + step], b[i : i + step]
            new = ~(signs[x] == signs[y]).any(axis=1)
            np.add.at(links, x[new], copies[y[new]])
            if not one_block:
                np.add.at(links, y[new], copies[x[new]])
    edges = forest(left, right, lambda one, many: near[one, many] | near[many, one]) if len(a) else []
    u, v = np.array(edges, np.int64).reshape(-1, 2).T
    counted = np.flatnonzero(links)
    return (
        np.concatenate([ids[u], ids[counted]]),
        np.concatenate([ids[v], ids[counted]]),
        np.concatenate([np.zeros(len(u), np.int64), links[counted]]),
    )


def _triples(out: list[list[np.ndarray]]) -> pa.RecordBatch:
    joined = [np.concatenate([np.empty(0, np.int64), *column]) for column in out]
    return pa.RecordBatch.from_arrays([pa.array(column) for column in joined], ["u", "v", "links"])


SQL = """
with recursive v as (
  select vec_id, label, list_transform(embedding, lambda x: cast(x as double)) as x from embeddings
  where embedding is not null and label is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs as (
  select a.vec_id as u, b.vec_id as v from v a join v b on a.label = b.label and a.vec_id <> b.vec_id
  where list_dot_product(a.x, b.x) / (sqrt(list_dot_product(a.x, a.x)) * sqrt(list_dot_product(b.x, b.x))) >= 0.93),
reach(u, v) as (select vec_id, vec_id from embeddings union select r.u, p.v from reach r join pairs p on p.u = r.v),
least as (select u, min(v) as component_id from reach group by u),
counts as (select u, count(*) as n from pairs group by u)
select e.vec_id, coalesce(c.n, 0) as n_links, l.component_id, e.vec_id = l.component_id as kept
from embeddings e join least l on l.u = e.vec_id left join counts c on c.u = e.vec_id
"""


@query("op5_hyperplane_dedup", SQL)
def op5_hyperplane_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors: links at a cosine of 0.93 within a label, components and what is kept of them."""
    return near_vectors(table(spark, sf_dir, "embeddings"))

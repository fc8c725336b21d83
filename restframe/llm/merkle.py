"""A Merkle manifest of a dataset: a content-addressed DAG, and proofs by descending it.

Rows become leaf digests. The leaves of a group, in the order of their keys, are hashed in runs of
``FANOUT`` until one node is left, the group's subroot; the subroots of all groups, in their order, are
hashed the same way to the root. What is stored are records digest -> children, one for each
different digest.

A proof is found from the root down. A request for a leaf knows its rank in the group; the digits of
the rank to the base FANOUT say which child to go to at every level. A step looks the record of the
current digest up, collects the children that are not taken and goes on with the one that is. At the
leaf the collected segments, turned round, are the proof from leaf to root. Requests with the same
digits so far stand at the same node and take their steps as one, so a level is a join of its nodes
with its records by digest, and the root is looked up once, not once for every leaf.

Ranks come from a range sort: a row's place in its partition, and how many rows of its group the
partitions before hold. So no group, however large, goes through one task. All of it is DataFrame
code; tables between the steps are written to the shared folder.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from restframe.llm.base import keep, query, table

#: Nodes hashed together.
FANOUT = 8
#: The columns of a leaf, in the order they are hashed.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_SEGMENT = "struct<left: string, right: string>"


def sized(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*map(sized, values)), 256)


def ranked(rows: DataFrame, group: list[str], order: list[str], label: str) -> DataFrame:
    """The rows, kept, with their rank (from 0) by ``order`` in their group, and size, the rows of the group.

    Groups may be null. Rows equal in group and order are ranked in any order; they are told apart
    by a number of their own, so that even a group of equal rows is spread over partitions.
    """
    places = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [F.col(f"`{c}`") for c in [*group, *order]] + [F.col("_tie")]
    spread = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(places, *by).sortWithinPartitions(*by)
    # The number holds the partition in its upper bits and the place in it in the others.
    at = F.monotonically_increasing_id()
    placed = spread.drop("_tie").withColumn("_at", at).withColumn("_part", F.shiftright("_at", 33))
    placed = keep(placed, label)
    runs = placed.groupBy(*group, "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    # One row for each group and partition it lies in.
    whole = Window.partitionBy(*group)
    runs = runs.withColumn("_before", F.sum("_n").over(whole.orderBy("_part")) - F.col("_n"))
    runs = runs.withColumn("size", F.sum("_n").over(whole))
    runs = runs.select(*[F.col(f"`{c}`").alias(f"_of_{c}") for c in group], F.col("_part").alias("_in"), "_first", "_before", "size")
    same = F.col("_part") == F.col("_in")
    for c in group:
        same = same & F.col(f"`{c}`").eqNullSafe(F.col(f"_of_{c}"))
    return placed.join(runs, same).select(
        *[F.col(f"`{c}`") for c in rows.columns], (F.col("_before") + F.col("_at") - F.col("_first")).alias("rank"), "size"
    )


def height_of(size: Column) -> Column:
    """How often the nodes of a level are hashed together until one is left."""
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(20)),
        F.struct(F.lit(0).alias("height"), size.cast("long").alias("left")),
        lambda a, _: F.when(a["left"] <= 1, a).otherwise(
            F.struct((a["height"] + 1).alias("height"), ((a["left"] + F.lit(FANOUT - 1)) / F.lit(FANOUT)).cast("long").alias("left"))
        ),
        lambda a: a["height"],
    )


@dataclass
class Forest:
    """Trees over ranked digests. ``records[k]`` holds the nodes k levels above the leaves."""

    records: dict[int, DataFrame]
    roots: DataFrame  # tree, height, digest


def build(nodes: DataFrame, label: str) -> Forest:
    """Hash (tree, rank, height, digest) up to the root of every tree."""
    level = nodes.select("tree", "rank", "height", "digest")
    most = level.agg(F.max("height")).first()[0] or 0
    roots = level.where("height = 0")
    records = {}
    for k in range(1, most + 1):
        run = level.where(F.col("height") >= k).groupBy("tree", "height", F.floor(F.col("rank") / FANOUT).alias("rank"))
        children = F.transform(F.sort_array(F.collect_list(F.struct("rank", "digest"))), lambda c: c["digest"])
        level = run.agg(children.alias("children")).withColumn("digest", F.sha2(F.array_join("children", ""), 256))
        level = records[k] = keep(level, f"{label}-{k}")
        roots = roots.unionByName(level.where(F.col("height") == k).select(roots.columns))
    return Forest(records, roots.select("tree", "height", "digest"))


def _unselected(children: Column, digit: Column) -> Column:
    left = F.array_join(F.slice(children, F.lit(1), digit), "")
    right = F.array_join(F.slice(children, digit + 2, F.lit(FANOUT)), "")
    return F.struct(left.alias("left"), right.alias("right"))


def _looked_up(frontier: DataFrame, records: DataFrame) -> DataFrame:
    """The frontier with the children of its digests. A digest is one record, however often it occurs."""
    store = records.groupBy(F.col("digest").alias("_digest")).agg(F.first("children").alias("children"))
    return frontier.join(store, F.col("digest") == F.col("_digest")).drop("_digest")


def _step(frontier: DataFrame, records: DataFrame) -> DataFrame:
    """From nodes (tree, height, rank, digest, path) to all their children."""
    at = _looked_up(frontier, records).select("*", F.posexplode("children").alias("digit", "child"))
    return at.select(
        "tree",
        "height",
        (F.col("rank") * FANOUT + F.col("digit")).alias("rank"),
        F.col("child").alias("digest"),
        F.array_append("path", _unselected(F.col("children"), F.col("digit"))).alias("path"),
    )


def descend(forest: Forest, starts: DataFrame, requests: DataFrame, whole: bool = False) -> DataFrame:
    """The requests (tree, rank, ...) with the digest and the path, root first, of their leaf.

    ``starts`` has (tree, height, digest, path) of every tree. A frontier holds the nodes of a level
    that have a request below them; with ``whole`` every leaf is requested and there is nothing to
    leave out. A request for a rank that is not there gives no row.
    """
    starts = starts.select("tree", "height", F.lit(0).cast("long").alias("rank"), "digest", "path")
    frontier = starts.where("false")
    for k in range(max(forest.records, default=0), 1, -1):
        frontier = _step(frontier.unionByName(starts.where(F.col("height") == k)), forest.records[k])
        if not whole:
            wanted = requests.select("tree", F.floor(F.col("rank") / FANOUT ** (k - 1)).alias("rank")).distinct()
            frontier = frontier.join(wanted, ["tree", "rank"], "left_semi")
    asked = requests.withColumn("_node", F.floor(F.col("rank") / FANOUT))
    single = starts.where("height = 0").select(F.col("tree").alias("_tree"), "digest", "path")
    found = asked.where("rank = 0").join(single, F.col("tree") == F.col("_tree")).drop("_tree", "_node")
    if forest.records:
        # The last step: the request meets its node, and its last digit picks the leaf.
        last = _looked_up(frontier.unionByName(starts.where("height = 1")), forest.records[1])
        last = last.select(F.col("tree").alias("_tree"), F.col("rank").alias("_at"), "children", F.col("path").alias("_path"))
        digit = (F.col("rank") % FANOUT).cast("int")
        met = asked.join(last, (F.col("tree") == F.col("_tree")) & (F.col("_node") == F.col("_at"))).where(digit < F.size("children"))
        met = met.withColumn("digest", F.element_at("children", digit + 1))
        met = met.withColumn("path", F.array_append("_path", _unselected(F.col("children"), digit)))
        found = found.unionByName(met.select(found.columns))
    return found


@dataclass
class Manifest:
    """``leaves``: tree, rank, height, digest, group and what was carried; ``groups``: tree, group, size, digest."""

    leaves: DataFrame
    groups: DataFrame
    trees: Forest
    top: Forest

    @property
    def root(self) -> str | None:
        """The digest of the whole dataset; None if it has no row."""
        row = self.top.roots.first()
        return row.digest if row else None

    def prove(self, requests: DataFrame | None = None) -> DataFrame:
        """Requests (tree, rank, ...) with leaf, subroot, root and proof, the segments from leaf to root.

        Without requests, those of all leaves, with the columns of ``leaves``.
        """
        whole = requests is None
        asked = self.leaves.drop("digest", "height") if whole else requests
        empty = F.array().cast(f"array<{_SEGMENT}>")
        top = self.top.roots.withColumn("path", empty)
        subroots = descend(self.top, top, self.groups.select(F.lit(0).alias("tree"), F.col("tree").alias("rank"), "height"), True)
        starts = subroots.select(F.col("rank").alias("tree"), "height", "digest", "path")
        found = descend(self.trees, starts, asked, whole).withColumnRenamed("digest", "leaf")
        ends = self.groups.select(F.col("tree").alias("_tree"), F.col("digest").alias("subroot"))
        found = found.join(ends, F.col("tree") == F.col("_tree")).drop("_tree")
        return found.withColumn("root", F.lit(self.root)).withColumn("proof", F.reverse("path")).drop("path")


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def proof_digest(proof: Column) -> Column:
    """The digest of all siblings, from leaf to root, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def manifest(
    docs: DataFrame,
    key: str = "doc_id",
    group: str = "lang",
    fields: tuple[str, ...] = FIELDS,
    carry: dict[str, Column] | None = None,
) -> Manifest:
    """The manifest of a table; ``carry`` are columns to be kept with the leaves.

    Leaves ascend by key, null first, in their group; equal keys by digest, so that the root
    depends on the rows alone. Repeated rows are leaves of their own. Groups ascend bytewise, null first
    and a group like any other. A null field is hashed as ``-``, an empty text as ``0:``. A group of
    one leaf has that leaf as its subroot; an empty table has no root. Columns that are neither
    field, key, group nor carried are not looked at.
    """
    carried = {f"carried_{name}": column for name, column in (carry or {}).items()}
    leaves = docs.select(
        F.col(f"`{group}`").alias("group"),
        F.col(f"`{key}`").alias("key"),
        leaf_digest(*[F.col(f"`{f}`") for f in fields]).alias("digest"),
        *[column.alias(name) for name, column in carried.items()],
    )
    # Texts are hashed once; the range sort reads its input twice.
    placed = ranked(keep(leaves, "leaves"), ["group"], ["key", "digest"], "leaf-places")
    sizes = placed.where("rank = 0").select("group", "size")
    trees = ranked(sizes.withColumn("all", F.lit(0)).withColumnRenamed("size", "n"), ["all"], ["group"], "groups")
    top_height = height_of(F.col("size")).alias("top_height")
    trees = keep(trees.select("group", F.col("rank").alias("tree"), F.col("n").alias("size"), height_of(F.col("n")).alias("height"), top_height), "trees")
    numbers = trees.select(F.col("group").alias("_group"), "tree", "height")
    placed = placed.join(numbers, F.col("group").eqNullSafe(F.col("_group"))).drop("_group", "size")
    placed = keep(placed, "ranked-leaves")
    forest = build(placed, "nodes")
    ends = forest.roots.select(F.col("tree").alias("_tree"), "digest")
    groups = keep(trees.join(ends, F.col("tree") == F.col("_tree")).drop("_tree"), "subroots")
    top = build(groups.select(F.lit(0).alias("tree"), F.col("tree").alias("rank"), F.col("top_height").alias("height"), "digest"), "top")
    return Manifest(placed, groups.select("tree", "group", "size", "height", "digest"), forest, top)


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _sql() -> str:
    """The same in DuckDB's SQL, level by level; eight levels hold 16 million rows of a group."""

    def up(name: str, k: int) -> str:
        return f"""
{name}{k} as (
  select tree, rank // 8 as rank, case when n = 1 then min(digest) else sha256(string_agg(digest, '' order by rank)) end as digest,
         (n + 7) // 8 as n
  from {name}{k - 1} group by tree, rank // 8, n)"""

    def siblings(name: str, levels: int) -> str:
        return ",".join(
            f"""
{name}s{k} as (
  select a.tree, a.rank, coalesce(string_agg(b.digest, '' order by b.rank) filter (b.rank < a.rank), '') as l,
         coalesce(string_agg(b.digest, '' order by b.rank) filter (b.rank > a.rank), '') as r, a.n > 1 as on_path
  from {name}{k} a join {name}{k} b on a.tree = b.tree and a.rank // 8 = b.rank // 8 group by a.tree, a.rank, a.n)"""
            for k in range(levels)
        )

    parts = ["doc_id", "source", "lang", "n_chars"]
    texts = [f"coalesce(strlen(cast({c} as varchar)) || ':' || cast({c} as varchar), '-')" for c in parts]

    def leaf(text: str) -> str:
        return f"sha256({' || '.join(texts)} || coalesce(strlen({text}) || ':' || {text}, '-'))"

    crc = (
        "xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(1, len(s) + 1), lambda i: ascii(s[i])::bigint)), "
        "lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, y: xor(x >> 1, 3988292384::bigint * (x & 1)))), "
        "4294967295::bigint)"
    )
    levels, top = 8, 4
    fold_d = "leaves"
    steps = []
    for name, n in (("d", levels), ("t", top)):
        for k in range(n):
            key = "f.tree" if name == "d" else "0"
            rank = "f.rank" if name == "d" else "f.tree"
            now = f"f_{name}{k}"
            steps.append(f"""
{now} as (
  select f.* exclude (node, proof),
         case when s.on_path then sha256(s.l || f.node || s.r) else f.node end as node,
         case when s.on_path then f.proof || s.l || s.r else f.proof end as proof
  from {fold_d} f join {name}s{k} s on s.tree = {key} and s.rank = {rank} // {8**k})""")
            fold_d = now
    return f"""
with hashed as (
  select doc_id, lang, {leaf("text")} as leaf, {leaf(f"translate(text, '{_UPPER}', '{_LOWER}')")} as other,
         cast(doc_id as varchar) as s from documents),
checked as (select *, {crc} % 3 = 0 as hit from hashed),
groups as (select lang, row_number() over (order by lang nulls first) - 1 as tree, n
           from (select lang, count(*) as n from documents group by lang)),
leaves as (
  select c.doc_id, c.leaf, g.tree, g.n, row_number() over (partition by g.tree order by c.doc_id nulls first, c.leaf) - 1 as rank,
         case when c.hit then c.other else c.leaf end as node, '' as proof
  from checked c join groups g on c.lang is not distinct from g.lang),
d0 as (select tree, rank, leaf as digest, n from leaves),{",".join(up("d", k) for k in range(1, levels + 1))},{siblings("d", levels)},
t0 as (select 0 as tree, tree as rank, digest, (select count(*) from groups) as n from d{levels}),{",".join(up("t", k) for k in range(1, top + 1))},{siblings("t", top)},{",".join(steps)}
select f.doc_id, f.leaf, b.digest as subroot, r.digest as root, sha256(f.proof) as proof_sha256,
       f.node as folded_root, f.node = r.digest as verified
from {fold_d} f join d{levels} b on b.tree = f.tree cross join t{top} r
"""


@query("op13_merkle_manifest", _sql())
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its proof; a third of them with their text in lower case, which the proof shows."""
    docs = table(spark, sf_dir, "documents")
    other = [F.translate("text", _UPPER, _LOWER) if f == "text" else F.col(f) for f in FIELDS]
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))
    proved = manifest(docs, carry={"other": F.when(hit, leaf_digest(*other))}).prove()
    proved = proved.withColumn("folded_root", folded(F.coalesce("carried_other", "leaf"), F.col("proof")))
    return proved.select(
        F.col("key").alias("doc_id"), "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )

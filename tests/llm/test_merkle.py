"""The manifest against a tree built in plain Python."""

import zlib
from collections import Counter
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from restframe.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rank string, digest int, tree int, leaf int, path int"


def digest(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def sized(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row, text):
    return digest(*map(sized, (row[0], row[3], row[2], row[4], text)))


def levels_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([digest(*below[i : i + 8]) for i in range(0, len(below), 8)])
    return levels


def path_of(levels, rank):
    """(left, right) siblings of a leaf, from the bottom."""
    found = []
    for below in levels[:-1]:
        start = rank // 8 * 8
        found.append((below[start:rank], below[rank + 1 : start + 8]))
        rank //= 8
    return found


def brute(rows):
    null_first = lambda v: (v is not None, v)
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda r: (null_first(r[0]) if r[0] is not None else (False, 0), leaf(r, r[1])))
        trees[g] = levels_of([leaf(r, r[1]) for r in groups[g]])
    top = levels_of([trees[g][-1][0] for g in names])
    out = []
    for t, g in enumerate(names):
        for rank, row in enumerate(groups[g]):
            path = path_of(trees[g], rank) + path_of(top, t)
            text = row[1]
            if text is not None and row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0:
                text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
            node = leaf(row, text)
            for left, right in path:
                node = digest(*left, node, *right)
            proof = digest(*(d for left, right in path for d in left + right))
            out.append((row[0], leaf(row, row[1]), trees[g][-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return Counter(out)


def some_rows(n=700):
    langs = ["en"] * 6 + ["de", "fr", None, "￿", "\U0001f600", "lone"]
    rows = []
    for i in range(n):
        lang = langs[i % 12] if i % 12 < 11 or i == 11 else "en"
        rows.append((i * 7 % 997 - 50, None if i % 50 == 3 else f"Text {i % 90} ÄÖ Über\n" * (i % 4), lang, f"s{i % 3}" if i % 5 else None, i if i % 7 else None))
    rows += [rows[5]] * 30 + [(None, "Null Key", "en", None, None), (None, None, None, None, None), (3, "", "", "", 0)]
    rows += [(i, "same", f"g{i}", "x", 1) for i in range(80)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "r", 1, 2, 3, 4) for r in rows], SCHEMA)


def query_of(spark, tmp_path, rows):
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    return merkle.op13_merkle_manifest(spark, str(tmp_path))


@pytest.mark.parametrize("rows", [
    some_rows(), some_rows()[:1], some_rows()[:8], some_rows()[:9], [(4, "ABC", "en", "s", 3)] * 65, [(i, "A", "en", "s", 1) for i in range(64)],
], ids=["many", "one", "eight", "nine", "equal", "full"])
def test_query_against_brute_force(spark, tmp_path, rows):
    got = Counter(tuple(r) for r in query_of(spark, tmp_path, rows).collect())
    assert got == brute(rows)


def test_empty(spark, tmp_path):
    out = query_of(spark, tmp_path, [])
    assert out.collect() == [] and dict(out.dtypes)["verified"] == "boolean"
    assert merkle.manifest(frame(spark, [])).root is None


def test_some_requests_and_records(spark):
    rows = some_rows()
    made = merkle.manifest(frame(spark, rows))
    every = {(r.tree, r.rank): (r.leaf, r.proof, r.root, r.subroot) for r in made.prove().collect()}
    assert len(every) == len(rows)
    asked = [(t, r) for t, r in sorted(every) if (t + r) % 11 == 0] + [(0, 10**6), (999, 0)]
    got = made.prove(spark.createDataFrame([(*a, "note") for a in asked], "tree long, rank long, note string")).collect()
    assert {(r.tree, r.rank): (r.leaf, r.proof, r.root, r.subroot) for r in got} == {a: every[a] for a in asked[:-2]}
    assert {r.note for r in got} == {"note"}
    # Content-addressed: every record's digest is that of its children.
    for records in [*made.trees.records.values(), *made.top.records.values()]:
        assert records.where(F.sha2(F.array_join("children", ""), 256) != F.col("digest")).isEmpty()
        assert records.where(F.size("children") > 8).isEmpty()
    # The order of the rows in the table and its partitions change nothing.
    assert merkle.manifest(frame(spark, rows[::-1]).repartition(3)).root == made.root
    assert merkle.manifest(frame(spark, rows[1:])).root != made.root


def test_heights(spark):
    sizes = [0, 1, 2, 8, 9, 64, 65, 512, 513, 8**9, 8**9 + 1]
    got = spark.createDataFrame([(s,) for s in sizes], "n long").select("n", merkle.height_of(F.col("n")).alias("h")).collect()
    assert {r.n: r.h for r in got} == dict(zip(sizes, [0, 0, 1, 1, 2, 2, 3, 3, 4, 9, 10], strict=True))

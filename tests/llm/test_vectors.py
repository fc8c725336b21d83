from collections import Counter

import numpy as np
import pytest
from helpers import Groups
from pyspark.sql import functions as F

from restframe.llm import embeddings, topk

SCHEMA = "vec_id long, embedding array<float>, label int, id string, dim int, vec int, unit int"
ODD = [None, [], [0.0] * 8, [None] + [1.0] * 7, [float("nan")] + [1.0] * 7, [float("inf")] + [1.0] * 7, [1.0, 2.0]]


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((12, 8))
    made = [(centres[i % 12] + rng.standard_normal(8) * 0.22).astype(np.float32).tolist() for i in range(240)]
    rows = [(i, v, None if i % 40 == 0 else i % 3) for i, v in enumerate(made)]
    rows += [(1000 + i, v, 1) for i, v in enumerate(ODD)]
    rows += [(2000 + i, rows[i + 1][1], rows[i + 1][2]) for i in range(20)] + [(None, made[0], 1)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], SCHEMA)


def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v)


@pytest.mark.parametrize(("shard", "block"), [(40, 5), (10**6, 10**6)])
def test_top_k(spark, rows, shard, block):
    got = topk.top_k(frame(spark, [*rows, rows[20]]), F.col("id") % 20 == 0, k=7, shard_rows=shard, query_rows=block)
    have = {}
    for r in sorted(got.collect(), key=lambda r: (r.query_id, r["rank"])):
        have.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    ints = {i: np.floor(64 * np.array(v)).astype(int) for i, v, _ in rows if i is not None and usable(v)}
    for q, x in ints.items():
        if q % 20 == 0:
            made = sorted((-int(x @ y), i) for i, y in ints.items() if i != q and len(y) == len(x))[:7]
            assert have.pop(q, []) == [(n + 1, i, -s) for n, (s, i) in enumerate(made)]
    assert not have


def test_top_k_with_ties_and_few_rows(spark):
    rows = [(i, [1.0, 0.5], 0) for i in range(6)]
    got = topk.top_k(frame(spark, rows), F.col("id") == 3, k=4, shard_rows=2, query_rows=1).collect()
    assert sorted((r["rank"], r.vec_id, r.score) for r in got) == [(i + 1, v, 64 * 64 + 32 * 32) for i, v in enumerate([0, 1, 2, 4])]
    assert topk.top_k(frame(spark, rows[:1]), F.col("id") == 0).collect() == []
    assert topk.top_k(frame(spark, []), F.col("id") == 0).collect() == []


def test_top_k_with_large_components(spark):
    rows = [(i, [3e7 + 1000 * i, -1.5, 2e7], 0) for i in range(9)]
    got = topk.top_k(frame(spark, rows), F.col("id") == 4, k=3).collect()
    ints = {i: [int(x) for x in np.floor(64 * np.array(v, np.float32).astype(float))] for i, v, _ in rows}
    want = sorted((-sum(a * b for a, b in zip(ints[4], y, strict=True)), i) for i, y in ints.items() if i != 4)[:3]
    assert sorted((-r.score, r.vec_id) for r in got) == want


def test_tree_boxes_are_tight():
    points = np.random.default_rng(1).integers(-9, 9, (300, 4)).astype(float)
    tree = topk.Tree(points, leaf=16)
    assert sorted(tree.order) == list(range(300))
    for (a, b), low, high in zip(tree.span, tree.low, tree.high, strict=True):
        own = points[tree.order[a:b]]
        assert (own.min(axis=0) == low).all() and (own.max(axis=0) == high).all()


def brute(rows, least=0.93):
    ok = [i for i, (key, v, label) in enumerate(rows) if usable(v) and any(v) and key is not None and label is not None]
    unit = {i: np.array(rows[i][1]) / np.linalg.norm(np.array(rows[i][1])) for i in ok}
    groups, n = Groups(range(len(rows))), Counter()
    for a in ok:
        for b in ok:
            if a < b and rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= least:
                groups.join(a, b)
                n[a] += 1
                n[b] += 1
    least_key = {}
    for i, (key, _, _) in enumerate(rows):
        if key is not None:
            least_key[groups.find(i)] = min(least_key.get(groups.find(i), key), key)
    return Counter((key, n[i], least_key.get(groups.find(i)), key == least_key.get(groups.find(i))) for i, (key, _, _) in enumerate(rows))


@pytest.mark.parametrize("block", [8, 1024])
def test_near_vectors(spark, rows, block):
    got = embeddings.near_vectors(frame(spark, rows), block=block)
    assert Counter(tuple(r) for r in got.collect()) == brute(rows)


def test_near_vectors_repeated_rows_and_none(spark):
    rows = [(5, [1.0, 0.0], 1)] * 3 + [(6, [1.0, 1e-3], 1), (7, [1.0, 0.0], 2), (8, [1.0, 0.0], None)]
    got = sorted(tuple(r) for r in embeddings.near_vectors(frame(spark, rows)).collect())
    assert got == [(5, 3, 5, True)] * 3 + [(6, 3, 5, False), (7, 0, 7, True), (8, 0, 8, True)]
    assert embeddings.near_vectors(frame(spark, [])).collect() == []


def test_recall_of_the_tables():
    for count in (100, 10**6, 10**9):
        bits, tables = embeddings.table_shape(count)
        same = (1 - np.arccos(0.93) / np.pi) ** bits
        assert 1 - (1 - same) ** tables >= 0.9995

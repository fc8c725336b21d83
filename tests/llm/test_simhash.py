import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from helpers import Groups

from restframe.llm import links, simhash

SCHEMA = "doc_id long, text string, id string, key int, component long, row int"


def slow_fingerprint(text, shingle=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints():
    texts = [None, "", " \n", "A", "a B", "a b c", "a b c a b c a", "É é\u00a0x y z", "w" * 99999, "x y " * 40000]
    for text in texts:
        assert simhash.fingerprint(text) == slow_fingerprint(text)


@pytest.fixture(scope="module")
def rows():
    rng, rows = random.Random(2), []
    for i in range(120):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.randint(1, 120))]
        rows.append((i, " ".join(words)))
        if i % 3 == 0:
            words[rng.randrange(len(words))] = "changed"
            rows.append((1000 + i, " ".join(words)))
    return [*rows, rows[4], rows[4], (2000, None), (2001, ""), (2002, " "), (None, rows[0][1]), (None, "alone here it is")]


def brute(rows):
    prints = [simhash.fingerprint(t) for _, t in rows]
    groups = Groups(range(len(rows)))
    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= 3:
                groups.join(i, j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            root = groups.find(i)
            least[root] = min(least.get(root, key), key)
    return [(key, format(prints[i], "016x"), least.get(groups.find(i))) for i, (key, _) in enumerate(rows)], groups


def test_components(spark, rows):
    docs = spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], SCHEMA)
    got = simhash.near_duplicates(docs).collect()
    assert Counter(map(tuple, got)) == Counter(brute(rows)[0])


def test_one_of_each_component_stays(spark, rows):
    docs = spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], SCHEMA)
    out = simhash.deduplicate(docs, shingle=3)
    assert out.columns == docs.columns
    want, groups = brute(rows)
    kept = Counter((r.doc_id, r.text) for r in out.collect())
    firsts = {}
    for i, (key, text) in enumerate(rows):
        root = groups.find(i)
        firsts[root] = min(firsts.get(root, (True, 0)), (key is None, key or 0))
    assert sum(kept.values()) == len(firsts)
    assert Counter((k is None, k or 0) for k, _ in kept) == Counter(firsts.values())


@pytest.mark.parametrize("block", [8, 1024])
def test_large_buckets_lose_no_link(spark, block):
    rng, prints = random.Random(1), set()
    for base in [rng.getrandbits(64) for _ in range(12)]:
        for _ in range(60):
            one = base
            for _ in range(rng.randint(0, 4)):
                one ^= 1 << rng.randrange(64)
            prints.add(one - (1 << 64) if one >> 63 else one)
    frame = spark.createDataFrame([(p,) for p in prints], "id long")
    edges = links.bucket_links(simhash.postings(frame), simhash.FewBits(3), block=block)
    got = {r.id: r.component for r in links.components(edges).collect()}
    ids = np.array(sorted(prints))
    groups = Groups(ids.tolist())
    for i, one in enumerate(ids):
        for j in np.flatnonzero(np.bitwise_count((ids[:i] ^ one).view(np.uint64)) <= 3):
            groups.join(int(one), int(ids[j]))
    assert {i: got.get(i, i) for i in ids.tolist()} == {i: groups.find(i) for i in ids.tolist()}


def test_long_chain(spark):
    ids = list(range(0, 3000, 7))
    edges = spark.createDataFrame([(a, b) for a, b in zip(ids, ids[1:], strict=False)] + [(5, 5)], "u long, v long")
    got = {r.id: r.component for r in links.components(edges).collect()}
    assert got == dict.fromkeys(ids, 0)


def test_no_rows(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(docs).collect() == [] == simhash.deduplicate(docs).collect()

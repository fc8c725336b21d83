import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from restframe.llm import lm

SCHEMA = "doc_id long, text string, word string, score int, key int, place int"


@pytest.fixture(scope="module")
def rows():
    rng, rows = random.Random(9), []
    pools = [[f"{p}{i}" for i in range(300)] for p in "xyz"]
    for i in range(400):
        pool = pools[i % 3]
        words = [pool[min(int(rng.expovariate(0.05)), 299)] for _ in range(rng.randint(1, 60))]
        rows.append((i, " ".join(words).title() + rng.choice(["", ".", "\n"])))
    rows += [(900, None), (901, ""), (902, "unseen Ünseen " * 20), (903, "x1 y2 " * 30000), (None, "x1 x2 null\u00a0key")]
    return [*rows, rows[0], rows[0], (902, "x5")]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "w", 1, 2, 3) for r in rows], SCHEMA)


def held(key):
    return key is not None and zlib.crc32(str(key).encode()) % 7 == 2


def test_counts_and_base(spark, rows):
    got = lm.score_texts(frame(spark, rows), ~lm.is_held_out(F.col("doc_id"))).collect()
    counts = Counter(t for key, text in rows if not held(key) for t in lm.tokens_of(text))
    n, v = sum(counts.values()), len(counts)
    want = []
    for key, text in rows:
        tokens = lm.tokens_of(text)
        base = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens)
        want.append((key is None, key or 0, len(tokens), sum(t in counts for t in tokens), n, round(base, 6)))
    have = [(r.doc_id is None, r.doc_id or 0, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got]
    assert sorted(have) == sorted(want)
    assert all(r.score <= 0 for r in got)
    out = [r for r in got if held(r.doc_id)]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def vocabulary(rows):
    counts = Counter(t for _, text in rows for t in lm.tokens_of(text)).most_common()
    often = [(w, c) for w, c in counts if c >= 5]
    rare = np.bincount([lm.ending(w) for w, c in counts if c < 5], minlength=lm.ENDINGS).astype(float)
    return lm.Vocabulary([w for w, _ in often], np.array([c for _, c in often], float), rare)


def test_probabilities_add_up(rows):
    words = vocabulary(rows)
    model, rng = lm.LogBilinear(words), np.random.default_rng(0)
    for _ in range(50):
        one, two, target = (rng.integers(0, words.size, 500) for _ in range(3))
        model.train(target, one, two, rng)
    for one, two in ((0, 0), (3, 5), (words.size - 1, words.end)):
        every = np.arange(words.size)
        probabilities = 10 ** model.log10(every, np.full_like(every, one), np.full_like(every, two))
        assert abs(probabilities.sum() - 1) < 1e-4
    shares = np.bincount(words.word_class, weights=10**words.share, minlength=words.size)
    assert np.allclose(shares[np.unique(words.word_class)], 1)


def test_shares_of_rare_words_add_up(spark):
    rng = random.Random(2)
    rare = [(f"w{i}".encode(), rng.choice([1, 1, 2, 3]), i % 5) for i in range(200)]
    shares = lm._rare_shares(spark.createDataFrame(rare, "word binary, c long, ending int"))
    for e in range(6):
        known = sum((c - shares["discount"][e]) / shares["n"][e] for _, c, g in rare if g == e)
        assert abs(known + 10 ** shares["log_unknown"][e] - 1) < 1e-9


def test_training_learns_a_pattern():
    words = lm.Vocabulary([b"a", b"b", b"c", b""], np.full(4, 100.0), np.zeros(lm.ENDINGS))
    model, rng = lm.LogBilinear(words), np.random.default_rng(1)
    seq = np.arange(3 * 4000) % 3
    one, two = words.contexts(seq, [len(seq)])
    before = model.log10(seq, one, two).mean()
    for i in range(60):
        part = slice(200 * i, 200 * i + 200)
        model.train(seq[part], one[part], two[part], rng)
    model.norms = None
    assert model.log10(seq, one, two).mean() > before / 2


def test_endings():
    assert len({lm.ending(w) for w in (b"", b"a", b"a.", b"\xc3\xa9", b"?!", b"1")}) == 4
    assert all(0 <= lm.ending(bytes([b])) < lm.ENDINGS for b in range(256))


def test_nothing_to_learn_from_and_no_rows(spark):
    out = lm.score_texts(frame(spark, [(1, "a b"), (2, None)]), F.lit(False)).collect()
    assert sorted((r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in out) == [(1, 0, 0, 0.0), (3, 0, 0, 0.0)]
    assert lm.score_texts(frame(spark, []), F.lit(True)).collect() == []


def test_step_equals_the_formulas_and_norms_stay():
    words = lm.Vocabulary([b"", b"a", b"b", b"c"], np.array([9.0, 7, 6, 5]), np.ones(lm.ENDINGS))
    model, rng = lm.LogBilinear(words), np.random.default_rng(3)
    target, one, two = (rng.integers(0, words.size, 3000) for _ in range(3))
    given, classes, positions, bias = (p.astype(np.float64) for p in model.parameters)
    noise = np.random.default_rng(5).choice(words.size, lm.NOISE, p=model.noise)
    log_noise = np.log(lm.NOISE * model.noise)
    context = given[one] @ positions[0] + given[two] @ positions[1]
    d_real = 1 / (1 + np.exp((context * classes[target]).sum(axis=1) + bias[target] - log_noise[target]))
    d_false = -1 / (1 + np.exp(-(context @ classes[noise].T + bias[noise] - log_noise[noise])))
    d_context = d_real[:, None] * classes[target] + d_false @ classes[noise]
    grads = [np.zeros_like(given), np.zeros_like(classes), np.stack([given[c].T @ d_context for c in (one, two)]), np.zeros_like(bias)]
    np.add.at(grads[0], one, d_context @ positions[0].T)
    np.add.at(grads[0], two, d_context @ positions[1].T)
    np.add.at(grads[1], target, d_real[:, None] * context)
    np.add.at(grads[1], noise, d_false.T @ context)
    np.add.at(grads[3], target, d_real)
    np.add.at(grads[3], noise, d_false.sum(axis=0))
    model.train(target, one, two, np.random.default_rng(5))
    for p, q, g in zip(model.parameters, (given, classes, positions, bias), grads, strict=True):
        g = g / len(target)
        assert np.allclose(p, q + lm.RATE * g / np.sqrt(1e-3 + g * g), atol=1e-5)
    # A norm depends on the parameters alone, not on what else is asked with it, and is found once.
    whole = model.log10(target, one, two)
    norms = model.norms
    assert norms.shape == (words.size, words.size)
    fresh = lm.LogBilinear(words).load(model.flat())
    assert np.allclose([fresh.log10(target[i : i + 1], one[i : i + 1], two[i : i + 1])[0] for i in range(50)], whole[:50], atol=1e-6)
    asked = ~np.isnan(fresh.norms)
    assert (fresh.norms[asked] == norms[asked]).all()
    assert model.log10(target, one, two).tobytes() == whole.tobytes() and model.norms is norms

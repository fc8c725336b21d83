"""Whitening against exact fractions and a plain eigendecomposition."""

from collections import Counter
from fractions import Fraction
from math import floor

import numpy as np
import pytest

from restframe.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, n long, dim string, whitened int, key int"
ODD = [None, [], [None] + [1.0] * 5, [float("nan")] + [1.0] * 5, [1.0] * 5 + [float("-inf")]]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "x", 3, 4) for r in rows], SCHEMA)


def made_rows(n=200, d=6, seed=1):
    rng = np.random.default_rng(seed)
    mix = rng.standard_normal((d, d))
    return [(i, (rng.standard_normal(d) @ mix).astype(np.float32).tolist()) for i in range(n)]


def exact(rows):
    """Integers, sums and the covariance as fractions, of the rows given."""
    x = [[floor(Fraction(c) * 64) + 10**6 for c in v] for _, v in rows]
    n, d = len(x), len(x[0])
    sums = [sum(r[i] for r in x) for i in range(d)]
    mean = [Fraction(s, n) for s in sums]
    cov = [[sum((r[i] - mean[i]) * (r[j] - mean[j]) for r in x) / n for j in range(d)] for i in range(d)]
    return x, sums, cov


def test_fit_is_exact(spark):
    rows = made_rows()
    _, sums, cov = exact(rows)
    odd = [(900 + i, v) for i, v in enumerate(ODD)]
    one = whitening.fit(frame(spark, rows + odd)).fits[6]
    assert one.count == len(rows) and one.sums == sums
    assert (one.covariance == np.array([[float(c) for c in r] for r in cov])).all()
    values, vectors = np.linalg.eigh(one.covariance)
    assert np.allclose(one.eigenvalues, values[::-1]) and np.allclose(np.abs(one.components.T @ vectors[:, ::-1]), np.eye(6), atol=1e-8)


def test_polarisation_alone():
    rng = np.random.default_rng(2)
    x = rng.integers(-50, 50, (40, 5))
    sums = x.sum(axis=0).tolist()
    u = x - np.array([s // 40 for s in sums])
    squares = {(i, j): int(((u[:, i] + u[:, j] * (i != j)) ** 2).sum()) for i in range(5) for j in range(i, 5)}
    assert np.allclose(whitening.covariance_by_polarisation(40, sums, squares), np.cov(x.T, bias=True), rtol=1e-13)


@pytest.mark.parametrize("rows_at_once", [3, 1024])
def test_query_rows(spark, tmp_path, monkeypatch, rows_at_once):
    monkeypatch.setattr(whitening, "ROWS", rows_at_once)
    rows = [*made_rows(150, 40, 3), (None, [0.0] * 40), (7, [0.5] * 40), (7, [0.5] * 40)]
    frame(spark, rows + [(900 + i, v) for i, v in enumerate(ODD)]).repartition(5).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = whitening.op12_whitening(spark, str(tmp_path)).collect()
    x, sums, cov = exact(rows)
    n, matrix = len(rows), np.array([[float(c) for c in r] for r in cov])
    assert Counter(r.component for r in got) == {i + 1: n for i in range(32)} and {r.n for r in got} == {n}
    want = Counter((key, sum((n * a - s) ** 2 for a, s in zip(r, sums, strict=True))) for (key, _), r in zip(rows, x, strict=True))
    assert Counter((r.vec_id, r.deviation) for r in got if r.component == 1) == want
    values, vectors = np.linalg.eigh(matrix)
    centred = np.array([[float(a - Fraction(s, n)) for a, s in zip(r, sums, strict=True)] for r in x])
    plain = centred @ vectors[:, ::-1] / np.sqrt(values[::-1])
    for c in range(32):
        have = sorted((str(r.vec_id), r.whitened) for r in got if r.component == c + 1)
        ways = [sorted((str(k), s * w) for (k, _), w in zip(rows, plain[:, c], strict=True)) for s in (1, -1)]
        assert any(all(a[0] == b[0] and abs(a[1] - b[1]) < 1e-7 for a, b in zip(have, way, strict=True)) for way in ways)
        shares = {r.explained for r in got if r.component == c + 1}
        assert len(shares) == 1 and abs(shares.pop() / (values[::-1][c] / np.trace(matrix)) - 1) < 1e-9
    errors = {r.identity_error for r in got}
    assert len(errors) == 1 and errors.pop() < 1e-9


def test_identity_error_is_measured(spark):
    rows = made_rows(90, 4, 5)
    vectors = frame(spark, rows).repartition(3)
    made = whitening.fit(vectors)
    one = made.fits[4]
    w = one.whiten(np.array([made.to_integers(np.array(v, np.float64)) for _, v in rows]))
    assert abs(made.identity_errors(vectors)[4] - np.abs(np.cov(w.T, bias=True) - np.eye(4)).max()) < 1e-12
    # Another fit's projection is not white, and that shows.
    other = whitening.fit(frame(spark, made_rows(90, 4, 6)))
    assert other.identity_errors(vectors)[4] > 0.1


def test_no_variance_lengths_and_empty(spark):
    assert whitening.fit(frame(spark, [])).fits == {}
    same = [(i, [1.0, 2.0, 3.0]) for i in range(4)]
    made = whitening.fit(frame(spark, same))
    assert len(made.fits[3].eigenvalues) == 0 and made.apply(frame(spark, same)).collect() == []
    # Lengths are fit lists of their own; a dimension that never varies gives no component.
    mixed = [(i, [float(i), 1.0]) for i in range(6)] + [(10 + i, [float(i * i), float(i), -float(i % 2)]) for i in range(5)]
    made = whitening.fit(frame(spark, mixed))
    got = {r.vec_id: r for r in made.apply(frame(spark, mixed)).collect()}
    assert {k: r.dim for k, r in got.items()} == {k: len(v) for k, v in mixed}
    assert all(len(r.whitened) == {2: 1, 3: 3}[r.dim] for r in got.values())
    assert max(made.identity_errors(frame(spark, mixed)).values()) < 1e-9
    assert all(len(r.whitened) == 1 for r in made.apply(frame(spark, mixed), most=1).collect())


def test_empty_query(spark, tmp_path):
    frame(spark, []).write.parquet(f"{tmp_path}/embeddings.parquet")
    out = whitening.op12_whitening(spark, str(tmp_path))
    assert out.collect() == [] and dict(out.dtypes)["deviation"] == "bigint"


def test_large_components(spark):
    rows = [(0, [3e9, 1.0]), (1, [-3e9, 2.0]), (2, [1e9, 5.0])]
    _, sums, cov = exact(rows)
    one = whitening.fit(frame(spark, rows)).fits[2]
    assert one.sums == sums and (one.covariance == np.array([[float(c) for c in r] for r in cov])).all()
    with pytest.raises(Exception, match="deviation does not fit a long"):
        whitening.Whitening({2: one}).apply(frame(spark, rows)).collect()

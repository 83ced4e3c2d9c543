"""Whitening against numpy's eigenvectors of the covariance."""

import math

import numpy as np
import pytest

from shelfline.llm import whitening
from shelfline.llm.common import importable

SCHEMA = "vec_id long, embedding array<float>"


def brute(vectors, components=4):
    """{vec_id: (deviation, whitened of each component)}, n and explained, from whole matrices."""
    x = {i: [math.floor(256 * float(np.float32(c))) for c in v] for i, v in vectors}
    fit = np.array(sorted(set(map(tuple, x.values()))), dtype=np.int64)
    n, sums = len(fit), fit.sum(0)
    centred = (fit * n - sums) / n
    values, directions = np.linalg.eigh(centred.T @ centred / n)
    values, directions = values[::-1][:components], directions[:, ::-1][:, :components]
    white = {i: ((np.array(v) * n - sums) / n) @ directions / np.sqrt(values) for i, v in x.items()}
    deviation = {i: sum((n * a - int(s)) ** 2 for a, s in zip(v, sums)) for i, v in x.items()}
    return n, deviation, white, values / np.trace(centred.T @ centred / n)


@pytest.mark.parametrize("d", [1, 2, 3, 17, 60])
def test_solver_finds_singular_values_and_directions(d):
    rng = np.random.default_rng(d)
    for r in (np.triu(rng.normal(size=(d, d))), np.triu(rng.normal(size=(d, d))) * np.logspace(0, -9, d)[:, None],
              np.diag(np.ones(d)), np.zeros((d, d)), np.triu(rng.normal(size=(d, 1)) @ rng.normal(size=(1, d)))):
        exact = np.linalg.svd(r, compute_uv=False)
        diagonal, above, v = whitening.bidiagonal(r)
        assert np.allclose(v @ v.T, np.eye(d), atol=1e-13)
        values = whitening.dqds(diagonal, above)
        assert np.allclose(np.sqrt(values), exact, rtol=1e-10, atol=1e-12 * max(exact[0], 1e-300))
        squares, rows = whitening.leading(r, min(6, d))
        assert np.allclose(rows @ rows.T, np.eye(len(rows)), atol=1e-12)
        assert np.abs(r.T @ (r @ rows.T) - rows.T * squares).max() <= 1e-12 * max(exact[0] ** 2, 1e-300)


def test_close_values_keep_orthogonal_directions():
    rng = np.random.default_rng(4)
    basis, _ = np.linalg.qr(rng.normal(size=(24, 24)))
    for gap in (1e-3, 1e-7, 1e-12, 0.0):
        values = np.concatenate([1 + gap * np.arange(5), np.linspace(0.1, 0.5, 19)])
        squares, rows = whitening.leading(np.linalg.qr(np.diag(np.sqrt(values)) @ basis, mode="r"), 5)
        assert np.allclose(rows @ rows.T, np.eye(5), atol=1e-11)
        assert np.allclose(squares, np.sort(values)[::-1][:5], rtol=1e-12)


def test_rows_are_whitened_as_by_whole_matrices(spark, monkeypatch):
    importable(spark)
    monkeypatch.setattr(whitening, "BLOCK", 64)
    rng = np.random.default_rng(8)
    base = rng.normal(size=(500, 9)) * np.linspace(1, 3, 9) + 5
    vectors = [(i, [float(c) for c in v]) for i, v in enumerate(base)] + [(1000 + i, list(map(float, base[7]))) for i in range(40)]
    bad = [(2000, None), (2001, [float("nan")] * 9), (2002, [None] + [1.0] * 8), (2003, [float("inf")] * 9), (2004, []), (2005, [1.0, 2.0])]
    frame = (spark.createDataFrame(vectors + bad, SCHEMA).selectExpr("*", "1 AS x", "true AS fine", "2 AS n", "'k' AS part")
             .repartition(40))
    n, deviation, white, explained = brute(vectors)
    rows = whitening.whiten(frame).collect()
    assert sorted((r.vec_id, r.component) for r in rows) == sorted((i, k) for i, _ in vectors for k in range(1, 5))
    sign = {}
    for r in rows:
        want = white[r.vec_id][r.component - 1]
        if r.vec_id == 0:
            sign[r.component] = np.sign(want * r.whitened)
    for r in rows:
        assert r.n == n == 500 and int(r.deviation) == deviation[r.vec_id]
        assert r.whitened == pytest.approx(white[r.vec_id][r.component - 1] * sign[r.component], abs=1e-9)
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-9)
        assert r.identity_error < 1e-9


def test_what_does_not_vary_and_what_is_huge(spark):
    importable(spark)
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None), (2, [])], SCHEMA)).count() == 0
    same = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (None, [1.0, 2.0]), (1, [1.0, 2.0])], SCHEMA)).collect()
    assert sorted((r.vec_id or 0, r.component) for r in same) == [(0, 1), (0, 2), (1, 1), (1, 1), (1, 2), (1, 2)]
    assert {(r.n, int(r.deviation), r.whitened, r.explained, r.identity_error) for r in same} == {(1, 0, None, None, None)}
    line = whitening.whiten(spark.createDataFrame([(1, [0.0, 2.0, -0.0]), (2, [1.0, 2.0, 0.0]), (3, [2.0, 2.0, 0.0])], SCHEMA)).collect()
    assert {(r.component, r.whitened is None) for r in line} == {(1, False), (2, True), (3, True)}
    assert all(r.identity_error < 1e-12 and abs(r.explained - (r.component == 1)) < 1e-12 for r in line)
    huge = whitening.whiten(spark.createDataFrame([(1, [3e38, 0.0]), (2, [-3e38, 1.0]), (3, [0.0, 5.0])], SCHEMA)).collect()
    x = {1: (2**55, 0), 2: (-2**55, 256), 3: (0, 1280)}
    sums = [sum(v[k] for v in x.values()) for k in (0, 1)]
    assert {(r.vec_id, int(r.deviation)) for r in huge} == {
        (i, sum((3 * a - s) ** 2 for a, s in zip(v, sums))) for i, v in x.items()}

"""Whitening against a direct eigenvalue solution, and the solver by itself."""

import math

import numpy as np

from acoustic_spark.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, n string, _x string"


def check(spark, rows, components=16):
    df = spark.createDataFrame([(i, v, "kept", "x") for i, v in rows], SCHEMA).repartition(3)
    out = whitening.whiten(df, components=components).collect()
    fine = [(i, np.floor(64 * np.float32(v).astype(float)).astype(np.int64) + 1_000_000) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.stack([v for _, v in fine])
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    y = (n * fit - sums) / n
    cov = y.T @ y / n
    values, basis = (a[..., ::-1] for a in np.linalg.eigh(cov))
    k = int((values[:components] > 1e-10 * values[0]).sum())
    assert len(out) == k * len(fine)
    projected = ((n * x - sums) / n) @ basis[:, :k] / np.sqrt(values[:k])
    expected = sorted((i, *map(abs, p), int(((n * v - sums) ** 2).sum())) for (i, v), p in zip(fine, projected))
    by_row = {}
    for r in sorted(out, key=lambda r: (r.vec_id, r.component)):
        by_row.setdefault(r.vec_id, []).append(r)
        assert r.n == n and r._x == "x" and r.identity_error < 1e-4
        assert math.isclose(r.explained, values[r.component - 1] / np.trace(cov), rel_tol=1e-10)
    for (i, *p, deviation) in expected:
        found = by_row[i]
        assert {r.deviation for r in found} >= {deviation}
        assert np.allclose([abs(r.whitened) for r in found][: len(p)], p, atol=1e-8)


def test_whitening(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.standard_normal(24) * np.linspace(1, 4, 24)).tolist()) for i in range(300)]
    rows += [(900, None), (901, [None] * 24), (902, [math.nan] * 24), (903, [math.inf] * 24), (904, [])]
    check(spark, rows + [(1000 + i, v) for i, v in rows[:40]])  # copies are in the fit list once


def test_fewer_dimensions_and_rank(spark):
    rng = np.random.default_rng(6)
    check(spark, [(i, rng.standard_normal(5).tolist()) for i in range(60)])
    flat = [(i, [float(i % 7), float(i % 3), 1.0, float(i % 7)]) for i in range(40)]
    df = spark.createDataFrame([(i, v, "", "") for i, v in flat], SCHEMA)
    assert {r.component for r in whitening.whiten(df).collect()} == {1, 2}


def test_nothing_to_whiten(spark):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        df = spark.createDataFrame([(i, v, "", "") for i, v in rows], SCHEMA)
        out = whitening.whiten(df)
        assert out.columns == ["vec_id", "embedding", "_x", "component", "n", "deviation", "whitened", "explained", "identity_error"]
        assert out.count() == 0


def test_odd_lengths_and_large_entries(spark):
    rng = np.random.default_rng(7)
    rows = [(i, rng.standard_normal(3).tolist()) for i in range(30)] + [(50, [1.0, 2.0]), (51, [1e30, 0.0, 0.0])]
    df = spark.createDataFrame([(i, v, "", "") for i, v in rows], SCHEMA)
    out = whitening.whiten(df).collect()
    assert {r.vec_id for r in out} == set(range(30)) and {r.n for r in out} == {30}
    far = whitening.whiten(spark.createDataFrame([(i, [float(i) * 1e10, float(i % 2)], "", "") for i in range(9)], SCHEMA))
    assert far.where("deviation is null").count()  # beyond a BIGINT


def test_solver_needs_several_rounds():
    rng = np.random.default_rng(8)
    a = rng.standard_normal((300, 300))
    a = a @ a.T
    calls = []

    def product(w):
        calls.append(w.shape[1])
        return a @ w

    values, basis = whitening.jacobi_davidson(product, 300, 6)
    exact = np.linalg.eigvalsh(a)[::-1][:6]
    assert np.allclose(values, exact, rtol=1e-12)
    assert np.linalg.norm(a @ basis - basis * values, axis=0).max() < 2e-13 * exact[0]
    assert np.allclose(basis.T @ basis, np.eye(6), atol=1e-12)
    assert len(calls) < 300
    # Equal eigenvalues, and fewer dimensions than wanted components.
    values, basis = whitening.jacobi_davidson(lambda w: w * np.array([[3.0], [3.0], [1.0], [0.0]]), 4, 16)
    assert np.allclose(values, [3, 3, 1, 0])

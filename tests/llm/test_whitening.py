import math

import numpy as np
import pytest

from basketry.llm import whitening as W
from tests.llm import helpers as H

SCHEMA = "vec_id long, embedding array<float>, label int, n long, component string, x double, dim int"


def frame(spark, rows, kind="float"):
    return spark.createDataFrame([(i, v, 1, 5, "c", None, 3) for i, v in rows], SCHEMA.replace("array<float>", f"array<{kind}>")).repartition(3)


def usable(v):
    return v is not None and all(c is not None and math.isfinite(c) for c in v)


def expected(rows, k=16):
    """``{dim: (n, sums, values, vectors, trace)}`` with numpy's own eigenvectors, and the x vectors."""
    xs = [(i, tuple(math.floor(64 * c) + 1000000 for c in v)) for i, v in rows if usable(v)]
    models = {}
    for d in {len(x) for _, x in xs} - {0}:
        fit = np.array(sorted({x for _, x in xs if len(x) == d}), dtype=float)
        y = fit - fit.mean(axis=0)
        values, vectors = np.linalg.eigh(y.T @ y / len(fit))
        models[d] = (len(fit), [int(s) for s in fit.sum(axis=0)], values[::-1][:k], vectors[:, ::-1].T[:k], float(np.trace(y.T @ y / len(fit))))
    return xs, models


def check(got, rows):
    xs, models = expected(rows)
    by = {}
    for r in got:
        by.setdefault((r.vec_id, r.component), []).append(r)
    assert len(got) == sum(min(16, len(x)) for _, x in xs)
    for i, x in xs:
        if not x:
            continue
        n, sums, values, vectors, trace = models[len(x)]
        deviation = sum((n * c - s) ** 2 for c, s in zip(x, sums))
        for c in range(min(16, len(x))):
            mine = [r for r in by[i, c + 1] if r.n == n and r.deviation == deviation]
            assert mine
            r = mine[0]
            if trace > 0:
                assert r.explained == pytest.approx(values[c] / trace, rel=1e-9, abs=1e-12)
            if values[c] > 1e-9 * trace > 0 and all(abs(values[c] - v) > 1e-6 * trace for k, v in enumerate(values) if k != c):
                want = np.dot(np.array(x, float) - np.array(sums) / n, vectors[c]) / math.sqrt(values[c])
                assert abs(r.whitened) == pytest.approx(abs(want), rel=1e-6, abs=1e-6)


def test_against_numpy(spark):
    rows = [(i, v) for i, v, _ in H.vectors(n=150, dim=32)]
    got = W.whiten(frame(spark, rows)).collect()
    check(got, rows)
    errors = {r.n: r.identity_error for r in got}
    assert all(e is None or e < 1e-9 for e in errors.values())
    assert W.whiten(frame(spark, rows).limit(0)).count() == 0


def test_signs_are_the_same_for_all_rows_and_the_covariance_is_the_identity(spark):
    rng = np.random.default_rng(5)
    rows = [(k, [float(c) for c in v]) for k, v in enumerate(rng.standard_normal((400, 20)) * np.linspace(1, 4, 20))]
    rows += rows[:7]  # repeated rows are one vector of the fit list
    got = W.whiten(frame(spark, rows, "double")).collect()
    check(got, rows)
    w = np.zeros((400, 16))
    for r in got:
        w[r.vec_id, r.component - 1] = r.whitened
    cov = (w - w.mean(axis=0)).T @ (w - w.mean(axis=0)) / 400
    assert np.abs(cov - np.eye(16)).max() < 1e-9 and {r.n for r in got} == {400}


def test_vectors_without_variance_and_a_single_one(spark):
    got = W.whiten(frame(spark, [(1, [0.5, 0.25]), (2, [0.5, 0.25])])).collect()
    assert sorted((r.vec_id, r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in got) == [
        (i, c, 1, 0, None, None, None) for i in (1, 2) for c in (1, 2)]
    got = W.whiten(frame(spark, [(1, [0.5, 1.0]), (2, [0.5, -1.0])])).collect()
    assert sorted((r.vec_id, r.component, r.whitened is None) for r in got) == [(1, 1, False), (1, 2, True), (2, 1, False), (2, 2, True)]
    assert {abs(r.whitened) for r in got if r.component == 1} == {1.0}


def test_large_components_are_exact_or_null(spark):
    rows = [(k, [1e6 + k, 3e4 * (k % 3)]) for k in range(9)]
    check(W.whiten(frame(spark, rows, "double")).collect(), rows)
    huge = [(1, [1e300, 1.0]), (2, [-1e300, 1.0]), (3, [1e10, 2.0]), (4, [0.0, 0.0])]
    got = W.whiten(frame(spark, huge, "double")).collect()
    assert len(got) == 8 and {r.deviation for r in got if r.vec_id < 3} == {None}


def test_eigenvalues_are_numbered_through_clusters():
    rng = np.random.default_rng(0)
    for trial in range(120):
        d = int(rng.integers(1, 60))
        q = np.linalg.qr(rng.standard_normal((d, d)))[0]
        values = [rng.random(d) * 10, np.resize(np.repeat(rng.random(d), 3), d), 10.0 ** rng.uniform(-12, 6, d), np.ones(d),
                  np.where(np.arange(d) < 3, rng.random(d), 0.0), 1 + 1e-10 * rng.random(d)][trial % 6]
        v = np.diag(values) if trial % 7 == 0 else (q * values) @ q.T
        v = (v + v.T) / 2
        k = min(16, d)
        e, u = W.leading(v, k)
        want = np.sort(np.linalg.eigvalsh(v))[::-1][:k]
        scale = 1e-12 * d * max(np.abs(want).max(), 1e-300)
        assert np.abs(e - want).max() <= scale and np.abs(u @ u.T - np.eye(k)).max() < 1e-10
        assert np.abs(v @ u.T - u.T * e).max() <= scale


def test_counts_are_those_of_the_eigenvalues():
    rng = np.random.default_rng(1)
    a = rng.standard_normal((30, 30))
    v = a + a.T
    diag, off = W.tridiagonal(v)
    values = np.linalg.eigvalsh(v)
    shifts = rng.uniform(values[0] - 1, values[-1] + 1, 200)
    assert (W.above(diag, off, shifts) == (values[None, :] > shifts[:, None]).sum(axis=1)).all()

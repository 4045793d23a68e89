"""Operator 13 against numpy on centred values."""

import math
import random

import numpy as np

from meeple.llm import whitening

SCHEMA = "vec_id bigint, embedding array<float>, label int, n int, component string"


def vectors(n=300, d=20, seed=1):
    r = random.Random(seed)
    base = [[r.gauss(0, 1 + i / 3) for i in range(d)] for _ in range(n)]
    for v in base:
        v[3] = v[1] * 0.5 + v[3] * 0.1
    rows = [(i, v, 0, 1, "x") for i, v in enumerate(base)]
    rows += [(1000 + i, base[0], 0, 1, "x") for i in range(50)]  # copies count once in the fit
    rows += [(2000, None, 0, 1, "x"), (2001, [None, *base[0][1:]], 0, 1, "x"), (2002, [math.nan, *base[0][1:]], 0, 1, "x"),
             (2003, [math.inf, *base[0][1:]], 0, 1, "x"), (2004, [1.0, 2.0], 0, 1, "x"), (2005, [], 0, 1, "x"),
             (None, base[1], 0, 1, "x"), rows[4]]
    return rows


def check(spark, rows, kept, d, components=16):
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA), components).collect()
    x = {r[0]: [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in r[1]] for r in kept}
    fit = np.array(sorted({tuple(v) for v in x.values()}), object)
    n, total = len(fit), fit.sum(axis=0)
    assert len(got) == len(kept) * min(d, components)
    v = (fit - total / n).astype(float)
    cov = v.T @ v / n
    values = np.sort(np.linalg.eigvalsh(cov))[::-1]
    error = {r.identity_error for r in got}
    assert len(error) == 1 and error.pop() <= 1e-4
    white = {}
    for r in got:
        assert r.n == n
        assert r.deviation == sum((n * a - b) ** 2 for a, b in zip(x[r.vec_id], total, strict=True))
        assert abs(r.explained - values[r.component - 1] / np.trace(cov)) <= 1e-9
        white.setdefault(tuple(x[r.vec_id]), {})[r.component] = r.whitened
    z = np.array([[white[tuple(f)][c + 1] for c in range(min(d, components))] for f in fit])
    assert np.abs(z.T @ z / n - np.eye(z.shape[1])).max() < 1e-6
    # the components are eigenvectors: projecting back gives V's columns scaled
    back = v.T @ z / n / np.sqrt(values[:z.shape[1]])
    assert np.abs(cov @ back - back * values[:z.shape[1]]).max() < 1e-6 * values[0]


def test_equals_numpy(spark):
    rows = vectors()
    check(spark, rows, [r for r in rows if r[0] is None or r[0] < 2000], 20)


def test_fewer_dimensions_than_components(spark):
    rows = vectors(40, 5)
    check(spark, rows, [r for r in rows if r[0] is None or r[0] < 2000], 5)


def test_large_entries_are_exact(spark):
    r = random.Random(4)
    rows = [(i, [r.gauss(0, 1e7), r.gauss(0, 3e6), r.gauss(1e9, 1e8)], 0, 1, "x") for i in range(30)]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    x = {i: [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for i, v, *_ in rows}
    total = [sum(v[j] for v in x.values()) for j in range(3)]
    for g in got:
        want = sum((30 * a - b) ** 2 for a, b in zip(x[g.vec_id], total, strict=True))
        assert g.deviation == (want if want < 1 << 63 else None)
        assert g.identity_error <= 1e-4


def test_no_variance_and_empty_tables(spark):
    one = [(i, [1.0, 2.0], 0, 1, "x") for i in range(5)]
    got = whitening.whiten(spark.createDataFrame(one, SCHEMA)).collect()
    assert len(got) == 10 and all(r.whitened is None and r.deviation == 0 and r.n == 1 for r in got)
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None, 0, 1, "x"), (2, [], 0, 1, "x")], SCHEMA)).count() == 0


def test_polarisation_is_exact():
    r = np.random.default_rng(0)
    x = r.integers(-50, 50, (200, 6)) + 1_000_000
    s = x.sum(axis=0)
    pivot = [int(v) // 200 for v in s]
    y = (x - np.array(pivot)).astype(object)
    squares = {(i, j): int(((y[:, i] + (y[:, j] if j != i else 0)) ** 2).sum()) for i in range(6) for j in range(i, 6)}
    model = whitening.Fit(200, [int(v) for v in s], squares, 6)
    v = x - s / 200
    assert np.abs(model.covariance - v.T @ v / 200).max() < 1e-9

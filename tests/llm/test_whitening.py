"""Whitening against a dense solution, clusters, and odd rows."""

import math

import numpy as np
import pytest

from delayhouse.llm import whitening as w

SCHEMA = "vec_id long, embedding array<float>, x string, n long, component string, place string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 0, "c", "p") for i, v in rows], SCHEMA).repartition(3)


def dense(rows):
    """n, S, eigenvalues and vectors of the distinct integer vectors."""
    fit = np.array(sorted({tuple(math.floor(64 * float(c)) + 1_000_000 for c in v) for _, v in rows}), dtype=object)
    n, total = len(fit), fit.sum(0)
    z = np.array([[float(n * a - s) / n for a, s in zip(r, total)] for r in fit])
    v = z.T @ z / n
    values, vectors = np.linalg.eigh(v)
    return n, total, v, values[::-1], vectors[:, ::-1]


def test_equals_a_dense_solution(spark):
    draw = np.random.default_rng(1)
    mix = draw.normal(size=(20, 20))
    vectors = np.float32(draw.normal(size=(400, 20)) @ mix + 3)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(vectors)]
    rows += [(1000 + i, rows[0][1]) for i in range(50)] + [(None, rows[1][1])]
    n, total, v, values, axes = dense(rows)
    found = w.whiten(spark, frame(spark, rows)).collect()
    assert len(found) == 16 * len(rows)
    given = dict(rows)
    signs = {}
    for r in found:
        x = [math.floor(64 * c) + 1_000_000 for c in given[r["vec_id"]]]
        assert r["n"] == n == 400
        assert r["deviation"] == sum((n * a - s) ** 2 for a, s in zip(x, total))
        k = r["component"] - 1
        want = sum(float(n * a - s) / n * e for a, s, e in zip(x, total, axes[:, k])) / math.sqrt(values[k])
        sign = signs.setdefault(k, math.copysign(1, want * r["whitened"]))
        assert r["whitened"] * sign == pytest.approx(want, abs=1e-9)
        assert r["explained"] == pytest.approx(values[k] / np.trace(v), rel=1e-10)
        assert 0 <= r["identity_error"] < 1e-10
    assert sorted(signs) == list(range(16))


@pytest.mark.parametrize("values", [
    np.r_[100, 100 + 1e-9, 100 - 2e-9, 50, 50, 50, 50, np.linspace(1, 9, 25)], np.geomspace(1, 1e-9, 40), np.ones(12), np.r_[1.0, np.zeros(9)],
    1 + 1e-7 * np.arange(30), np.r_[1e8 + np.arange(10), np.arange(10) + 1.0],
])
def test_eigenvectors_are_exact_to_double_precision(values):
    draw = np.random.default_rng(3)
    q, _ = np.linalg.qr(draw.normal(size=(len(values), len(values))))
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    found, x = w.eigenvectors(a)
    scale = np.abs(values).max()
    assert np.abs(found - np.linalg.eigvalsh(a)[::-1]).max() < 1e-13 * scale * len(a)
    assert np.abs(x.T @ x - np.eye(len(a))).max() < 1e-13 * len(a)
    assert np.abs(a @ x - x * found).max() < 1e-13 * scale * len(a)
    single = np.linalg.eigh(a.astype(np.float32))[1][:, ::-1]
    if len(np.unique(values)) > 1 and scale:
        assert np.abs(a @ single - single * found).max() > 1e-9 * scale  # float32 alone is not enough


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [2.0, 2.0]), (3, None), (4, [None, 1.0]), (5, [nan, 1.0]), (6, [inf, 0.0]), (7, []), (8, [1.0, 2.0, 3.0]), (9, [1e30, 0.0])]
    found = sorted((r["vec_id"], r["component"], r["n"], r["deviation"], r["whitened"], r["explained"]) for r in w.whiten(spark, frame(spark, rows)).collect() if r["component"] == 1)
    assert [f[:4] for f in found] == [(1, 1, 2, 64**2), (1, 1, 2, 64**2), (2, 1, 2, 64**2)]
    assert [abs(f[4]) for f in found] == pytest.approx([1, 1, 1]) and {f[5] for f in found} == {1.0}
    second = [r for r in w.whiten(spark, frame(spark, rows)).collect() if r["component"] == 2]
    assert len(second) == 3 and all(r["whitened"] is None and r["identity_error"] < 1e-12 for r in second)
    alone = w.whiten(spark, frame(spark, rows[:2])).collect()
    assert len(alone) == 4 and all(r["whitened"] is r["explained"] is r["identity_error"] is None and r["deviation"] == 0 for r in alone)
    assert w.whiten(spark, frame(spark, [])).count() == 0 and w.whiten(spark, frame(spark, rows[3:7])).count() == 0


def test_wide_integers_stay_exact():
    x = np.array([[2**61, 5], [2**61 + 64, 5], [-(2**61), 7]], np.int64)
    totals = [int(c) for c in x.astype(object).sum(0)]
    centre = w.Centre.of(3, totals)
    want = [sum((3 * int(a) - s) ** 2 for a, s in zip(r, totals)) for r in x]
    assert centre.deviation(x) == [v if v < 2**63 else None for v in want]
    near = np.array([[2**61, 5], [2**61 + 640, 5]], np.int64)
    totals = [int(c) for c in near.astype(object).sum(0)]
    assert w.Centre.of(2, totals).deviation(near) == [640**2, 640**2]

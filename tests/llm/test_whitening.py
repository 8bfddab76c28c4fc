import math
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from clickloom.llm import whitening

SCHEMA = "vec_id bigint, embedding array<float>"


def test_eigenvectors_match_numpy():
    random = np.random.default_rng(1)
    for d in (1, 2, 3, 5, 17, 64):
        a = random.standard_normal((d, d))
        a = a @ a.T
        count = min(4, d)
        values, vectors = whitening.leading_components(a, count)
        want, axes = np.linalg.eigh(a)
        assert np.allclose(values, want[::-1][:count], rtol=1e-13)
        assert np.allclose(np.abs((axes[:, ::-1][:, :count] * vectors).sum(0)), 1, atol=1e-10)
        assert np.abs(a @ vectors - vectors * values).max() < 1e-12 * np.abs(a).max() * d


def test_clusters_are_orthogonal():
    random = np.random.default_rng(2)
    for values in ([5, 5, 5, 5, 1, 0.5], [3, 3 - 1e-14, 3 - 1e-9, 2, 1, 1], [1, 1, 1, 1, 1, 1], [0, 0, 0, 0, 0, 0]):
        q, _ = np.linalg.qr(random.standard_normal((6, 6)))
        a = q @ np.diag(np.array(values, float)) @ q.T
        a = (a + a.T) / 2
        got, vectors = whitening.leading_components(a, 4)
        assert np.allclose(vectors.T @ vectors, np.eye(4), atol=1e-9) and np.allclose(got, sorted(values, reverse=True)[:4], atol=1e-12)
        assert np.abs(a @ vectors - vectors * got).max() < 1e-7


def test_sturm_counts():
    diagonal, off = np.array([1.0, 2.0, 3.0, 4.0]), np.array([0.5, 0.0, 0.25])
    values = np.linalg.eigvalsh(np.diag(diagonal) + np.diag(off, 1) + np.diag(off, -1))
    for x in np.linspace(-1, 6, 50):
        assert whitening.count_below(diagonal, off, x) == (values < x).sum()


def brute(rows):
    """(vec_id, component, n, deviation, |whitened|, explained)"""
    kept = [(i, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = [list(v) for v in {tuple(x) for _, x in kept}]
    n, d = len(fit), len(fit[0])
    sums = [sum(x[j] for x in fit) for j in range(d)]
    centred = [[Fraction(n * x[j] - sums[j], n) for j in range(d)] for x in fit]
    v = np.array([[float(sum(c[a] * c[b] for c in centred) / n) for b in range(d)] for a in range(d)])
    values, axes = np.linalg.eigh(v)
    out = []
    for i, x in kept:
        deviation = sum((n * x[j] - sums[j]) ** 2 for j in range(d))
        away = np.array([float(Fraction(n * x[j] - sums[j], n)) for j in range(d)])
        for k in range(min(4, d)):
            out.append((i, k + 1, n, deviation, abs(away @ axes[:, -1 - k]) / math.sqrt(values[-1 - k]), values[-1 - k] / np.trace(v)))
    return out


def same(got, want):
    got = sorted((r["vec_id"] is not None, r["vec_id"] or 0, r["component"], r["n"], r["deviation"], abs(r["whitened"]), r["explained"]) for r in got)
    want = sorted((w[0] is not None, w[0] or 0, *w[1:]) for w in want)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5:] for g in got], [w[5:] for w in want], rtol=1e-7, atol=1e-9)


def test_matches_brute_force(spark):
    random = np.random.default_rng(3)
    scales = np.array([3.0, 2.0, 1.0, 0.5, 0.25, 0.1])
    rows = [(i, [float(np.float32(x)) for x in random.standard_normal(6) * scales + 1]) for i in range(60)]
    rows += [(100, rows[0][1]), (101, None), (102, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (103, [float("nan")] + [0.0] * 5), (104, [float("-inf")] + [0.0] * 5), (None, rows[1][1]), (0, rows[2][1])]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    same(got, brute(rows))
    assert {r["n"] for r in got} == {60} and len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-10


def test_small_and_odd_tables(spark):
    make = lambda rows, kind=SCHEMA: whitening.whiten(spark.createDataFrame(rows, kind)).collect()
    assert make([]) == [] and make([(1, None), (2, [])]) == []
    one = make([(1, [0.5, 0.25]), (1, [0.5, 0.25])])
    assert len(one) == 4 and {(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in one} == {(1, 0, 0.0, 0.0, 0.0)}
    line = make([(i, [i / 256.0, 0.0, 0.0]) for i in range(5)])
    assert len(line) == 15 and all(r["whitened"] == 0.0 for r in line if r["component"] > 1)
    assert sorted(abs(r["whitened"]) for r in line if r["component"] == 1) == pytest.approx(sorted(abs(i - 2) / math.sqrt(2) for i in range(5)))
    uneven = make([(1, [1.0, 2.0]), (2, [2.0, 1.0]), (3, [1.0])])
    assert Counter(r["vec_id"] for r in uneven) == {1: 2, 2: 2}
    far = make([(1, [3e38, 0.0]), (2, [-3e38, 1.0]), (3, [1.0, 2.0])])
    assert len(far) == 6 and {(r["vec_id"], r["deviation"] is None) for r in far} == {(1, True), (2, True), (3, False)} and all(math.isfinite(r["whitened"]) for r in far)


def test_exact_sums_beyond_floating_point(spark):
    rows = [(i, [float(1 << 53) + 2.0 * i, 1.0 * i]) for i in range(4)]
    fit = whitening.usable(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).select("x")
    assert whitening.totals(fit, 2) == [256 * (4 * (1 << 53) + 12), 256 * 6]


def test_clashing_columns(spark):
    rows = [(1, [1.0, 2.0], 5, "a"), (2, [2.0, 4.5], 6, "b"), (3, [0.0, 1.0], 7, None)]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA + ", n int, component string")).collect()
    same(got, brute([r[:2] for r in rows]))

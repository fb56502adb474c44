"""Whitening against numpy's eigendecomposition of the exact covariance."""

from fractions import Fraction

import numpy as np
import pytest

from parley.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, id string, x int, n int, component string"


def expected(vectors):
    x = [[int(np.floor(256 * float(np.float32(c)))) for c in v] for v in vectors]
    fit = sorted(set(map(tuple, x)))
    n, d = len(fit), len(fit[0])
    sums = [sum(r[j] for r in fit) for j in range(d)]
    centred = np.array([[float(Fraction(n * r[j] - sums[j], n)) for j in range(d)] for r in fit])
    values, vecs = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)
    deviation = [sum((n * r[j] - sums[j]) ** 2 for j in range(d)) for r in x]
    mean = np.array([float(Fraction(s, n)) for s in sums])
    return n, deviation, values[order], vecs[:, order], np.array(x, float) - mean


def check(rows, vectors, ids, components=4):
    n, deviation, values, vecs, centred = expected(vectors)
    k = min(components, int((values > 1e-10 * values[0]).sum()))
    assert len(rows) == k * len(vectors)
    for c in range(1, k + 1):
        mine = sorted((r for r in rows if r["component"] == c), key=lambda r: (r["vec_id"] is None, r["vec_id"] or 0))
        want = centred @ vecs[:, c - 1] / np.sqrt(values[c - 1])
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0))
        got = np.array([r["whitened"] for r in mine])
        want = want[order]
        sign = np.sign(got[np.argmax(np.abs(want))] * want[np.argmax(np.abs(want))])
        assert np.allclose(got * sign, want, atol=1e-6)
        assert [r["deviation"] for r in mine] == [deviation[i] for i in order]
        assert {r["n"] for r in mine} == {n}
        assert all(abs(r["explained"] - values[c - 1] / values.sum()) < 1e-8 for r in mine)
        assert all(r["identity_error"] < 1e-8 for r in mine)


def test_against_plain_eigenvectors(spark):
    rng = np.random.default_rng(1)
    vectors = (rng.normal(size=(400, 12)) * np.linspace(1, 3, 12) + 5).astype(np.float32).tolist()
    vectors += vectors[:50] * 3  # equal vectors fit once
    ids = list(range(len(vectors)))
    ids[7] = None
    rows = [(i, v, "a", 1, 2, "b") for i, v in zip(ids, vectors, strict=True)]
    odd = [None, [], [None] * 12, [float("nan")] + [0.0] * 11, [float("inf")] + [0.0] * 11, [1.0, 2.0]]
    rows += [(1000 + i, v, None, None, None, None) for i, v in enumerate(odd)]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    check(got, vectors, ids)


@pytest.mark.parametrize("spread", [1e-3, 1e4])
def test_ill_conditioned_and_singular_columns(spark, spread):
    """A column of another size, a constant one and one that repeats another."""
    rng = np.random.default_rng(2)
    a = rng.normal(size=(300, 6)).astype(np.float32)
    a[:, 1] *= spread
    a[:, 2] = 7
    a[:, 4] = a[:, 3]
    vectors = a.tolist()
    got = whitening.whiten(spark.createDataFrame([(i, v, "", 0, 0, "") for i, v in enumerate(vectors)], SCHEMA)).collect()
    check(got, vectors, list(range(300)))


def test_fewer_directions_than_components(spark):
    line = [[float(i), 2.0 * i, 0.0] for i in range(9)]
    rows = [(i, v, "", 0, 0, "") for i, v in enumerate(line)]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    check(got, line, list(range(9)))
    assert {r["component"] for r in got} == {1}
    equal = spark.createDataFrame([(i, [1.0, 2.0], "", 0, 0, "") for i in range(4)], SCHEMA)
    assert whitening.whiten(equal).collect() == []
    assert whitening.whiten(equal.limit(0)).collect() == []


def test_wide_entries_keep_exact_deviations(spark):
    vectors = [[1e12, 0.0], [-1e12, 1.0], [3.0, 2.0], [1e30, 1.0]]
    rows = [(i, v, "", 0, 0, "") for i, v in enumerate(vectors)]
    got = whitening.whiten(spark.createDataFrame(rows[:3], SCHEMA)).collect()
    # What BIGINT cannot hold is NULL, the rest exact.
    assert {r["vec_id"]: r["deviation"] for r in got} == {0: None, 1: None, 2: 1536**2 + 768**2}
    assert {r["vec_id"] for r in whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()} == {0, 1, 2, 3}


def test_shift_and_passes():
    rng = np.random.default_rng(4)
    a = rng.normal(size=(200, 5)) * [1, 1e-5, 1e3, 1, 1]
    r = whitening.shifted_factor(a.T @ a, 200, True)
    assert np.allclose(r, np.triu(r)) and np.allclose(whitening.triangular_solve(a @ r, r), a)
    singular = a.copy()
    singular[:, 3] = singular[:, 4]
    assert np.isfinite(whitening.shifted_factor(singular.T @ singular, 200, False)).all()

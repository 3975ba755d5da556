"""Operator 12 against numpy's eigenproblem and exact integers."""

import math

import numpy as np
import pytest

from civicflow.llm import whitening as W
from conftest import SF_SMALL

SCHEMA = "vec_id long, embedding array<double>, label int, n long"


def brute(rows):
    """Per vec_id: deviation and whitened (up to sign), by numpy on the whole table."""
    x = np.array([[math.floor(256 * c) for c in v] for _, v in rows], dtype=np.int64)
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    y = fit - s / n
    cov = y.T @ y / n
    value, vector = np.linalg.eigh(cov)
    value, vector = value[::-1][:4], vector[:, ::-1][:, :4]
    dev = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(r, s)) for r in x]
    return n, dev, (x - s / n) @ vector / np.sqrt(value), value / np.trace(cov)


def test_query_matches_numpy(spark):
    from civicflow.llm.queries import op12_whitening
    rows = [(r["vec_id"], r["embedding"])
            for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    n, dev, white, share = brute(rows)
    got = {(r["vec_id"], r["component"]): r for r in op12_whitening(spark, SF_SMALL).collect()}
    assert len(got) == 4 * len(rows)
    for c in range(1, 5):
        mine = np.array([got[i, c]["whitened"] for i, _ in rows])
        theirs = white[:, c - 1]
        sign = np.sign(mine @ theirs)
        assert np.allclose(mine, sign * theirs, atol=1e-8)
        assert all(got[i, c]["deviation"] == d and got[i, c]["n"] == n for (i, _), d in zip(rows, dev))
        assert abs(got[rows[0][0], c]["explained"] / share[c - 1] - 1) < 1e-9
    assert max(r["identity_error"] for r in got.values()) < 1e-10


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 1.0], 0, 9), (1, [0.5, 1.0], 0, 9), (None, [0.25, -1.0], 1, 9), (2, [-0.0, 0.001], 1, 9),
            (3, None, 0, 9), (4, [1.0, None], 0, 9), (5, [nan, 1.0], 0, 9), (6, [inf, 1.0], 0, 9),
            (7, [], 0, 9), (8, [1.0, 2.0, 3.0], 0, 9)]
    out = W.whitened(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r["vec_id"] or 0, r["component"]) for r in out) == sorted(
        (i, c) for i in (1, 1, 0, 2) for c in (1, 2))
    assert {r["n"] for r in out} == {3}
    n, dev, white, _ = brute([(i, v) for i, v, _, _ in rows[:4]])
    assert sorted(r["deviation"] for r in out if r["component"] == 1) == sorted(dev)
    assert out[0].identity_error < 1e-12


def test_no_variance_no_rows_and_out_of_range(spark):
    same = W.whitened(spark.createDataFrame([(1, [1.0, 2.0], 0, 0)] * 3, SCHEMA)).collect()
    assert [(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"])
            for r in same] == [(1, 0, 0.0, 0.0, 0.0)] * 6
    assert W.whitened(spark.createDataFrame([], SCHEMA)).collect() == []
    assert W.whitened(spark.createDataFrame([(1, None, 0, 0)], SCHEMA)).collect() == []
    big = W.whitened(spark.createDataFrame([(1, [1e300, 0.0], 0, 0), (2, [-1e300, 0.0], 0, 0)],
                                           SCHEMA)).collect()
    assert {r["deviation"] for r in big} == {None}


def test_deviation_is_exact_near_the_end_of_long():
    n, s = 3_000_000_000, [5, -7]
    fit = W.Whitening(2, [1, 1], np.eye(2), 2)
    fit.n, fit.sums = n, s
    x = np.array([[0, 0], [1, 0], [1, 1], [0, 1], [2, 0]])
    want = [sum((n * int(a) - b) ** 2 for a, b in zip(r, s)) for r in x]
    assert fit.deviations(x) == [v if v < 1 << 63 else None for v in want]


@pytest.mark.parametrize("matrix", [
    np.eye(6), np.diag([3.0, 3, 3, 1, 1]), np.ones((5, 5)), np.diag([1e-300, 1e-300, 0]),
    np.diag(np.arange(40.0)) + 1e-9, np.diag([1 + 1e-14, 1, 1 - 1e-14, 0.5]), np.zeros((4, 4)),
    np.array([[2.0]]), np.array([[2.0, 1], [1, 2]])])
def test_leading_components(matrix):
    value, vector = W.leading_components(matrix, 4)
    scale = np.abs(matrix).max() or 1.0
    want = np.linalg.eigvalsh(matrix)[::-1][:4]
    assert np.allclose(value / scale, want / scale, atol=1e-14)
    assert np.abs(vector @ vector.T - np.eye(len(value))).max() < 1e-13
    assert np.abs(matrix @ vector.T - vector.T * value).max() < 1e-13 * scale * len(matrix)


def test_random_matrices_and_sturm_counts():
    rng = np.random.default_rng(3)
    for d in (2, 3, 17, 64):
        a = rng.standard_normal((d, d))
        a = a @ a.T
        diagonal, off, q = W.tridiagonal(a)
        t = np.diag(diagonal) + np.diag(off, 1) + np.diag(off, -1)
        assert np.allclose(q @ t @ q.T, a, atol=1e-11 * np.abs(a).max())
        value = np.linalg.eigvalsh(a)
        points = np.array([value[0] - 1, *(value[:-1] + value[1:]) / 2, value[-1] + 1])
        assert W.sturm_count(diagonal, off, points).tolist() == list(range(d + 1))
        mine, vector = W.leading_components(a, 4)
        assert np.allclose(mine, value[::-1][:4], rtol=1e-12)
        assert np.abs(a @ vector.T - vector.T * mine).max() < 1e-11 * value[-1]


def test_packing_is_canonical():
    for v in ([0, 1], [127, -128], [128, 0], [40000, 1], [1 << 40, -5]):
        x = np.array(v, np.int64)
        assert W.unpack(W.pack(x)).tolist() == v
    assert W.pack(np.array([0])) == W.pack(np.array([0], np.int32))

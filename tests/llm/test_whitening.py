import math

import numpy as np
import pytest

from fieldlake.llm.whitening import (
    characteristic_polynomial,
    components_at,
    exact_sums,
    largest_roots,
    polynomial_modulo,
    roots_above,
    whiten,
)

SCHEMA = "vec_id long, embedding array<float>, x int, whitened string, component int"
FAR = float("inf")


def brute(rows, scale=256, keep=4):
    """The same by floor, an eigendecomposition in doubles, and Python integers."""
    grid = [(i, [math.floor(scale * c) for c in v]) for i, v in rows if v is not None and all(c is not None and abs(c) < FAR for c in v)]
    size = max((len(v) for _, v in grid), default=0)
    grid = [(i, v + [0] * (size - len(v))) for i, v in grid]
    fit = np.array(sorted({tuple(v) for _, v in grid}))
    n, sums = len(fit), fit.sum(axis=0)
    values, vectors = np.linalg.eigh(np.cov(fit.T.astype(float), bias=True).reshape(size, size))
    out = {}
    for i, v in grid:
        moved = [n * a - int(s) for a, s in zip(v, sums)]
        for k in range(min(keep, size)):
            if values[-1 - k] > 1e-9:
                white = np.dot(moved, vectors[:, -1 - k]) / n / math.sqrt(values[-1 - k])
                out[i, k + 1] = (n, sum(m * m for m in moved), abs(white), values[-1 - k] / values.sum())
    return out


def same(got, expected):
    found = {(r.vec_id, r.component): r for r in got}
    assert len(found) == len(got) and set(found) == set(expected)
    for key, (n, deviation, white, share) in expected.items():
        r = found[key]
        assert (r.n, int(r.deviation)) == (n, deviation)
        assert abs(r.whitened) == pytest.approx(white, abs=1e-9)
        assert r.explained == pytest.approx(share, rel=1e-9)
        assert r.identity_error < 1e-9


@pytest.fixture
def table(spark):
    return lambda rows: spark.createDataFrame([(i, v, 1, "a", 2) for i, v in rows], SCHEMA)


def test_same_as_brute_force(table):
    rng = np.random.default_rng(1)
    rows = [(i, [float(np.float32(c)) for c in rng.normal(0, 0.2, 9) * np.arange(1, 10)]) for i in range(120)]
    rows += [(200, rows[0][1]), (201, rows[0][1]), (202, None), (203, [1.0, None] + [0.0] * 7), (204, [float("nan")] * 9)]
    rows += [(205, [FAR] + [0.0] * 8), (206, [0.25, 0.5]), (207, []), (208, [0.0] * 9), (209, [-0.0] * 9)]
    same(whiten(table(rows)).collect(), brute(rows))


def test_one_sign_for_all_rows(table):
    rng = np.random.default_rng(2)
    rows = [(i, [float(c) for c in rng.normal(0, 1, 5)]) for i in range(60)]
    white = {(r.vec_id, r.component): r.whitened for r in whiten(table(rows)).collect()}
    w = np.array([[white[i, k] for k in range(1, 5)] for i in range(60)])
    assert np.abs(np.cov(w.T, bias=True) - np.eye(4)).max() < 1e-9


def test_query_table(spark):
    path = "/root/testdata/sf0.001/embeddings.parquet"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(path).collect()]
    same(whiten(spark.read.parquet(path)).collect(), brute(rows))


def test_tables_without_spread(table, spark):
    assert whiten(table([])).count() == 0
    assert whiten(table([(1, None), (2, [])])).count() == 0
    assert whiten(table([(1, [0.5, 1.0]), (2, [0.5, 1.0])])).count() == 0
    got = whiten(table([(None, [0.0, 1.0]), (None, [0.0, 2.0]), (5, [0.0, 2.0])])).collect()
    assert [(r.component, r.n, r.explained) for r in got] == [(1, 2, 1.0)] * 3
    assert sorted(round(abs(r.whitened), 12) for r in got) == [1.0] * 3


def test_equal_eigenvalues(table):
    rows = [(k, [float(s * (k == j)) for j in range(6)]) for k in range(6) for s in (-1, 1)]
    got = whiten(table(rows)).collect()
    assert len(got) == 48 and max(r.identity_error for r in got) < 1e-9
    assert {round(r.explained, 12) for r in got} == {round(1 / 6, 12)}


def test_close_eigenvalues_are_told_apart(spark):
    matrix = np.array([[10**30 + 1, 0, 0], [0, 10**30, 0], [0, 0, 7]], object)
    turn = np.array([[3, 4, 0], [-4, 3, 0], [0, 0, 5]], object)
    turned = turn @ matrix @ turn.T
    groups = largest_roots(characteristic_polynomial(spark, turned), 2)
    assert [len(g) for g in groups] == [1, 1, 1]
    assert np.allclose(np.abs(components_at(turned, groups[0])[:, 0]), [0.6, 0.8, 0], atol=1e-15)
    assert np.allclose(np.abs(components_at(turned, groups[1])[:, 0]), [0.8, 0.6, 0], atol=1e-15)


def test_polynomial_and_roots(spark):
    rng = np.random.default_rng(4)
    for size in (1, 2, 5, 12):
        some = rng.integers(-9, 9, (size, size)).astype(object)
        square = some @ some.T
        found = characteristic_polynomial(spark, square)
        power, expected = np.eye(size, dtype=int).astype(object) * 0, [1]
        for k in range(1, size + 1):  # Faddeev-LeVerrier
            power = square @ power + expected[-1] * np.eye(size, dtype=int).astype(object)
            expected.append(-int((square @ power).trace()) // k)
        assert found == expected[::-1]
        assert (polynomial_modulo(square, 101) == np.array(found[:], object) % 101).all()
        values = np.linalg.eigvalsh(square.astype(float))
        assert roots_above(found, 10) == (values > 10).sum()
        assert roots_above(found, 41, 2) == (values > 10.25).sum()


def test_sums_beyond_doubles(table):
    large = np.array([[2**40, -(2**62)], [3, 2**61], [-(2**63), 1]])
    sums, products = exact_sums(large)
    assert sums.tolist() == [2**40 + 3 - 2**63, -(2**62) + 2**61 + 1]
    assert products[0, 1] == products[1, 0] == -(2**102) + 3 * 2**61 - 2**63
    rows = [(k, [float(v) for v in (3e38 * (k % 2), 1e30 * k)]) for k in range(4)]
    got = whiten(table(rows)).collect()
    assert {r.vec_id for r in got} == {0, 1, 2, 3} and max(r.identity_error for r in got) < 1e-6

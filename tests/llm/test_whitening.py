"""Whitening against numpy's own decompositions and exact integers."""

import math
from collections import defaultdict

import numpy as np
import pytest

from patchloom.llm import bidiagonal, queries, whitening
from patchloom.llm.common import table

SCHEMA = "vec_id long, embedding array<float>, label string, component string, values int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, None, "c", 1) for i, v in rows], SCHEMA)


@pytest.mark.parametrize("shape", [(1, 1), (2, 2), (5, 3), (40, 17), (200, 64)])
def test_singular_values_and_vectors(shape):
    rng = np.random.default_rng(shape[0])
    for graded in (False, True):
        x = rng.standard_normal(shape) * (10.0 ** -np.arange(shape[1]) if graded and shape[1] < 8 else 1)
        r = np.linalg.qr(x, mode="r")
        square = np.zeros((shape[1], shape[1]))
        square[: len(r)] = r
        values, rows = bidiagonal.right_singular(square, shape[1])
        want = np.linalg.svd(x, compute_uv=False) ** 2
        assert np.allclose(values, want[: len(values)], rtol=1e-12) and len(values) == min(shape)
        assert np.abs(rows @ rows.T - np.eye(len(rows))).max() < 1e-11
        assert np.abs(x.T @ x @ rows.T - rows.T * values).max() < 1e-11 * want[0]


def test_bidiagonal_form():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((9, 9))
    a, b, p = bidiagonal.bidiagonalise(x)
    form = np.diag(a) + np.diag(b, 1)
    assert np.allclose(form.T @ form, p.T @ x.T @ x @ p)
    assert np.allclose(p.T @ p, np.eye(9))


def test_small_singular_values_are_relatively_accurate():
    # a graded bidiagonal, whose least value no absolute method can see
    a, b = [10.0**-k for k in range(0, 60, 4)], [0.5 * 10.0**-k for k in range(0, 56, 4)]
    got = bidiagonal.qd_eigenvalues([x * x for x in a], [x * x for x in b])
    assert math.isclose(math.prod(math.sqrt(x) / y for x, y in zip(got, sorted(a, reverse=True))), 1, rel_tol=1e-9)


def test_equal_and_zero_values():
    values, rows = bidiagonal.right_singular(np.eye(12) * 3, 12)
    assert np.allclose(values, 9) and np.abs(rows @ rows.T - np.eye(12)).max() < 1e-14
    x = np.outer(np.arange(1, 8.0), np.arange(1, 8.0))
    values, rows = bidiagonal.right_singular(x, 7)
    assert len(values) == 1 and np.isclose(values[0], np.linalg.norm(x) ** 2)
    assert len(bidiagonal.right_singular(np.zeros((4, 4)), 4)[0]) == 0
    wilkinson = np.diag(np.abs(np.arange(-10, 11.0))) + np.diag(np.ones(20), 1) + np.diag(np.ones(20), -1)
    factor = np.linalg.cholesky(wilkinson + 3 * np.eye(21)).T
    values, rows = bidiagonal.right_singular(factor, 21)  # pairs that agree to many digits
    assert np.abs(rows @ rows.T - np.eye(21)).max() < 1e-11
    assert np.allclose(values, np.linalg.eigvalsh(wilkinson + 3 * np.eye(21))[::-1], rtol=1e-12)


def by_hand(rows):
    good = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([v for _, v in good], dtype=object)
    n, s = len(x), x.sum(axis=0)
    deviation = [int(((n * v - s) ** 2).sum()) for v in x]
    centred = ((n * x - s) / n).astype(float)
    return [i for i, _ in good], deviation, centred


def check(rows, got, k):
    ids, deviation, centred = by_hand(rows)
    n = len(ids)
    covariance = centred.T @ centred / n
    values, basis = np.linalg.eigh(covariance)
    values, basis = values[::-1][:k], basis[:, ::-1][:, :k]
    want = centred @ basis / np.sqrt(values)
    out = defaultdict(dict)
    for r in got:
        assert r.n == n and r.identity_error < 1e-10
        assert math.isclose(r.explained, values[r.component - 1] / np.trace(covariance), rel_tol=1e-9)
        out[r.vec_id][r.component] = (r.whitened, int(r.deviation))
    assert sorted(out) == sorted(ids) and all(sorted(v) == list(range(1, k + 1)) for v in out.values())
    assert {i: v[1][1] for i, v in out.items()} == dict(zip(ids, deviation))
    ours = np.array([[out[i][c][0] for c in range(1, k + 1)] for i in ids])
    sign = np.sign((ours * want).sum(axis=0))
    assert np.abs(ours - want * sign).max() < 1e-8


def test_query_equals_numpy(spark, small):
    rows = [(r.vec_id, r.embedding) for r in table(spark, small, "embeddings").select("vec_id", "embedding").collect()]
    check(rows, queries.op12_embedding_whitening(spark, small).collect(), 32)


def test_parts_change_nothing(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((300, 6)).astype(np.float32))]
    monkeypatch.setattr(whitening, "FOLDED", 2)
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 3)
    check(rows, whitening.whiten(vectors(spark, rows).repartition(9)).collect(), 6)


def test_odd_rows(spark):
    rng = np.random.default_rng(6)
    good = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((20, 3)).astype(np.float32))]
    nan, inf = float("nan"), float("inf")
    odd = [(100, None), (101, [1.0, None, 2.0]), (102, [nan, 0.0, 0.0]), (103, [1.0, -inf, 0.0]), (104, []), (105, [1.0, 2.0]), (106, [3e38, 0.0, 0.0])]
    got = whitening.whiten(vectors(spark, good + odd)).collect()
    check(good, got, 3)
    twice = whitening.whiten(vectors(spark, [*good, (None, good[0][1]), (0, good[0][1])])).collect()
    assert sum(r.vec_id is None for r in twice) == 3 and sum(r.vec_id == 0 for r in twice) == 6


def test_tables_without_variation(spark):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(i, [0.5, 0.25]) for i in range(5)]):
        out = whitening.whiten(vectors(spark, rows))
        assert out.count() == 0 and out.columns[:2] == ["vec_id", "component"]
    flat = whitening.whiten(vectors(spark, [(i, [float(i), 2.0, float(i)]) for i in range(9)]))
    assert {r.component for r in flat.collect()} == {1}  # two directions don't vary


def test_values_that_need_more_than_64_bits(spark):
    rng = np.random.default_rng(7)
    rows = [(i, v.tolist()) for i, v in enumerate((rng.standard_normal((8, 2)) * 1e15).astype(np.float32))]
    got = whitening.whiten(vectors(spark, rows)).collect()
    ids, deviation, _ = by_hand(rows)
    assert {r.vec_id: int(r.deviation) for r in got} == dict(zip(ids, deviation))

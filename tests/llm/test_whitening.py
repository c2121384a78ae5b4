"""Whitening against plain double and big-integer arithmetic; eigenvectors of clustered matrices."""

import math

import numpy as np
import pytest
from paddock.llm import whitening

SCHEMA = "vec_id long, embedding array<float>"


def orthogonal(n, seed):
    return np.linalg.qr(np.random.default_rng(seed).normal(size=(n, n)))[0]


@pytest.mark.parametrize("gap", [1.0, 1e-5, 1e-9, 1e-13, 0.0])
def test_clustered_eigenvalues(gap):
    n = 24
    values = np.array([5.0, 5.0 - gap, 5.0 - 2 * gap, *np.linspace(2.5, 1, n - 3)])
    q = orthogonal(n, 1)
    matrix = (q * values) @ q.T
    matrix = (matrix + matrix.T) / 2
    found, vectors = whitening.eigen(matrix)
    assert np.abs(found - values).max() < 1e-14 * 5 * 4
    assert np.abs(vectors.T @ vectors - np.eye(n)).max() < 1e-15 * 4
    wide = vectors.astype(np.longdouble)
    assert np.abs(matrix.astype(np.longdouble) @ wide - wide * found).max() < 1e-14
    if gap >= 1e-5:  # vectors of the cluster are told apart as far as the matrix allows
        assert np.abs(np.abs((vectors[:, :3] * q[:, :3]).sum(axis=0)) - 1).max() < 1e-9


def test_scales_and_zero_matrices():
    for scale in (1e-30, 1e30):
        values, vectors = whitening.eigen(np.diag([3.0, 1.0, 2.0]) * scale)
        assert np.allclose(values, np.array([3, 2, 1]) * scale, rtol=1e-15)
        assert np.abs(vectors[0, 0]) == 1
    assert whitening.eigen(np.zeros((3, 3)))[0].tolist() == [0, 0, 0]


def brute(vectors, components):
    """Rows by component, computed in the plainest way."""
    kept = [
        (i, [math.floor(1024 * float(np.float32(c))) + 100_000 for c in v])
        for i, v in vectors
        if v and all(c is not None and math.isfinite(c) for c in v)
    ]
    n, x = len(kept), np.array([v for _, v in kept], np.float64)
    total = [sum(v[d] for _, v in kept) for d in range(x.shape[1])]
    centred = x - np.array([t / n for t in total])
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    white = centred @ axes[:, :components] / np.sqrt(values[:components])
    deviations = [sum((n * e - t) ** 2 for e, t in zip(v, total)) for _, v in kept]
    return [i for i, _ in kept], n, deviations, white, values[:components] / values.sum()


def test_against_brute_force(spark):
    rng = np.random.default_rng(3)
    data = rng.normal(size=(400, 12)) * np.linspace(3, 0.2, 12) @ orthogonal(12, 2) + 7
    vectors = [(i, [float(np.float32(c)) for c in row]) for i, row in enumerate(data)]
    vectors += [(5, vectors[5][1]), (None, vectors[6][1])]
    odd = [(900, None), (901, []), (902, [1.0] * 11 + [None]), (903, [float("nan")] * 12), (904, [float("inf")] * 12)]
    frame = spark.createDataFrame(vectors + odd, SCHEMA).repartition(5)
    got = whitening.whiten(frame).collect()
    ids, n, deviations, white, explained = brute(vectors, 8)
    assert len(got) == 8 * n and {r.n for r in got} == {n}
    by_component = {k: {} for k in range(1, 9)}
    for row in got:
        by_component[row.component].setdefault(row.vec_id, []).append(row)
        assert row.identity_error < 1e-9
    for k, found in by_component.items():
        signs = set()
        for i, vec_id in enumerate(ids):
            row = found[vec_id][0]
            assert row.deviation == deviations[i]
            assert abs(row.explained / explained[k - 1] - 1) < 1e-9
            assert abs(abs(row.whitened) - abs(white[i, k - 1])) < 1e-9
            signs.add(np.sign(row.whitened) == np.sign(white[i, k - 1]))
        assert len(signs) == 1
        assert len(found[5]) == 2 and len(found[None]) == 1


def test_whole_numbers_stay_exact():
    n = 10**9
    centre = whitening.Centre(n, [n * 100_000 + 1, n * 99_000 - 7])
    rows = np.array([[100_005, 99_000], [100_000, 99_000]], np.int64)
    want = [sum((n * v - t) ** 2 for v, t in zip(row, centre.total)) for row in rows.tolist()]
    assert centre.squares(rows) == [w if w < 2**63 else None for w in want]
    assert want[0] >= 2**63 > want[1]


def test_few_rows_and_odd_tables(spark):
    make = lambda rows: spark.createDataFrame(rows, SCHEMA)
    assert whitening.whiten(make([])).count() == 0
    assert whitening.whiten(make([(1, None), (2, [])])).count() == 0
    alone = whitening.whiten(make([(1, [1.0, 2.0, 3.0])])).collect()
    assert [(r.component, r.whitened, r.explained, r.deviation) for r in alone] == [(k, None, 0.0, 0) for k in (1, 2, 3)]
    pair = whitening.whiten(make([(1, [1.0, 2.0]), (2, [3.0, 2.0]), (3, [0.0] * 5), (4, [1e38, 0.0])])).collect()
    assert {(r.vec_id, r.component, r.n) for r in pair} == {(v, k, 2) for v in (1, 2) for k in (1, 2)}
    assert {abs(r.whitened) for r in pair if r.component == 1} == {1.0}
    assert {r.whitened for r in pair if r.component == 2} == {None}


def test_clashing_names(spark):
    frame = spark.createDataFrame([(1, [1.0, 0.0], 5, 1), (2, [0.0, 1.0], 6, 2)], "vec_id long, embedding array<double>, EMBEDDING int, n int")
    assert whitening.whiten(frame).count() == 4

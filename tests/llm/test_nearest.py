"""Neighbours against brute force in double precision."""

import numpy as np
import pytest
from paddock.llm import nearest

VECTORS = "vec_id long, embedding array<float>, VECTOR string, score double"


def brute(rows, every, k):
    usable = [
        (i, np.array(v, np.float64)) for i, v, *_ in rows
        if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)
    ]
    out = []
    for n, (i, v) in enumerate(usable):
        if i % every == 0:
            near = [
                (float(np.sqrt(np.cumsum((w - v) ** 2)[-1])), j)
                for m, (j, w) in enumerate(usable) if m != n and len(w) == len(v)
            ]
            out += [(i, r, j, d) for r, (d, j) in enumerate(sorted(near)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("side", [16, 16_384])
def test_against_brute_force(spark, monkeypatch, side):
    monkeypatch.setattr(nearest, "SIDE", side)
    chance = np.random.default_rng(3)
    rows = [(i, [float(x) for x in chance.standard_normal(8).astype(np.float32)], "x", 0.5) for i in range(150)]
    rows += [(200 + i, rows[7][1], "x", 0.5) for i in range(20)]  # ties
    rows += [(20, rows[3][1], "", None), (20, rows[3][1], "", None)]  # repeated rows
    rows += [(300, None, "", None), (310, [], "", None), (320, [0.0] * 8, "", None), (330, [None] + [1.0] * 7, "", None)]
    rows += [(340, [float("nan")] * 8, "", None), (350, [float("inf")] * 8, "", None), (None, [1.0] * 8, "", None)]
    rows += [(360, [1.0, 2.0], "", None), (361, [1.0, 2.5], "", None), (370, [2.0**-140] * 8, "", None), (380, [2.0**100] * 8, "", None)]
    got = nearest.search(spark.createDataFrame(rows, VECTORS), every=10)
    assert sorted(map(tuple, got.collect())) == brute(rows, 10, 10)


def test_few_and_none(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.0, 1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert [tuple(r) for r in nearest.search(frame).collect()] == brute(rows, 100, 10)
    assert nearest.search(frame.limit(0)).count() == 0
    assert nearest.search(frame.where("vec_id = 1")).count() == 0


def test_bounds_hold():
    chance = np.random.default_rng(4)
    a, b = chance.standard_normal((40, 1500)), chance.standard_normal((50, 1500)) * 7
    (ca, sa, na, la), (cb, sb, nb, lb) = nearest.quantise(a), nearest.quantise(b)
    inner = nearest.products(ca, cb)
    assert (inner == ca.astype(np.int64) @ cb.astype(np.int64).T).all()
    error = la[:, None] * nb + (na[:, None] + la[:, None]) * lb
    assert (np.abs(a @ b.T - inner * sa[:, None] * sb) <= error).all()

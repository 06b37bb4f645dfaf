"""Whitening against a dense eigendecomposition."""

from __future__ import annotations

import numpy as np
import pytest

from reelyard.llm import whitening as W

DDL = "vec_id long, embedding array<float>, x long, n long, component string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, "c") for i, v in rows], DDL).repartition(3)


def dense(rows, wanted=16):
    ids = [i for i, _ in rows]
    x = np.floor(np.array([v for _, v in rows], dtype=np.float32).astype(float) * 64).astype(np.int64) + 1_000_000
    u = np.unique(x, axis=0)
    n, s = len(u), u.sum(axis=0)
    c = (n * u - s) / n
    e, w = np.linalg.eigh(c.T @ c / n)
    e, w = e[::-1], w[:, ::-1]
    z = (n * x - s) / n @ w[:, :wanted] / np.sqrt(e[:wanted])
    return ids, n, ((n * x - s) ** 2).sum(axis=1), z, e


def drawn(n, size, seed=1, spread=0.8):
    r = np.random.default_rng(seed)
    return (r.standard_normal((n, size)) * spread ** np.arange(size)) @ np.linalg.qr(r.standard_normal((size, size)))[0]


@pytest.mark.parametrize("n,size,spread", [(300, 20, 0.8), (60, 17, 0.5), (500, 3, 0.9)])
def test_equal_to_dense_eigenvectors(spark, n, size, spread):
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(drawn(n, size, spread=spread))]
    rows += [(1000 + i, v) for i, (_, v) in enumerate(rows[: n // 3])]  # copies do not weigh
    k = min(16, size)
    ids, distinct, deviation, z, e = dense(rows, k)
    got = {(r.vec_id, r.component): r for r in W.report(frame(spark, rows)).collect()}
    k = max(c for _, c in got)  # components that exist in double precision
    assert len(got) == len(rows) * k and np.all(e[k : min(16, size)] <= 2 * W.RANK * e[0])
    for c in range(1, k + 1):
        mine = np.array([got[i, c].whitened for i in ids])
        sign = np.sign(mine @ z[:, c - 1])
        assert np.abs(mine * sign - z[:, c - 1]).max() < 1e-7
    for i, d in zip(ids, deviation.tolist(), strict=True):
        r = got[i, 1]
        assert (r.n, r.deviation) == (distinct, d) and r.identity_error < 1e-7
        assert abs(r.explained / (e[0] / e.sum()) - 1) < 1e-9


def test_rank_and_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    flat = [(i, [float(i % 7), float(i % 3), float(i % 7 + i % 3), 2.0]) for i in range(40)]  # two dimensions of four
    bad = [(100, None), (101, []), (102, [1.0, None, 2.0, 3.0]), (103, [nan] * 4), (104, [1.0, inf, 0.0, 0.0]), (105, [1.0, 2.0]), (106, [3e30] * 4)]
    twice = [(0, flat[5][1]), (None, flat[3][1])]
    rows = W.report(frame(spark, flat + bad + twice)).collect()
    assert {r.component for r in rows} == {1, 2}
    assert len(rows) == 2 * 42 and sum(r.vec_id == 0 for r in rows) == 4 and {r.vec_id for r in rows} <= {None, *range(40)}
    assert abs(sum({r.component: r.explained for r in rows}.values()) - 1) < 1e-12 and rows[0].identity_error < 1e-9
    for none in ([], bad, [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        assert W.report(frame(spark, none)).collect() == []
    assert W.report(frame(spark, none)).dtypes == W.report(frame(spark, flat)).dtypes


def test_exact_deviations_beyond_double_and_long():
    big = np.array([[3_000_000_019, 1], [2**31, 2**31]], dtype=np.int64)
    assert W._deviations(big).to_pylist() == [3_000_000_019**2 + 1, None]
    assert W._deviations(np.array([[3, 4]])).to_pylist() == [25]

"""Whitening against numpy's eigenvectors; the refinement by itself."""

from __future__ import annotations

import numpy as np
import pytest

from meterlake.llm import whitening


def _matrix(values, seed):
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values), len(values))))[0]
    v = (q * values) @ q.T
    return (v + v.T) / 2


@pytest.mark.parametrize(
    "values",
    [
        np.linspace(1, 50, 40),
        np.r_[1 + 1e-9 * np.arange(5), np.linspace(3, 9, 20)],
        np.r_[np.ones(6), 2, 2, 2 + 1e-7, np.linspace(5, 6, 9)],
        10.0 ** -np.arange(12),
        np.r_[np.zeros(4), 1, 2, 3],
        np.ones(8),
    ],
)
def test_refined_vectors(values):
    v = _matrix(values, len(values))
    value, x, steps = whitening.eigenvectors(v)
    top = np.abs(values).max()
    assert np.all(np.diff(value) <= 1e-12 * top)
    assert np.abs(value - np.sort(np.linalg.eigvalsh(v))[::-1]).max() < 1e-13 * top * len(values)
    assert np.abs(x.T @ x - np.eye(len(values))).max() < 1e-13
    assert np.abs(v @ x - x * value).max() < 2e-14 * top * len(values)  # float32 alone: about 1e-7
    assert steps < 40


def _brute(rows, k):
    rows = [(i, v) for i, v in rows if v is not None and len(v) == 6 and all(x is not None and np.isfinite(x) for x in v)]
    x = np.array([[int(np.floor(64 * c)) + 1_000_000 for c in v] for _, v in rows], dtype=object)
    n, s = len(rows), x.sum(axis=0)
    dev = x * n - s
    y = (dev / n).astype(float)
    value, vec = np.linalg.eigh(y.T @ y / n)
    value, vec = value[::-1], vec[:, ::-1]
    return n, [(i, int((d**2).sum())) for (i, _), d in zip(rows, dev)], y @ vec[:, :k] / np.sqrt(value[:k]), value[:k] / value.sum()


ROWS = [(i, (np.random.default_rng(i).normal(size=6) * [1, 2, 3, 4, 5, 0.5]).tolist()) for i in range(300)]
ODD = [(900, None), (901, [1.0] * 5), (902, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (903, [float("nan")] * 6), (904, [1.0] * 5 + [float("inf")]), (905, []), (3, [0.0] * 6), (None, [9.0] * 6), (3, ROWS[3][1])]


def test_equals_numpy(llm_spark):
    rows = ROWS + ODD
    df = llm_spark.createDataFrame([(*r, 1.0, 5) for r in rows], "vec_id long, embedding array<double>, whitened double, n int").repartition(5)
    n, deviation, white, explained = _brute(rows, 4)
    got = whitening.whiten(df, components=4).collect()
    assert {r.n for r in got} == {n} and len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-10
    assert np.allclose(got[0].explained, explained, rtol=1e-10)
    own = sorted(((str(r.vec_id), int(r.deviation)), r.whitened) for r in got)
    want = sorted(((str(i), d), w.tolist()) for (i, d), w in zip(deviation, white))
    assert [o[0] for o in own] == [w[0] for w in want]
    a, b = np.array([o[1] for o in own]), np.array([w[1] for w in want])
    assert np.abs(a - b * np.sign((a * b).sum(axis=0))).max() < 1e-9
    long = whitening.components_long(whitening.whiten(df, components=4))
    assert long.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert long.count() == 4 * n and long.dtypes[3][1] == "bigint"


def test_defined_cases(llm_spark):
    def run(rows, **kw):
        return whitening.whiten(llm_spark.createDataFrame(rows, "vec_id long, embedding array<double>"), **kw).collect()

    assert run([]) == [] and run([(1, None)]) == [] and run([(1, [])]) == []
    assert run([(1, [1.0, 2.0])]) == [] and run([(1, [1.0, 2.0]), (2, [1.0, 2.0])]) == []
    one = run([(1, [1.0, 2.0]), (2, [2.0, 4.0]), (3, [3.0, 6.0])])  # one direction holds all variance
    assert [len(r.whitened) for r in one] == [1, 1, 1] and one[0].identity_error < 1e-12
    huge = run([(1, [1e30, 1.0]), (2, [-1e30, 2.0]), (3, [0.0, 3.0])])
    assert len(huge) == 3 and all(np.isfinite(r.whitened).all() for r in huge)
    c = [2**56 + 1_000_000, -(2**56) + 1_000_000, 1_000_000]
    e = [64 + 1_000_000, 128 + 1_000_000, 192 + 1_000_000]
    assert [int(r.deviation) for r in huge] == [(3 * a - sum(c)) ** 2 + (3 * b - sum(e)) ** 2 for a, b in zip(c, e)]


def test_exact_parts():
    x = np.array([[2**55, 3], [-(2**55), 5]])
    n, sums = 2**12, [17, 4]
    dev = whitening.deviations(x, n, sums)
    assert dev.tolist() == [[2**67 - 17, 3 * 2**12 - 4], [-(2**67) - 17, 5 * 2**12 - 4]]
    assert whitening.square_sums(dev)[0] == (2**67 - 17) ** 2 + (3 * 2**12 - 4) ** 2
    assert whitening.square_sums(np.array([[2**31, 2**31]]))[0] == 2**63

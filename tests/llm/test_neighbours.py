"""Nearest neighbours against all pairs."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterlake.llm import neighbours


def _usable(v):
    return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(x != 0 for x in v)


def _brute(rows, every, k):
    usable = [(i, np.array(v) + 0.0) for i, v in rows if i is not None and _usable(v)]
    of_key = {}
    for i, v in usable:
        if i not in of_key or v.tobytes() > of_key[i].tobytes():
            of_key[i] = v
    rows = [(i, v.tolist()) for i, v in of_key.items()]
    out = []
    for q, v in rows:
        if q % every == 0:
            found = []
            for c, u in rows:
                if c != q and len(u) == len(v):
                    score = 0.0
                    for x, y in zip(v, u):
                        score += x * y
                    found.append((-score, c))
            out += [(q, r + 1, c, -s) for r, (s, c) in enumerate(sorted(found)[:k])]
    return sorted(out)


def _run(spark, rows, k=5, every=7, schema="vec_id long, embedding array<double>"):
    df = spark.createDataFrame(rows, schema)
    got = neighbours.nearest(df, F.col("vec_id") % every == 0, k=k)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(map(tuple, got.collect()))


@pytest.mark.parametrize("query_block,candidate_block,stripes", [(8192, 8192, 512), (16, 32, 3)])
def test_equals_all_pairs(llm_spark, monkeypatch, query_block, candidate_block, stripes):
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", query_block)
    monkeypatch.setattr(neighbours, "CANDIDATE_BLOCK", candidate_block)
    monkeypatch.setattr(neighbours, "STRIPES", stripes)
    monkeypatch.setattr(neighbours, "_QUERIES_AT_ONCE", 8)
    monkeypatch.setattr(neighbours, "_CANDIDATES_AT_ONCE", 16)
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=9) * 10.0 ** rng.integers(-3, 3)).tolist()) for i in range(400)]
    hot = rng.normal(size=9).tolist()
    rows += [(400 + i, hot) for i in range(200)]  # a third of all rows are one vector
    rows += [(600 + i, rng.integers(-2, 3, 9).astype(float).tolist()) for i in range(60)]  # many equal scores
    assert _run(llm_spark, rows) == _brute(rows, 7, 5)


def test_defined_cases(llm_spark):
    rows = [
        (0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, None), (7, None), (3, []), (4, [0.0, 0.0]), (14, [0.0, 0.0]), (5, [float("nan"), 1.0]),
        (6, [float("inf"), 1.0]), (8, [None, 1.0]), (None, [3.0, 4.0]), (21, [0.5, -0.0]), (9, [0.5, 0.0]), (28, [1.0, 2.0, 3.0]), (10, [3.0, 2.0, 1.0]),
        (35, [1.0]), (-7, [2.0, 1.0]), (42, [1.0, 1.0]), (42, [-1.0, 1.0]),
    ]
    assert _run(llm_spark, rows) == _brute(rows, 7, 5)
    assert _run(llm_spark, []) == []
    clash = llm_spark.createDataFrame([(*r, 1, b"x", [2]) for r in rows], "vec_id long, embedding array<float>, rank int, key binary, ids array<int>")
    assert neighbours.nearest(clash, F.col("vec_id") % 7 == 0, k=3).count() == len(_brute(rows, 7, 3))


def test_bounds_hold():
    rng = np.random.default_rng(5)
    a, b = rng.normal(size=(300, 33)) * 10.0 ** rng.integers(-6, 6, (300, 1)), rng.normal(size=(200, 33))
    a[0], a[1, 1:] = 1e-300, 0
    product, off = neighbours.tile_bounds(neighbours.quantised(a), neighbours.quantised(b))
    true = a @ b.T
    assert np.all(true >= product - off) and np.all(true <= product + off)
    assert np.median(off / (np.linalg.norm(a, axis=1)[:, None] * np.linalg.norm(b, axis=1))) < 0.02

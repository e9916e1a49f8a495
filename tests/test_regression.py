"""Moments against numpy's least squares, whole, merged and per group."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterlake.operators import regression

FEATURES = ["a", "b", "c"]


def _rows():
    rng = np.random.default_rng(8)
    rows = []
    for group, n in ((1, 300), (2, 40), (3, 3), (None, 30)):
        a, b, c = rng.normal(230, 5, n), rng.normal(size=n), rng.integers(0, 24, n).astype(float)
        y = 3 * a - 2 * b + 0.5 * c + rng.normal(size=n) + 10 * (group or 0)
        rows += [(group, i % 7, float(a[i]), float(b[i]), float(c[i]), float(y[i])) for i in range(n)]
    return rows + [(1, 0, None, 1.0, 1.0, 5.0), (1, 0, 1.0, 1.0, 1.0, None), (4, 0, None, 1.0, 1.0, 1.0)]


def _frame(spark, rows):
    return spark.createDataFrame(rows, "g int, day int, a double, b double, c double, y double").repartition(5)


def _numpy(rows):
    m = np.array([r[2:] for r in rows if None not in r[2:]])
    x = np.c_[m[:, :3], np.ones(len(m))]
    return np.linalg.lstsq(x, m[:, 3], rcond=None)[0]


def _coefs(row):
    return [row.coef_1, row.coef_2, row.coef_3, row.intercept]


@pytest.mark.parametrize("merged", [False, True])
def test_whole_and_per_group(spark, merged):
    rows = _rows()
    df = _frame(spark, rows)
    for by in ([], ["g"]):
        if merged:
            fit = regression.merge(regression.moments(df, FEATURES, "y", [*by, "day"]), 3, by)
        else:
            fit = regression.moments(df, FEATURES, "y", by)
        got = {tuple(r[b] for b in by): r for r in regression.solve(fit, 3, by).collect()}
        assert set(got) == ({(1,), (2,), (3,), (None,)} if by else {()})
        for key, r in got.items():
            own = [x for x in rows if not by or x[0] == key[0]]
            if len(own) > 20:
                assert np.allclose(_coefs(r), _numpy(own), rtol=1e-7, atol=1e-6), (by, key)
    scored = regression.predict(df, regression.solve(regression.moments(df, FEATURES, "y"), 3), FEATURES)
    assert scored.where(F.col("prediction").isNull()).count() == 2
    own = regression.predict(df, regression.solve(regression.moments(df, FEATURES, "y", ["g"]), 3, ["g"]), FEATURES, ["g"])
    assert own.count() == len(rows) and own.where("g IS NULL AND prediction IS NULL").count() == 0


def test_features_that_do_not_vary(spark):
    rows = [(1, 0, 5.0, float(i), 2.0 * i, 3.0 * i + 1) for i in range(20)] + [(2, 0, 1.0, 1.0, 1.0, 7.0)]
    got = {r.g: r for r in regression.solve(regression.moments(_frame(spark, rows), FEATURES, "y", ["g"]), 3, ["g"]).collect()}
    assert got[1].coef_1 == 0 and got[1].coef_3 == 0 and abs(got[1].coef_2 - 3) < 1e-12 and abs(got[1].intercept - 1) < 1e-9
    assert _coefs(got[2]) == [0, 0, 0, 7.0]


def test_no_rows(spark):
    empty = _frame(spark, _rows()).where("false")
    whole = regression.solve(regression.moments(empty, FEATURES, "y"), 3).collect()
    assert [(r.n, r.intercept) for r in whole] == [(0, None)]
    assert regression.solve(regression.moments(empty, FEATURES, "y", ["g"]), 3, ["g"]).collect() == []
    merged = regression.solve(regression.merge(regression.moments(empty, FEATURES, "y", ["day"]), 3), 3).collect()
    assert [(r.n, r.intercept) for r in merged] == [(0, None)]


def test_plan_has_no_python_and_shuffles_moments_only(spark):
    fit = regression.solve(regression.moments(_frame(spark, _rows()), FEATURES, "y", ["g"]), 3, ["g"])
    plan = fit._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "partial_covar_pop" in plan

"""Least squares from mergeable moments.

``moments`` reduces rows to one row a group: their number, the means of the
features and the label, and all centred products. The rows are algebraic:
moments of disjoint inputs (days, batches, files) combine with ``merge`` into
those of their union, so a fit can be kept up to date from daily moments and
never needs its rows again. ``solve`` turns each group's moments into
coefficients by elimination on columns, so groups are fitted where they lie,
and ``predict`` is a second pass over rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A feature of which the others leave less than this share of its variance
#: is taken to be one of their combinations and gets the coefficient 0.
LEAST_SHARE = 1e-9


def _slots(k: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(k + 1) for j in range(i, k + 1)]


def _with_group(rows: DataFrame, groups: DataFrame, by: Sequence[str], value: str, how: str) -> DataFrame:
    """``rows`` with the column ``value`` of their group; NULL keys are a
    group like others, and without keys there is one."""
    if not by:
        return rows.withColumn(value, groups.select(value).scalar())
    right = groups.select(*[F.col(b).alias(f"_group_{b}") for b in by], value)
    same = [F.col(b).eqNullSafe(F.col(f"_group_{b}")) for b in by]
    return rows.join(right, same, how).drop(*[f"_group_{b}" for b in by])


def moments(df: DataFrame, features: Sequence[str], label: str, by: Sequence[str] = ()) -> DataFrame:
    """``by, n, mean_i, m_i_j``: features in their order, the label last; rows
    that lack a value are left out. One partial aggregation."""
    cols = [*features, label]
    known = df.dropna(subset=cols)
    n = F.count(F.lit(1))
    return known.groupBy(*by).agg(
        n.alias("n"),
        *[F.avg(c).alias(f"mean_{i}") for i, c in enumerate(cols)],
        *[(F.covar_pop(cols[i], cols[j]) * n).alias(f"m_{i}_{j}") for i, j in _slots(len(features))],
    )


def merge(parts: DataFrame, k: int, by: Sequence[str] = ()) -> DataFrame:
    """Moments of ``k`` features over groups of ``by`` from moments of finer
    groups: m = sum(m_p) + sum(n_p (mean_p - mean)(mean_p - mean)')."""
    some = parts.where("n > 0")
    means = [F.try_divide(F.sum(F.col("n") * F.col(f"mean_{i}")), F.sum("n")).alias(f"mean_{i}") for i in range(k + 1)]
    totals = some.groupBy(*by).agg(F.sum("n").alias("n"), *means).select(*by, F.struct("n", *[f"mean_{i}" for i in range(k + 1)]).alias("all"))
    some = _with_group(some, totals, by, "all", "inner")
    off = [F.col(f"mean_{i}") - F.col(f"all.mean_{i}") for i in range(k + 1)]
    return some.groupBy(*by).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        *[F.first(f"all.mean_{i}").alias(f"mean_{i}") for i in range(k + 1)],
        *[F.sum(F.col(f"m_{i}_{j}") + F.col("n") * off[i] * off[j]).alias(f"m_{i}_{j}") for i, j in _slots(k)],
    )


def solve(moments: DataFrame, k: int, by: Sequence[str] = ()) -> DataFrame:
    """``by, n, coef_1..coef_k, intercept``: the normal equations by symmetric
    elimination, a projection a feature. No division by zero: a feature that
    does not vary, or only with earlier ones, gets 0; a group without rows
    has no intercept (NULL)."""
    out = moments
    for p in range(k):
        left = out.withColumn(f"ok_{p}", F.col(f"m_{p}_{p}") > LEAST_SHARE * (F.col(f"v_{p}") if p else F.lit(0.0)))
        if not p:
            left = left.withColumns({f"v_{i}": F.col(f"m_{i}_{i}") for i in range(1, k)})
        step = {}
        for i in range(p + 1, k):
            f = F.when(F.col(f"ok_{p}"), F.try_divide(F.col(f"m_{p}_{i}"), F.col(f"m_{p}_{p}"))).otherwise(F.lit(0.0))
            step |= {f"m_{i}_{j}": F.col(f"m_{i}_{j}") - f * F.col(f"m_{p}_{j}") for j in range(i, k + 1)}
        out = left.withColumns(step) if step else left
    for p in reversed(range(k)):
        rest: Column = F.col(f"m_{p}_{k}")
        for j in range(p + 1, k):
            rest = rest - F.col(f"m_{p}_{j}") * F.col(f"coef_{j + 1}")
        out = out.withColumn(f"coef_{p + 1}", F.when(F.col(f"ok_{p}"), F.try_divide(rest, F.col(f"m_{p}_{p}"))).otherwise(F.lit(0.0)))
    intercept: Column = F.col(f"mean_{k}")
    for p in range(k):
        intercept = intercept - F.col(f"coef_{p + 1}") * F.col(f"mean_{p}")
    return out.select(*by, "n", *[f"coef_{p + 1}" for p in range(k)], intercept.alias("intercept"))


def predict(df: DataFrame, fitted: DataFrame, features: Sequence[str], by: Sequence[str] = (), into: str = "prediction") -> DataFrame:
    """``df`` with the value that its group's coefficients give; NULL where the
    group was not fitted or a feature is missing."""
    k = len(features)
    model = fitted.select(*by, F.struct(*[f"coef_{p + 1}" for p in range(k)], "intercept").alias("_fit"))
    rows = _with_group(df, model, by, "_fit", "left")
    value: Column = F.col("_fit.intercept")
    for p, c in enumerate(features):
        value = value + F.col(f"_fit.coef_{p + 1}") * F.col(c)
    return rows.withColumn(into, value).drop("_fit")

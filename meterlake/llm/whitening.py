"""Whitening of embeddings by refined eigenvectors of their covariance.

Entries are counted in 64ths: x = floor(64 c) + 1,000,000, a whole number.
Sums S are exact; the covariance of x is that of y = x - S/n, where n x - S
is computed in whole numbers, so no digits are lost to the large offset.

Work on rows is distributed: tasks sum their rows' products (y' y) into one
matrix each, neighbouring matrices are added in tasks, and their entries are
summed by Spark. What reaches the driver has the size of one covariance, the
square of the dimension, at any number of rows.

Eigenvectors start as those of the covariance in float32 and are corrected
by the iteration of Ogita and Aishima in extended precision: with R = I - X'X and
S = X'VX, a step X + XE takes E from S and R by matrix products alone, with
quadratic convergence where eigenvalues lie apart. Where they lie closer than
the error of the step, E only restores orthogonality, and the vectors of each
such cluster are turned by the eigenvectors of the small matrix X_J' (V - m I)
X_J, whose entries are as small as the cluster is wide.

Defined cases: vectors that are null, of another length than most (a tie
takes the smaller length) or hold null or non-finite entries take no part
and get no row; rows without a key or of equal keys are rows like others;
entries beyond 2^56 64ths are cut to that; components whose eigenvalue is
under 1e-12 of the trace have no whitened value and get no row, so a table
of one vector or of equal vectors gives none, as an empty table does; equal
eigenvalues: any orthonormal basis of their space, one for all rows; other
columns of the input are ignored, whatever they are called; there are no
texts here.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.vectors import dimension, matrix
from meterlake.llm.words import tidy_batches

SCALE, OFFSET = 64.0, 1_000_000
_LIMIT = float(2**56)
#: Matrices of so many neighbouring tasks are added first.
_FAN_IN = 64
_LEAST = 1e-12


def whole_numbers(m: np.ndarray) -> np.ndarray:
    return np.floor(np.clip(SCALE * m, -_LIMIT, _LIMIT)).astype(np.int64) + OFFSET


def deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S, exact: int64 where that is wide enough, else Python's."""
    if len(x) and n * max(abs(int(x.min())), abs(int(x.max()))) + max(abs(s) for s in sums) < 2**62:
        return x * np.int64(n) - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def centred(dev: np.ndarray, n: int) -> np.ndarray:
    return (dev / n).astype(np.float64)


def square_sums(dev: np.ndarray) -> list[int]:
    """Exact sum of squares of each row."""
    if dev.dtype != object and len(dev) and int(np.abs(dev).max()) ** 2 * dev.shape[1] < 2**62:
        return (dev * dev).sum(axis=1).tolist()
    return [sum(int(v) ** 2 for v in row) for row in dev]


def _total(df: DataFrame, size: int, fn: Callable[[Iterator[pa.RecordBatch]], np.ndarray]) -> np.ndarray:
    """Sum over the tasks of an array of ``size`` doubles that ``fn`` makes
    of each task's batches."""

    @tidy_batches
    def part(batches):
        first = next(batches, None)
        if first is not None:  # a task without rows sends nothing
            made = fn(chain([first], batches))
            yield pa.RecordBatch.from_arrays([pa.array([made.tobytes()], pa.binary())], names=["m"])

    @tidy_batches
    def add(batches):
        held = None
        for batch in batches:
            for m in batch.column(0):
                own = np.frombuffer(m.as_buffer(), np.float64)
                held = own.copy() if held is None else held + own
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(held)], names=["at", "v"])

    parts = df.mapInArrow(part, "m binary").withColumn("fan", F.floor(F.spark_partition_id() / _FAN_IN))
    sums = parts.repartition("fan").select("m").mapInArrow(add, "at bigint, v double").groupBy("at").agg(F.sum("v").alias("v"))
    out = np.zeros(size)
    found = sums.toArrow()
    out[found.column("at").to_numpy()] = found.column("v").to_numpy()
    return out


def _unpack(packed: np.ndarray, d: int) -> np.ndarray:
    full = np.zeros((d, d))
    full[np.triu_indices(d)] = packed
    return full + np.triu(full, 1).T


def eigenvectors(v: np.ndarray, *, steps: int = 40) -> tuple[np.ndarray, np.ndarray, int]:
    """Eigenvalues (falling) and unit eigenvectors (columns) of a symmetric
    matrix: float32 vectors, refined in numpy's extended precision (double
    where the machine has none); and the steps that took."""
    d = len(v)
    size = float(np.abs(v).max(initial=0.0))
    if size == 0:
        return np.zeros(d), np.eye(d), 0
    a = v.astype(np.longdouble) / size
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(np.longdouble)
    eye = np.eye(d, dtype=np.longdouble)
    norm_a = float(np.linalg.norm(a.astype(np.float64), 2))
    rounding = 16 * d * float(np.finfo(np.longdouble).eps) * norm_a
    norm = lambda m: np.linalg.norm(m.astype(np.float64))
    best, done = np.inf, 0
    for done in range(1, steps + 1):
        r = eye - x.T @ x
        s = x.T @ (a @ x)
        s = (s + s.T) / 2
        value = np.diag(s) / (1 - np.diag(r))
        near = 2 * (norm(s - np.diag(value)) + norm_a * norm(r))
        exact = near <= rounding
        near = max(near, 4 * np.finfo(np.float64).eps * norm_a)  # closer ones are equal as far as a matrix of doubles tells
        gap = value[None, :] - value[:, None]
        apart = np.abs(gap) > near
        e = np.where(apart, (s + value[None, :] * r) / np.where(apart, gap, 1), r / 2)
        x = x + x @ e
        order = np.argsort(-value, kind="stable")
        x, value = x[:, order], value[order]
        for group in np.split(np.arange(d), np.flatnonzero(-np.diff(value) > near) + 1):
            if len(group) > 1 and not exact:  # a sub-solve about the cluster's middle
                own = x[:, group]
                small = own.T @ (a @ own - value[group].mean() * own)
                if np.abs(small - np.diag(np.diag(small))).max() > rounding:
                    turn = np.linalg.eigh(((small + small.T) / 2).astype(np.float64))[1]
                    x[:, group] = own @ turn[:, ::-1].astype(np.longdouble)
        change = float(np.abs(e).max())
        if exact or change <= 1e-17 or (apart | (eye > 0)).all() and change >= best / 2:
            break
        best = change
    for _ in range(2):  # what the last step took off orthogonality
        x = x + x @ (eye - x.T @ x) / 2
    value = (x * (a @ x)).sum(axis=0) * size
    order = np.argsort(-value, kind="stable")
    return value[order].astype(np.float64), x[:, order].astype(np.float64), done


def whiten(df: DataFrame, *, components: int = 32, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row for each remaining vector: its key, ``n``, ``deviation`` (exact,
    as decimal), ``whitened`` (up to ``components`` values, by falling
    eigenvalue), ``explained`` (each component's share of the trace) and
    ``identity_error`` (one value: the largest entry of the covariance of
    ``whitened`` less the identity)."""
    rows = df.select(F.col(id_col).alias("key"), F.col(vector_col).alias("v"))
    schema = f"key {rows.schema['key'].dataType.simpleString()}, n bigint, deviation decimal(38,0), whitened array<double>, explained array<double>, identity_error double"
    d = dimension(rows, "v")
    n, sums = _exact_sums(rows, d) if d else (0, [])
    if not n:
        return df.sparkSession.createDataFrame([], schema).withColumnRenamed("key", id_col)

    def products(of: Callable[[np.ndarray], np.ndarray], k: int):
        upper = np.triu_indices(k)

        def run(batches):
            held = np.zeros((k, k))
            for batch in batches:
                x = whole_numbers(matrix(batch.column("v"), d)[1])
                y = of(centred(deviations(x, n, sums), n))
                held += y.T @ y
            return held[upper]

        return run

    vectors = rows.select("v")
    v = _unpack(_total(vectors, d * (d + 1) // 2, products(lambda y: y, d)), d) / n
    trace = float(np.trace(v))
    values, vecs, _ = eigenvectors(v)
    k = int(np.count_nonzero(values[: min(components, d)] > _LEAST * trace)) if trace > 0 else 0
    if not k:
        return df.sparkSession.createDataFrame([], schema).withColumnRenamed("key", id_col)
    turn = vecs[:, :k] / np.sqrt(values[:k])
    # y has mean zero, and so has its image: it needs no centring of its own
    # beyond what rounding leaves, which the second sum takes off
    drift = _total(vectors, k, lambda batches: sum((centred(deviations(whole_numbers(matrix(b.column("v"), d)[1]), n, sums), n).sum(axis=0) @ turn for b in batches), np.zeros(k))) / n
    error = float(np.abs(_unpack(_total(vectors, k * (k + 1) // 2, products(lambda y: y @ turn - drift, k)), k) / n - np.eye(k)).max())
    explained = (values[:k] / trace).tolist()

    @tidy_batches
    def run(batches):
        for batch in batches:
            at, m = matrix(batch.column("v"), d)
            dev = deviations(whole_numbers(m), n, sums)
            out = centred(dev, n) @ turn
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1, dtype=np.int32) * k), pa.array(out.ravel()))
            shares = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1, dtype=np.int32) * k), pa.array(explained * len(at), pa.float64()))
            exact = pa.array([_decimal(x) for x in square_sums(dev)], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").take(pa.array(at)), pa.array([n] * len(at), pa.int64()), exact, lists, shares, pa.array([error] * len(at), pa.float64())],
                names=["key", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(run, schema).withColumnRenamed("key", id_col)


def _decimal(x: int):
    from decimal import Decimal

    return Decimal(x) if abs(x) < 10**38 else None


def _exact_sums(rows: DataFrame, d: int) -> tuple[int, list[int]]:
    """Number of vectors that take part and the sum of each dimension."""

    @tidy_batches
    def part(batches):
        n, held = 0, [0] * d
        for batch in batches:
            x = whole_numbers(matrix(batch.column("v"), d)[1])
            n += len(x)
            step = 2**62 // max(1, int(np.abs(x).max(initial=1)))  # so many entries cannot pass an int64
            for at in range(0, len(x), step):
                held = [h + s for h, s in zip(held, x[at : at + step].sum(axis=0).tolist())]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(d + 1)), pa.array([_decimal(h) for h in [n, *held]], pa.decimal128(38, 0))], names=["at", "v"])

    found = {r.at: int(r.v) for r in rows.select("v").mapInArrow(part, "at bigint, v decimal(38,0)").groupBy("at").agg(F.sum("v").alias("v")).collect()}
    return found.get(0, 0), [found.get(i + 1, 0) for i in range(d)]


def components_long(whitened: DataFrame, id_col: str = "vec_id") -> DataFrame:
    """One row for each vector and component."""
    both = F.arrays_zip("whitened", "explained")
    long = whitened.select(id_col, "n", F.col("deviation").try_cast("bigint").alias("deviation"), "identity_error", F.posexplode(both).alias("at", "pair"))
    return long.select(id_col, (F.col("at") + 1).alias("component"), "n", "deviation", F.col("pair.whitened").alias("whitened"), F.col("pair.explained").alias("explained"), "identity_error")

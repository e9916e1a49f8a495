"""Nearest neighbours by inner product: a block matrix join of int8 tiles.

Queries and candidates are dealt to tiles, a block of queries against a
stripe of candidates. In a tile every vector is its int8 rounding times a
scale, and the product of the rounded blocks gives all inner products with a
bound of their error, from the length of what rounding took off. Pairs whose
upper bound reaches the query's ``k``-th best so far are computed in double
precision from the original entries and pushed on the query's heap; at the
end the heaps of a query's stripes are merged. Nothing is missed: a pair is
left out only where its upper bound is below ``k`` scores that are known.

Equal vectors are one class that is compared once. All members of a class
have the same score and ties go to smaller keys, so of a class only the
``k + 1`` smallest keys can be among the ``k`` nearest of anything; a query
is answered with its class's list less itself.

The work is the product of queries and rows, as any exact search of a query
set is; the memory of a task is a block of queries, their heaps and one batch
of candidates. Tiles number at most ``STRIPES`` for a block of queries, so a
query's merge reads at most ``STRIPES`` heaps.

Defined cases: a row whose vector is null, empty, zero or holds null or
non-finite entries, or whose key is null, takes no part; vectors of different
length do not meet; rows of one key are one row, and of different vectors of
a key the one whose bytes are greatest counts; with fewer candidates than
``k`` all are returned; an empty table gives an empty result; other columns of the
input are ignored, whatever they are called; there are no texts here. Scores
add the products of entries in their order.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.llm.vectors import flat
from meterlake.llm.words import tidy_batches
from meterlake.session import checkpoint_root

QUERY_BLOCK, CANDIDATE_BLOCK, STRIPES = 8192, 8192, 512
_QUERIES_AT_ONCE, _CANDIDATES_AT_ONCE = 1024, 2048


def quantised(m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 rows, the scale of each, the length of the rounded vector and the
    length of what rounding took off."""
    scale = np.maximum(np.abs(m).max(axis=1) / 127, np.finfo(np.float64).tiny)
    units = m / scale[:, None]
    q = np.clip(np.rint(units), -127, 127).astype(np.int8)
    return q, scale, scale * np.linalg.norm(q, axis=1), scale * np.linalg.norm(units - q, axis=1)


def tile_bounds(a: tuple, b: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Inner products of all rounded pairs, and how far the true ones may be
    off: with v = v' + r, |v.u - v'.u'| <= |v'||r_u| + |r_v||u'| + |r_v||r_u|."""
    (qa, sa, na, ra), (qb, sb, nb, rb) = a, b
    exact = np.float32 if 127 * 127 * qa.shape[1] < 2**24 else np.float64  # sums of int8 products stay whole numbers
    product = (qa.astype(exact) @ qb.T.astype(exact)) * sa[:, None] * sb[None, :]
    # the lengths, and the double-precision score itself, are rounded too
    off = (np.outer(na, rb) + np.outer(ra, nb) + np.outer(ra, rb)) * (1 + 1e-9) + np.outer(na + ra, nb + rb) * (4e-16 * (qa.shape[1] + 8))
    return product, off


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner product of each pair of rows, entries added in order."""
    out = np.zeros(len(a))
    for j in range(a.shape[1]):
        out += a[:, j] * b[:, j]
    return out


class _Block:
    """A block of queries with a heap of the ``k`` best classes for each.
    Heap items are (score, -smallest key, class's keys): the least is the
    first to go."""

    def __init__(self, keys: list[bytes], m: np.ndarray, k: int):
        self.keys, self.m, self.k = keys, m, k
        self.q = quantised(m)
        self.heaps: list[list[tuple]] = [[] for _ in keys]
        self.floor = np.full(len(keys), -np.inf)

    def meet(self, ids: list[list[int]], m: np.ndarray) -> None:
        b = quantised(m)
        for at in range(0, len(self.keys), _QUERIES_AT_ONCE):
            part = slice(at, at + _QUERIES_AT_ONCE)
            product, off = tile_bounds(tuple(x[part] for x in self.q), b)
            low = product - off
            if low.shape[1] >= self.k:  # k classes are known to score this much
                self.floor[part] = np.maximum(self.floor[part], np.partition(low, -self.k, axis=1)[:, -self.k])
            i, j = np.nonzero(product + off >= self.floor[part, None])
            for s in range(0, len(i), 1 << 16):
                x, y = i[s : s + (1 << 16)] + at, j[s : s + (1 << 16)]
                for query, which, score in zip(x.tolist(), y.tolist(), scores(self.m[x], m[y]).tolist()):
                    heap, item = self.heaps[query], (score, -ids[which][0], ids[which])
                    if len(heap) < self.k:
                        heapq.heappush(heap, item)
                    elif item[:2] > heap[0][:2]:
                        heapq.heapreplace(heap, item)
            for query in np.unique(i + at).tolist():
                if len(self.heaps[query]) == self.k:
                    self.floor[query] = max(self.floor[query], self.heaps[query][0][0])

    def rows(self) -> Iterator[tuple[bytes, float, list[int]]]:
        for key, heap in zip(self.keys, self.heaps):
            for score, _, ids in heap:
                yield key, score, ids


def _doubles(rows: list[bytes], dim: int) -> np.ndarray:
    """Vectors from their bytes, of four or of eight an entry."""
    kind = np.float32 if len(rows[0]) == 4 * dim else np.float64
    return np.frombuffer(b"".join(rows), kind).reshape(-1, dim).astype(np.float64)


def _named(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id`` of every key that takes part, with ``v`` (its vector's bytes),
    ``key`` (their name) and ``dim``."""
    element = df.schema[vector_col].dataType.elementType
    kind = np.float32 if isinstance(element, T.FloatType) else np.float64

    @tidy_batches
    def run(batches):
        for batch in batches:
            values, begin, sizes = flat(batch.column("v"))
            finite = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
            some = np.concatenate([[0], np.cumsum(values != 0)])
            end = begin + np.maximum(sizes, 0)
            good = np.flatnonzero((sizes > 0) & (finite[end] == finite[begin]) & (some[end] > some[begin]))
            values = (values + 0.0).astype(kind)  # -0.0 is 0.0
            raw = [values[b:e].tobytes() for b, e in zip(begin[good].tolist(), end[good].tolist())]
            names = [blake2b(r, digest_size=16).digest() for r in raw]
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.binary()), pa.array(sizes[good].astype(np.int32)), pa.array(raw, pa.binary()), batch.column("id").take(pa.array(good))],
                names=["key", "dim", "v", "id"],
            )

    rows = df.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).alias("v"))
    one = rows.mapInArrow(run, "key binary, dim int, v binary, id bigint").groupBy("id").agg(F.max(F.struct("v", "key", "dim")).alias("row"))
    return one.select("id", "row.*")


def nearest(df: DataFrame, asked: Column, *, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest other rows of each
    row for which ``asked`` (a condition on its key) holds."""
    checkpoint_root(df.sparkSession)
    rows = _named(df, id_col, vector_col).checkpoint()
    nth = F.row_number().over(Window.partitionBy("key").orderBy("id"))
    few = rows.withColumn("nth", nth).where(F.col("nth") <= k + 1)
    classes = few.groupBy("key").agg(F.first("dim").alias("dim"), F.first("v").alias("v"), F.sort_array(F.collect_list("id")).alias("ids")).checkpoint()
    asking = rows.select(F.col("id").alias(id_col), "key").where(asked).withColumnRenamed(id_col, "query_id")
    return _answers(_searched(classes, asking, k), asking, k)


def _searched(classes: DataFrame, asking: DataFrame, k: int) -> DataFrame:
    """``key`` of each class that is asked for, and the ``k + 1`` nearest rows
    of all, its own among them, as ``found``: (score, id), nearest first."""
    queries = classes.join(asking.select("key").distinct(), "key", "left_semi").select("key", "dim", "v")
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    stripes = min(STRIPES, max(1, -(-classes.count() // CANDIDATE_BLOCK)))
    place = lambda n, salt: F.pmod(F.xxhash64("key", F.lit(salt)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    none = F.lit(None).cast("array<bigint>")
    left = queries.select("dim", place(blocks, 1).alias("block"), every(stripes).alias("stripe"), F.lit(0).alias("side"), "key", "v", none.alias("ids"))
    right = classes.select("dim", every(blocks).alias("block"), place(stripes, 2).alias("stripe"), F.lit(1).alias("side"), F.lit(None).cast("binary").alias("key"), "v", "ids")
    # work, not bytes, decides how tiles are spread, so their number is given
    tasks = min(4 * blocks * stripes, 1 << 16)
    tiles = left.union(right).repartition(tasks, "dim", "block", "stripe").sortWithinPartitions("dim", "block", "stripe", "side")

    @tidy_batches
    def run(batches):
        now, keys, raw, block = None, [], [], None

        def out():
            found = list(block.rows()) if block else []
            for s in range(0, len(found), 10_000):
                yield pa.RecordBatch.from_pylist([dict(zip(("key", "score", "ids"), f)) for f in found[s : s + 10_000]], schema=_FOUND)

        for batch in batches:
            where = np.stack([batch.column(c).to_numpy() for c in ("dim", "block", "stripe", "side")], axis=1)
            cuts = np.flatnonzero(np.any(where[1:] != where[:-1], axis=1)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                if a == b:
                    continue
                tile, side, piece = tuple(where[a, :3].tolist()), where[a, 3], batch.slice(a, b - a)
                if tile != now:
                    yield from out()
                    now, keys, raw, block = tile, [], [], None
                if side == 0:
                    keys += piece.column("key").to_pylist()
                    raw += piece.column("v").to_pylist()
                    continue
                if block is None:
                    block = _Block(keys, _doubles(raw, now[0]), k + 1) if keys else False
                    raw = []
                for s in range(0, piece.num_rows if block else 0, _CANDIDATES_AT_ONCE):
                    some = piece.slice(s, _CANDIDATES_AT_ONCE)
                    block.meet(some.column("ids").to_pylist(), _doubles(some.column("v").to_pylist(), now[0]))
        yield from out()

    best = tiles.mapInArrow(run, "key binary, score double, ids array<bigint>")

    def merge(t: pa.Table) -> pa.Table:
        keys, score, ids = (t.column(c).to_pylist() for c in ("key", "score", "ids"))
        top = heapq.nsmallest(k + 1, ((-s, i) for s, own in zip(score, ids) for i in own))
        return pa.table({"key": [keys[0]], "found": [[{"score": -s, "id": i} for s, i in top]]}, schema=_MERGED)

    return best.groupBy("key").applyInArrow(merge, "key binary, found array<struct<score: double, id: bigint>>")


_FOUND = pa.schema([("key", pa.binary()), ("score", pa.float64()), ("ids", pa.list_(pa.int64()))])
_MERGED = pa.schema([("key", pa.binary()), ("found", pa.list_(pa.struct([("score", pa.float64()), ("id", pa.int64())])))])


def _answers(searched: DataFrame, asking: DataFrame, k: int) -> DataFrame:
    others = F.slice(F.filter("found", lambda x: x["id"] != F.col("query_id")), 1, k)
    ranked = asking.join(searched, "key").select("query_id", F.posexplode(others).alias("at", "hit"))
    return ranked.select("query_id", (F.col("at") + 1).alias("rank"), F.col("hit.id").alias("vec_id"), F.col("hit.score").alias("score"))

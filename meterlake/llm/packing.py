"""Best-fit packing of token pieces into sequences of fixed capacity.

The plan depends on how many pieces have each length, and on nothing else,
so it is made from a histogram of at most ``capacity`` rows whatever the
number of documents. Pieces above a third of the capacity go first: at most
two of them share a sequence, and the largest is matched with the largest
that still fits. Smaller ones, in descending length, go where the least gap
remains that holds them. Sequences that are filled alike form one group, so
the plan has a few thousand groups at most.

Pieces are then numbered within their length (in salted groups, so that a
length that a third of all pieces share is still dealt over many tasks) and
find their sequence and offset from the plan by that number.

Defined cases: a null or empty text is a piece of the end id alone; rows may
repeat; an empty table gives no pieces.
"""

from __future__ import annotations

import bisect
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from meterlake.llm.encode import encoder
from meterlake.llm.words import pieces as slices
from meterlake.llm.words import tidy_batches
from meterlake.session import checkpoint_root

_PIECE = [("piece", T.IntegerType()), ("start", T.LongType()), ("length", T.LongType()), ("ids_crc32", T.LongType())]


class _Group:
    """``n`` sequences filled alike: ``slots`` are (length, first number of
    that length, pieces a sequence, offset)."""

    def __init__(self, n: int, gap: int, slots: list[tuple[int, int, int, int]]):
        self.n, self.gap, self.slots = n, gap, slots

    def cut(self, k: int) -> _Group:
        """Set the first ``k`` sequences apart and return them."""
        head = _Group(k, self.gap, list(self.slots))
        self.slots = [(length, first + k * q, q, offset) for length, first, q, offset in self.slots]
        self.n -= k
        return head


def plan(histogram: dict[int, int], capacity: int) -> np.ndarray:
    """Rows (length, first number, last number, pieces a sequence, first
    sequence, offset), sorted by length and number."""
    left = {length: n for length, n in histogram.items() if n > 0}
    taken = dict.fromkeys(left, 0)
    groups: list[_Group] = []

    def take(length: int, n: int) -> int:
        first = taken[length]
        taken[length] += n
        left[length] -= n
        return first

    large = sorted(length for length in left if 3 * length > capacity)
    while large:
        a = large[-1]
        i = bisect.bisect_right(large, capacity - a) - 1
        b = large[i] if i >= 0 else None
        if b is None:
            n = left[a]
            groups.append(_Group(n, capacity - a, [(a, take(a, n), 1, 0)]))
        elif b == a and left[a] == 1:
            groups.append(_Group(1, capacity - a, [(a, take(a, 1), 1, 0)]))
        elif b == a:
            n = left[a] // 2
            groups.append(_Group(n, capacity - 2 * a, [(a, take(a, 2 * n), 2, 0)]))
        else:
            n = min(left[a], left[b])
            groups.append(_Group(n, capacity - a - b, [(a, take(a, n), 1, 0), (b, take(b, n), 1, a)]))
        large = [x for x in large if left[x]]

    by_gap: dict[int, list[_Group]] = {}
    for g in groups:
        by_gap.setdefault(g.gap, []).append(g)
    gaps = sorted(by_gap)

    def put(g: _Group) -> None:
        if g.gap not in by_gap:
            bisect.insort(gaps, g.gap)
        by_gap.setdefault(g.gap, []).append(g)

    def fill(g: _Group, length: int, q: int) -> None:
        g.slots.append((length, take(length, q * g.n), q, capacity - g.gap))
        g.gap -= q * length
        put(g)

    for length in sorted((x for x in left if left[x]), reverse=True):
        while left[length]:
            i = bisect.bisect_left(gaps, length)
            if i == len(gaps):
                put(_Group(-(-left[length] // (capacity // length)), capacity, []))
                continue
            gap = gaps[i]
            g = by_gap[gap].pop()
            if not by_gap[gap]:
                del by_gap[gap]
                gaps.pop(i)
            q = gap // length
            whole = min(g.n, left[length] // q)
            if not whole:  # fewer pieces are left than one sequence holds
                whole, q = 1, left[length]
            if whole < g.n:
                head = g.cut(whole)
                put(g)
                g = head
            fill(g, length, q)

    rows, sequence = [], 0
    for g in (g for held in by_gap.values() for g in held if g.slots):
        rows += [(length, first, first + q * g.n, q, sequence, offset) for length, first, q, offset in g.slots]
        sequence += g.n
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 6)


def cut(docs: DataFrame, *, tokenizer: str, end_id: int, capacity: int, id_col: str = "doc_id", text_col: str = "text", ids: bool = False) -> DataFrame:
    """One row a piece: the key, ``piece``, ``start``, ``length``,
    ``ids_crc32`` and, with ``ids``, its ids. Only documents longer than
    ``capacity`` are cut, into pieces of that size and a rest."""
    fields = [T.StructField(id_col, docs.schema[id_col].dataType), *(T.StructField(n, t) for n, t in _PIECE)]
    fields += [T.StructField("ids", T.ArrayType(T.IntegerType()))] * ids

    @tidy_batches
    def run(batches):
        enc = encoder(tokenizer)
        for batch in batches:
            for part in slices(batch, text_col, 1 << 20):
                flat, offsets = enc.encode(part.column(text_col))
                flat = np.insert(flat, offsets[1:], end_id).astype("<u4")
                lens = np.diff(offsets) + 1
                n = -(-lens // capacity)
                doc = np.repeat(np.arange(part.num_rows), n)
                piece = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                start = piece * capacity
                length = np.minimum(capacity, lens[doc] - start)
                at = (np.cumsum(lens) - lens)[doc] + start
                raw = memoryview(flat.tobytes())
                crc = [zlib.crc32(raw[4 * a : 4 * (a + k)]) for a, k in zip(at.tolist(), length.tolist())]
                cols = [part.column(id_col).take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(crc, pa.int64())]
                if ids:
                    cols.append(pa.ListArray.from_arrays(pa.array(np.append(at, len(flat)), pa.int32()), pa.array(flat.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(cols, names=[f.name for f in fields])

    return docs.select(id_col, text_col).mapInArrow(run, T.StructType(fields))


def pack(pieces: DataFrame, *, capacity: int, key_cols: list[str], length_col: str = "length") -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``. They are read several
    times, so pass a table that does not change between reads."""
    spark = pieces.sparkSession
    salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = pieces.drop("sequence_id", "offset").withColumn("__salt", F.pmod(F.xxhash64(*key_cols), F.lit(salts)).cast("int"))
    counts = rows.groupBy(F.col(length_col).alias("__length"), F.col("__salt").alias("__s")).agg(F.count(F.lit(1)).alias("__n"))
    # at most capacity * salts rows, however many pieces there are
    before = Window.partitionBy("__length").orderBy("__s").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    histogram = {r[0]: r[1] for r in counts.groupBy("__length").agg(F.sum("__n")).collect()}
    held = spark.sparkContext.broadcast(plan(histogram, capacity))

    own = Window.partitionBy(length_col, "__salt").orderBy(*key_cols)
    numbered = rows.withColumn("__own", F.row_number().over(own) - 1)
    numbered = numbered.join(counts.drop("__n"), (F.col(length_col) == F.col("__length")) & (F.col("__salt") == F.col("__s")))
    numbered = numbered.withColumn("__number", F.col("__own") + F.col("__before")).drop("__salt", "__own", "__length", "__s", "__before")
    kept = [c for c in numbered.columns if c != "__number"]
    schema = T.StructType([*(numbered.schema[c] for c in kept), T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    @tidy_batches
    def run(batches):
        table = held.value
        wide = int(table[:, 2].max(initial=0)) + 1
        keys = table[:, 0] * wide + table[:, 1]
        for batch in batches:
            length = batch.column(length_col).to_numpy(zero_copy_only=False).astype(np.int64)
            number = batch.column("__number").to_numpy(zero_copy_only=False)
            slot = table[np.searchsorted(keys, length * wide + number, side="right") - 1]
            nth, own = np.divmod(number - slot[:, 1], slot[:, 3])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(slot[:, 4] + nth), pa.array(slot[:, 5] + own * length)], names=[*kept, "sequence_id", "offset"])

    return numbered.mapInArrow(run, schema)


def pack_documents(docs: DataFrame, *, tokenizer: str, end_id: int = 0, capacity: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenise, cut and pack every document; one row a piece."""
    checkpoint_root(docs.sparkSession)
    made = cut(docs, tokenizer=tokenizer, end_id=end_id, capacity=capacity, id_col=id_col, text_col=text_col).checkpoint()
    return pack(made, capacity=capacity, key_cols=[id_col, "piece", "ids_crc32"])


def sequences(docs: DataFrame, packed: DataFrame, *, tokenizer: str, end_id: int = 0, capacity: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The packed sequences themselves: sequence_id and its ids in order
    (documents with distinct keys)."""
    own = cut(docs, tokenizer=tokenizer, end_id=end_id, capacity=capacity, id_col=id_col, text_col=text_col, ids=True).select(id_col, "piece", "ids")
    placed = packed.select(id_col, "piece", "sequence_id", "offset").join(own, [id_col, "piece"])
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))  # at most capacity ids
    return placed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p.ids)).alias("ids"))

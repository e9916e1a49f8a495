"""Token files: ids in fixed-width bit packing, in ascending document order.

A file set is a folder with two Parquet tables. ``blocks`` holds rows of
whole documents: the shard and block number, the ids before the block in its
shard, the documents' keys and lengths, the bit width and the packed ids (id
i of a block occupies bits ``i * width`` to ``(i + 1) * width``, least
significant first). ``shards`` holds each shard's first id in the whole set.
The width is the least that the vocabulary needs; any id or range of ids is
found from the offsets alone and unpacked with numpy.

Documents are dealt by ranges of their key, so each shard holds a run of
keys and is written by the task that has it; only one row a shard is summed
up. A lost executor's tasks are run again by Spark and write the same rows.

Defined cases: a null text has the end id only; a null key sorts first;
equal keys are ordered by text; an empty table gives an empty set.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from meterlake.llm.encode import encoder
from meterlake.llm.words import pieces, tidy_batches

BLOCK_IDS = 1 << 18
_BLOCK = "shard int, block int, first long, n_ids long, width int, keys array<bigint>, lens array<bigint>, packed binary"


def pack_bits(ids: np.ndarray, width: int) -> bytes:
    """Ids as a bit string, ``width`` bits each, least significant first."""
    if width in (8, 16, 32):
        return ids.astype(f"<u{width // 8}").tobytes()
    bits = (ids.astype(np.uint32)[:, None] >> np.arange(width, dtype=np.uint32)) & np.uint32(1)
    return np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack_bits(packed: bytes, width: int, at: int, n: int) -> np.ndarray:
    """``n`` ids from id ``at`` on."""
    if width in (8, 16, 32):
        return np.frombuffer(packed, f"<u{width // 8}", n, at * width // 8).astype(np.uint32)
    first = at * width // 8
    last = -(-(at + n) * width // 8)
    bits = np.unpackbits(np.frombuffer(packed, np.uint8, last - first, first), bitorder="little")
    skip = at * width - first * 8
    bits = bits[skip : skip + n * width].reshape(n, width).astype(np.uint32)
    return (bits << np.arange(width, dtype=np.uint32)).sum(axis=1, dtype=np.uint32)


def write_tokens(docs: DataFrame, path: str, *, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every text, append ``end_id`` and write the file set ``path``."""
    rows = docs.select(F.col(id_col).cast("long").alias("key"), F.col(text_col).alias("text"))
    dealt = rows.repartitionByRange("key").sortWithinPartitions("key", "text")

    @tidy_batches
    def run(batches):
        enc = encoder(tokenizer)
        width = max(1, int(max(enc.size - 1, end_id)).bit_length())
        shard, block, before = TaskContext.get().partitionId(), 0, 0
        held: list[tuple[list, np.ndarray, np.ndarray]] = []

        def flush():
            nonlocal block, before
            ids = np.concatenate([h[1] for h in held])
            row = [shard, block, before, len(ids), width, [k for h in held for k in h[0]], np.concatenate([h[2] for h in held]).tolist(), pack_bits(ids, width)]
            block, before = block + 1, before + len(ids)
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([x], t) for x, t in zip(row, (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()))],
                names=["shard", "block", "first", "n_ids", "width", "keys", "lens", "packed"],
            )

        for batch in batches:
            for piece in pieces(batch, "text", 1 << 20):
                ids, offsets = enc.encode(piece.column("text"))
                held.append((piece.column("key").to_pylist(), np.insert(ids, offsets[1:], end_id), np.diff(offsets) + 1))
                if sum(len(h[1]) for h in held) >= BLOCK_IDS:
                    yield flush()
        if held:
            yield flush()

    dealt.mapInArrow(run, _BLOCK).write.parquet(f"{path}/blocks")
    blocks = docs.sparkSession.read.schema(_BLOCK).parquet(f"{path}/blocks")
    # one row a shard: the number of shards is the number of tasks that wrote
    totals = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n_ids"))
    before = F.sum("n_ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    totals.select("shard", F.coalesce(before, F.lit(0)).alias("shard_first"), "n_ids").coalesce(1).write.parquet(f"{path}/shards")


def _opened(spark: SparkSession, path: str) -> DataFrame:
    blocks = spark.read.schema(_BLOCK).parquet(f"{path}/blocks")
    shards = spark.read.schema("shard int, shard_first long, n_ids long").parquet(f"{path}/shards").drop("n_ids")
    return blocks.join(F.broadcast(shards), "shard")  # one row for each file


def read_documents(spark: SparkSession, path: str, *, ids: bool = True) -> DataFrame:
    """Per document: key, start (ids before it in the set), n_tokens,
    ids_crc32 (of its ids as little-endian 32-bit integers) and, with
    ``ids``, the ids themselves."""

    @tidy_batches
    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                lens = np.array(r["lens"], np.int64)
                flat = unpack_bits(r["packed"], r["width"], 0, r["n_ids"])
                at = np.cumsum(lens) - lens
                raw = memoryview(flat.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * a : 4 * (a + n)]) for a, n in zip(at.tolist(), lens.tolist())]
                cols = [pa.array(r["keys"], pa.int64()), pa.array(at + (r["first"] + r["shard_first"])), pa.array(lens), pa.array(crc, pa.int64())]
                if ids:
                    cols.append(pa.ListArray.from_arrays(pa.array(np.append(at, r["n_ids"]), pa.int32()), pa.array(flat.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(cols, names=["key", "start", "n_tokens", "ids_crc32", "ids"][: len(cols)])

    # a block may be large: a few at a time
    schema = "key long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if ids else "")
    return _opened(spark, path).mapInArrow(run, schema)


def read_range(spark: SparkSession, path: str, start: int, n: int) -> np.ndarray:
    """Ids ``start`` to ``start + n`` of the whole set, from the blocks that
    hold them; the result is the caller's, so ``n`` is the caller's bound."""
    own = F.col("shard_first") + F.col("first")
    hit = _opened(spark, path).where((own < start + n) & (own + F.col("n_ids") > start)).select(own.alias("own"), "n_ids", "width", "packed")
    parts = []
    for r in hit.orderBy("own").toLocalIterator():
        a, b = max(start - r.own, 0), min(start + n - r.own, r.n_ids)
        parts.append(unpack_bits(bytes(r.packed), r.width, a, b - a))
    return np.concatenate(parts) if parts else np.zeros(0, np.uint32)

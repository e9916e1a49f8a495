"""Word work on Arrow batches, vectorised with numpy inside Spark tasks.

A batch of texts is treated as one UTF-8 buffer: words are runs of word
bytes, found and hashed for all texts at once. ``SPACED`` and ``ALNUM`` are
byte classes, which decide the same words as the character classes
``[^\\x20\\x09-\\x0D]+`` and ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` do on
code points, because every byte of a non-ASCII character is 0x80 or above.

Hashes have 64 bits (a polynomial over random byte values, then mixed);
equal words always have equal hashes, and different ones share a hash with
probability about 2^-64 for a pair.
"""

from __future__ import annotations

import ctypes
import inspect
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

_RNG = np.random.default_rng(0x5EED)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[65:91] = _BYTE[97:123]
_POWER = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)
_POWERS = np.cumprod(np.full(4096, _POWER, dtype=np.uint64))

SPACED = np.ones(256, dtype=bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
ALNUM_ANY_CASE = ALNUM.copy()
ALNUM_ANY_CASE[0x41:0x5B] = True

PIECE_BYTES = 2 << 20


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * _MIX
    h = (h ^ (h >> np.uint64(27))) * _MIX2
    return h ^ (h >> np.uint64(31))


@dataclass
class Words:
    """The words of a batch of texts, in order. ``first`` has one more entry
    than there are texts: text i holds words ``first[i]:first[i + 1]``."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    first: np.ndarray
    hash: np.ndarray

    def last(self) -> np.ndarray:
        """For each word, the index just past the last word of its text."""
        return self.first[self.doc + 1]

    def ngrams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the k words from each word on, and whether the text has
        that many left. The arrays are as long as the words."""
        n = len(self.hash)
        out = np.full(n, k, dtype=np.uint64)
        for j in range(k):
            shifted = np.zeros(n, dtype=np.uint64)
            shifted[: max(n - j, 0)] = self.hash[j:]
            out = mix(out ^ shifted) + _POWER
        return out, np.arange(n) + k <= self.last()


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the offset of each; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = pa.concat_arrays([c.cast(pa.large_string()) for c in texts.chunks]) if texts.num_chunks else pa.array([], pa.large_string())
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = texts.buffers()
    offsets = np.frombuffer(offs, dtype=np.int64, count=texts.offset + n + 1)[texts.offset :]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def words_of(texts: pa.Array, member: np.ndarray, lower: bool) -> Words:
    """Words of every text: runs of bytes in ``member``. With ``lower``,
    A-Z hash as a-z (the bytes in ``data`` stay as they are)."""
    data, offsets = buffers(texts)
    inside = member[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    begins[edges] = inside[edges]
    ends[edges - 1] = inside[edges - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    doc = np.searchsorted(offsets, start, side="right") - 1
    first = np.searchsorted(start, offsets, side="left")
    if len(start):
        lens = end - start
        at = np.cumsum(lens) - lens
        kind = np.int32 if len(data) < 1 << 31 else np.int64  # these arrays are the largest of a worker
        rel = np.arange(int(lens.sum()), dtype=kind) - np.repeat(at.astype(kind), lens)
        powers = _POWERS if int(lens.max()) <= len(_POWERS) else np.cumprod(np.full(int(lens.max()), _POWER, dtype=np.uint64))
        table = _BYTE_LOWER if lower else _BYTE
        of_byte = table[data[inside]]
        of_byte *= powers[rel]
        hashes = mix(np.add.reduceat(of_byte, at))
    else:
        hashes = np.zeros(0, np.uint64)
    return Words(data, start, end, doc, first, hashes)


def pieces(batch: pa.RecordBatch | pa.Table, text_col: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of whole rows with about ``limit`` bytes of text each, so that
    the arrays of a slice stay small (a longer single text is one slice)."""
    if not batch.num_rows:
        return
    _, offsets = buffers(batch.column(text_col))
    at = 0
    while at < batch.num_rows:
        to = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        to = min(max(to, at + 1), batch.num_rows)
        yield batch.slice(at, to - at)
        at = to


def ragged(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Concatenation of ``arange(s, s + l)`` for each pair."""
    total = int(lens.sum())
    at = np.cumsum(lens) - lens
    return np.arange(total, dtype=np.int64) + np.repeat(starts - at, lens)


def give_back() -> None:
    """Return freed memory to the system. Spark keeps its Python workers
    between tasks, and what they hold free counts against the executor."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # another C library than glibc
        pass


def tidy(fn: Callable) -> Callable:
    """A function of one group or of two cogroups, for ``applyInArrow``, that
    gives back its memory after each, and before it that of the last result,
    which Spark still held then."""

    def one(table):
        give_back()
        try:
            return fn(table)
        finally:
            give_back()

    def two(left, right):
        give_back()
        try:
            return fn(left, right)
        finally:
            give_back()

    return one if len(inspect.signature(fn).parameters) == 1 else two


def tidy_batches(run: Callable) -> Callable:
    """A function of batches, for ``mapInArrow``, that gives back its memory
    when the task ends."""

    def whole(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return whole


def add_columns(
    df: DataFrame, text_col: str, fields: list[T.StructField], fn: Callable[[pa.RecordBatch], dict[str, pa.Array]], keep: list[str] | None = None
) -> DataFrame:
    """``df`` (or its columns ``keep``) with columns computed from batches of
    its rows; input columns of the same name are replaced."""
    names = [f.name for f in fields]
    kept = [c for c in (keep if keep is not None else df.columns) if c not in names]
    schema = T.StructType([df.schema[c] for c in kept] + fields)
    source = df.select(*dict.fromkeys([*(f"`{c}`" for c in kept), f"`{text_col}`"]))

    @tidy_batches
    def run(batches):
        for batch in batches:
            for piece in pieces(batch, text_col):
                made = fn(piece)
                yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in kept), *(made[n] for n in names)], names=[*kept, *names])

    return source.mapInArrow(run, schema)

"""Document fingerprints by consistent weighted sampling.

The terms of a text are its words (A-Z lower-cased), weighted by how often
they occur. For each of ``samples`` sample numbers every term draws two
gamma(2, 1) values and one uniform value from its hash; with them its weight
is quantised consistently, and the term with the least arrival is taken. Two
texts take the same term at the same quantum with a probability equal to
their generalised Jaccard similarity, the sum of the lesser weights over the
sum of the greater ones. A fingerprint is 16 bits of each sample, in hex, so
the share of equal samples estimates that similarity (standard error at most
0.5 / sqrt(samples)).

Within a slice of texts, each distinct pair of term and weight is drawn
once, and every text takes the least of its rows.

Defined cases: texts without words (null, empty, blank) have the empty
fingerprint; two empty fingerprints are alike (1.0), an empty and another
one are not (0.0).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from meterlake.llm.words import SPACED, add_columns, mix, words_of

SAMPLES = 64
SLICE_BYTES = 4 << 20
_seed = np.random.default_rng(77)
_MUL = _seed.integers(0, 2**63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PAIRS_AT_ONCE = 1 << 13


def _draws(term: np.ndarray, weight: np.ndarray, samples: int) -> np.ndarray:
    """For each pair of term and weight, and each sample: the arrival as
    sortable bits in the upper half, the sample's name in the lower half."""
    out = np.empty((len(term), samples), np.uint64)
    for at in range(0, len(term), _PAIRS_AT_ONCE):
        t, w = term[at : at + _PAIRS_AT_ONCE, None], weight[at : at + _PAIRS_AT_ONCE, None]
        x, y = mix(t * _MUL[0, :samples]), mix(t * _MUL[1, :samples])
        u = lambda bits, n: (bits.astype(np.float32) + np.float32(0.5)) * np.float32(2.0**-n)
        low = lambda bits, n: bits & np.uint64((1 << n) - 1)
        r = np.maximum(-np.log(u(x >> np.uint64(32), 32) * u(low(x, 32), 32)), np.float32(1e-6))
        c = np.maximum(-np.log(u(y >> np.uint64(43), 21) * u(low(y >> np.uint64(22), 21), 21)), np.float32(1e-6))
        beta = u(low(y, 22), 22)
        quantum = np.floor(np.log(w) / r + beta)
        arrival = (np.log(c) - r * (quantum - beta) - r).view(np.int32)
        # order of floats as order of unsigned integers
        sortable = np.where(arrival < 0, ~arrival, arrival | np.int32(-(2**31))).view(np.uint32).astype(np.uint64)
        name = mix(t ^ (quantum.astype(np.int64).view(np.uint64) * _MUL[1, :1])) >> np.uint64(48)
        out[at : at + _PAIRS_AT_ONCE] = (sortable << np.uint64(32)) | name
    return out


def fingerprints(texts: pa.Array, samples: int = SAMPLES) -> tuple[np.ndarray, np.ndarray]:
    """A row of 16-bit sample names for each text, and which texts have words."""
    w = words_of(texts, SPACED, lower=True)
    n = len(w.first) - 1
    some = np.diff(w.first) > 0
    out = np.zeros((n, samples), np.uint16)
    if not some.any():
        return out, some
    order = np.lexsort((w.hash, w.doc))
    doc, term = w.doc[order], w.hash[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (term[1:] != term[:-1])
    begin = np.flatnonzero(new)
    weight = np.diff(np.append(begin, len(doc)))
    doc, term = doc[begin], term[begin]
    _, first, inverse = np.unique(mix(term + weight.astype(np.uint64)), return_index=True, return_inverse=True)
    drawn = _draws(term[first], weight[first].astype(np.float32), samples)
    starts = np.flatnonzero(np.diff(np.concatenate([[-1], doc])))
    stops = np.append(starts[1:], len(doc))
    row = np.flatnonzero(some)
    at = 0
    while at < len(row):  # some thousand rows at a time stay in the cache
        to = max(at + 1, int(np.searchsorted(stops, starts[at] + 16384, side="right")))
        part = drawn[inverse[starts[at] : stops[to - 1]]]
        out[row[at:to]] = (np.minimum.reduceat(part, starts[at:to] - starts[at], axis=0) & np.uint64(0xFFFF)).astype(np.uint16)
        at = to
    return out, some


def likeness(a: np.ndarray, a_some: np.ndarray, b: np.ndarray, b_some: np.ndarray) -> np.ndarray:
    """Share of equal samples, row by row."""
    return np.where(a_some & b_some, (a == b).mean(axis=1), (a_some == b_some).astype(np.float64))


def _hex(rows: np.ndarray, some: np.ndarray) -> list[str]:
    raw, width = rows.astype(">u2").tobytes().hex(), rows.shape[1] * 4
    return [raw[i * width : (i + 1) * width] if s else "" for i, s in enumerate(some)]


def fingerprint(docs: DataFrame, *, text_col: str = "text", samples: int = SAMPLES) -> DataFrame:
    """``docs`` with a column ``fingerprint``; nothing is shuffled."""

    def run(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        return {"fingerprint": pa.array(_hex(*fingerprints(batch.column(text_col), samples)), pa.string())}

    return add_columns(docs, text_col, [T.StructField("fingerprint", T.StringType())], run)


def edit_report(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", samples: int = SAMPLES, bucket_bytes: int = 16 << 20, max_buckets: int = 4096) -> DataFrame:
    """Fingerprints of every text and of its edited text, whose last third
    is replaced by as much of the next document's beginning.

    The next document is the one after it in descending key order (equal
    keys by text; rows without a key last), and the first one after the
    last. Documents are dealt by key ranges and read in order by streaming
    tasks; the first document of each range is also sent to the range before
    it, so no task sees more than its range and one row.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63))).alias("key"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size = rows.select(F.sum(F.octet_length("text"))).first()[0] or 0
    count = int(min(max_buckets, size // bucket_bytes + 1))
    cuts = np.unique(np.array(rows.approxQuantile("key", [i / count for i in range(1, count)], 0.2 / count) if count > 1 else [], dtype=np.float64).astype(np.int64))

    @F.pandas_udf("int")
    def bucket_of(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, key.to_numpy(), side="right").astype(np.int32))

    dealt = rows.withColumn("bucket", bucket_of("key"))
    # at most one row a bucket
    tops = sorted((r.bucket, r.top) for r in dealt.select("bucket", "key").groupBy("bucket").agg(F.max("key").alias("top")).collect())
    before = {top: tops[(i + 1) % len(tops)][0] for i, (_, top) in enumerate(tops)}

    @F.pandas_udf("int")
    def also_in(key: pd.Series) -> pd.Series:
        return key.map(before).astype("Int32")

    both = dealt.withColumn("also", also_in("key"))
    place = F.array(F.struct(F.col("bucket").alias("bucket"), F.lit(0).alias("extra")), F.struct(F.col("also").alias("bucket"), F.lit(1).alias("extra")))
    placed = both.select("id", "key", "text", F.explode(F.filter(place, lambda p: p.bucket.isNotNull())).alias("p")).select("id", "key", "text", "p.bucket", "p.extra")
    lined = placed.repartition("bucket").sortWithinPartitions("bucket", "extra", F.desc("key"), "text").select("id", "text", "bucket", "extra")
    names = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def judge(ids: list, texts: list[str]) -> pa.RecordBatch:
        """``texts`` has one more entry than ``ids``: the next text."""
        thirds = [len(t) // 3 for t in texts[:-1]]
        edited = [t[: len(t) - k] + n[:k] for t, n, k in zip(texts, texts[1:], thirds)]
        own, some = fingerprints(pa.array(texts, pa.large_string()), samples)
        new, new_some = fingerprints(pa.array(edited, pa.large_string()), samples)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(ids), pa.array([len(t) for t in texts[:-1]], pa.int64()), pa.array([hashlib.sha256(t.encode("utf-8")).hexdigest() for t in edited]),
                pa.array(_hex(own[:-1], some[:-1]), pa.string()), pa.array(_hex(new, new_some), pa.string()),
                pa.array(likeness(own[:-1], some[:-1], new, new_some)), pa.array(likeness(own[:-1], some[:-1], own[1:], some[1:])),
            ],
            names=names,
        )

    id_type = docs.schema[id_col].dataType

    def run(batches):
        ids: list = []
        texts: list[str] = []
        now, held = None, 0
        kind = to_arrow_type(id_type)
        ended = True
        for batch in batches:
            for i, text, bucket, extra in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), batch.column("bucket").to_pylist(), batch.column("extra").to_pylist()):
                if bucket != now:
                    ids, texts, now, held, ended = [], [], bucket, 0, False
                if ended:  # rows after the first extra one
                    continue
                texts.append(text)
                if extra:
                    ended = True
                    made = judge(ids, texts)
                elif held >= SLICE_BYTES:
                    made = judge(ids, texts)
                    ids, texts, held = [i], [text], len(text)
                else:
                    ids.append(i)
                    held += len(text)
                    continue
                yield made.set_column(0, "id", made.column(0).cast(kind))

    schema = T.StructType([
        T.StructField("id", id_type), T.StructField("n_chars", T.LongType()), *(T.StructField(n, T.StringType()) for n in names[2:5]), *(T.StructField(n, T.DoubleType()) for n in names[5:]),
    ])
    return lined.mapInArrow(run, schema).withColumnRenamed("id", id_col)

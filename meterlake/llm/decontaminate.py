"""Benchmark decontamination by a prefix-filtered join with exact windows.

A window is ``window`` consecutive words of a benchmark item (the whole item
if it has fewer words). Every window must be contained in a document as it
stands, so of its shingles, ordered by how rare they are in all documents,
the rarest one is a necessary prefix: a document that lacks it cannot hold
the window. Documents are joined to windows on that prefix shingle alone;
the place of the shingle in the window and the length of the document bound
where the window can lie, and there each of its words is compared.

The rarity counts cover every document. The benchmark is taken in chunks of
at most ``chunk_bytes`` of text, each broadcast and joined in turn, so that
what a task holds has a fixed bound and a larger benchmark is still searched
whole. Documents are never shuffled.

Defined cases: null and empty texts have no words and no windows; a null
item id counts as the empty string; rows may repeat (each is judged); an
empty benchmark hits nothing; input columns named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.llm.words import ALNUM_ANY_CASE, Words, add_columns, pieces, ragged, words_of

SHINGLE = 3
_SPAN = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def _chunks(items: DataFrame, chunk_bytes: int) -> Iterator[tuple[list[str], list[str]]]:
    ids, texts, size = [], [], 0
    for row in items.toLocalIterator():
        if row.text is None:
            continue
        ids.append("" if row.item is None else row.item)
        texts.append(row.text)
        size += len(row.text)
        if size >= chunk_bytes:
            yield ids, texts
            ids, texts, size = [], [], 0
    yield ids, texts


def _windows(w: Words, window: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By window length: the words' hashes (a row each) and the item."""
    by_len: dict[int, list[tuple[int, int]]] = {}
    for item in range(len(w.first) - 1):
        a, b = int(w.first[item]), int(w.first[item + 1])
        if b > a:
            n = min(window, b - a)
            by_len.setdefault(n, []).extend((s, item) for s in range(a, b - n + 1))
    out = []
    for n, rows in sorted(by_len.items()):
        at = np.array([r[0] for r in rows], dtype=np.int64)
        out.append((w.hash[at[:, None] + np.arange(n)], at, np.array([r[1] for r in rows], dtype=np.int64)))
    return out


def _shingle_counts(docs: DataFrame, text_col: str, wanted: dict[int, np.ndarray]) -> dict[int, dict[int, int]]:
    """How often each wanted shingle (by size) occurs in all documents."""

    def run(batches):
        total = {k: np.zeros(len(v), np.int64) for k, v in wanted.items()}
        for batch in batches:
            for piece in pieces(batch, text_col):
                w = words_of(piece.column(text_col), ALNUM_ANY_CASE, lower=True)
                for k, keys in wanted.items():
                    grams, whole = w.ngrams(k)
                    at = np.minimum(np.searchsorted(keys, grams), len(keys) - 1)
                    total[k] += np.bincount(at[whole & (keys[at] == grams)], minlength=len(keys))
        for k, keys in wanted.items():
            seen = np.flatnonzero(total[k])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(seen), k), pa.int32()), pa.array(keys[seen].view(np.int64)), pa.array(total[k][seen])], names=["k", "shingle", "n"]
            )

    rows = docs.select(text_col).mapInArrow(run, "k int, shingle long, n long").groupBy("k", "shingle").agg(F.sum("n").alias("n"))
    out: dict[int, dict[int, int]] = {k: {} for k in wanted}
    for r in rows.toLocalIterator():  # at most one row for each shingle of the chunk
        out[r.k][r.shingle & 0xFFFFFFFFFFFFFFFF] = r.n
    return out


def _index(docs: DataFrame, text_col: str, texts: list[str], window: int) -> list[dict]:
    """For each window length, what a task needs to find its windows."""
    w = words_of(pa.array(texts, pa.large_string()), ALNUM_ANY_CASE, lower=True)
    groups = _windows(w, window)
    grams = {k: w.ngrams(k)[0] for k in {min(SHINGLE, h.shape[1]) for h, _, _ in groups}}
    spans = {k: np.unique(np.concatenate([grams[k][(at[:, None] + np.arange(h.shape[1] - k + 1)).ravel()] for h, at, _ in groups if min(SHINGLE, h.shape[1]) == k])) for k in grams}
    counts = _shingle_counts(docs, text_col, spans) if spans else {}
    out = []
    for hashes, at, item in groups:
        n, k = hashes.shape[1], min(SHINGLE, hashes.shape[1])
        shingles = grams[k][at[:, None] + np.arange(n - k + 1)]
        by_key = np.array([counts[k].get(int(x), 0) for x in spans[k]], dtype=np.int64)
        rarity = by_key[np.searchsorted(spans[k], shingles)]
        # rarest first, ties by the shingle's own order: one global order
        place = np.lexsort((shingles, rarity), axis=1)[:, 0]
        rows = np.arange(len(at))
        found = rarity[rows, place] > 0
        prefix, rows, place = shingles[rows, place][found], rows[found], place[found]
        order = np.argsort(prefix, kind="stable")
        keys, first, count = np.unique(prefix[order], return_index=True, return_counts=True)
        out.append({"n": n, "k": k, "keys": keys, "first": first, "count": count, "window": rows[order], "place": place[order], "hashes": hashes, "item": item})
    return [g for g in out if len(g["keys"])]


def find_windows(w: Words, index: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end word of every occurrence of a window, and its item."""
    starts, ends, items = [], [], []
    grams: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for g in index:
        if g["k"] not in grams:
            grams[g["k"]] = w.ngrams(g["k"])
        shingle, whole = grams[g["k"]]
        at = np.minimum(np.searchsorted(g["keys"], shingle), len(g["keys"]) - 1)
        hit = np.flatnonzero(whole & (g["keys"][at] == shingle))
        key = at[hit]
        pick = ragged(g["first"][key], g["count"][key])
        start = np.repeat(hit, g["count"][key]) - g["place"][pick]
        doc = np.repeat(w.doc[hit], g["count"][key])
        window = g["window"][pick]
        fits = (start >= w.first[doc]) & (start + g["n"] <= w.first[doc + 1])
        start, window = start[fits], window[fits]
        for j in range(g["n"]):
            same = w.hash[start + j] == g["hashes"][window, j]
            start, window = start[same], window[same]
        starts.append(start)
        ends.append(start + g["n"])
        items.append(g["item"][window])
    empty = np.zeros(0, np.int64)
    return tuple(np.concatenate(x) if x else empty for x in (starts, ends, items))


def decontaminate(
    docs: DataFrame, items: DataFrame, *, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    window: int = 10, chunk_bytes: int = 4 << 20, keep: list[str] | None = None,
) -> DataFrame:
    """``docs`` (or its columns ``keep``) with ``n_words``, ``n_hit``,
    ``item_ids`` (sorted as strings) and ``hit_spans`` (word intervals, end
    excluded, joined where they touch)."""
    bench = items.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).alias("text"))
    spark = docs.sparkSession
    out = docs.select(*dict.fromkeys([*(f"`{c}`" for c in (keep or docs.columns)), f"`{text_col}`"]))
    for name, kind in (("hit_spans", "array<struct<start:bigint,end:bigint>>"), ("item_ids", "array<string>"), ("n_words", "bigint"), ("n_hit", "bigint")):
        out = out.withColumn(name, F.lit(None).cast(kind))
    for ids, texts in _chunks(bench, chunk_bytes):
        held = spark.sparkContext.broadcast((ids, _index(docs, text_col, texts, window)))
        out = _mark(out, text_col, held)
    last = [c for c in (keep or docs.columns) if c not in ("n_words", "n_hit", "item_ids", "hit_spans")]
    return out.select(*(f"`{c}`" for c in last), "n_words", "n_hit", F.array_sort(F.array_distinct("item_ids")).alias("item_ids"), "hit_spans")


def _mark(docs: DataFrame, text_col: str, held) -> DataFrame:
    """Add a chunk's occurrences to those that the row already carries."""
    fields = [T.StructField("hit_spans", _SPAN), T.StructField("item_ids", T.ArrayType(T.StringType())), T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType())]
    before = docs.withColumnsRenamed({"hit_spans": "__spans", "item_ids": "__ids"}).drop("n_words", "n_hit")

    def run(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        ids, index = held.value
        w = words_of(batch.column(text_col), ALNUM_ANY_CASE, lower=True)
        start, end, item = find_windows(w, index)
        n_docs, n = batch.num_rows, len(w.hash)
        edge = np.bincount(start, minlength=n + 1) - np.bincount(end, minlength=n + 1)
        for i, spans in enumerate(batch.column("__spans").to_pylist()):
            for s in spans or ():
                edge[w.first[i] + s["start"]] += 1
                edge[w.first[i] + s["end"]] -= 1
        inside = np.cumsum(edge)[:n] > 0
        step = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
        a, b = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        # a run of hit words that crosses into the next text ends at the text's end
        cut = np.array([x for x in w.first[1:-1] if 0 < x < n and inside[x - 1] and inside[x]], dtype=np.int64)
        a, b = np.unique(np.concatenate([a, cut])), np.unique(np.concatenate([b, cut]))
        per = np.bincount(w.doc[a], minlength=n_docs) if len(a) else np.zeros(n_docs, np.int64)
        base = w.first[w.doc[a]] if len(a) else a
        offsets = pa.array(np.concatenate([[0], np.cumsum(per)]), pa.int32())
        spans = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([pa.array(a - base, pa.int64()), pa.array(b - base, pa.int64())], names=["start", "end"]))
        named: list[list[str]] = [list(x or ()) for x in batch.column("__ids").to_pylist()]
        for pair in np.unique(np.stack([w.doc[start], item], axis=1), axis=0) if len(start) else ():
            named[pair[0]].append(ids[pair[1]])
        return {
            "hit_spans": spans, "item_ids": pa.array(named, pa.list_(pa.string())),
            "n_words": pa.array(np.diff(w.first), pa.int64()),
            "n_hit": pa.array(np.bincount(w.doc[inside], minlength=n_docs) if n else np.zeros(n_docs, np.int64), pa.int64()),
        }

    return add_columns(before, text_col, fields, run).drop("__spans", "__ids")

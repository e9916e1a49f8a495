"""Substring dedup: words covered by a window that also starts earlier go.

Every window of ``window`` words has a minimiser, the least hash among its
k-word grams, and equal windows have the same one. Consecutive windows
whose first least gram is the same one form a segment of at most
``2 * window - k`` words; equal windows are never in the same segment. Segments
are dealt to shards by minimiser, so that all places of a window meet in one
shard, and the work grows in proportion to the corpus:

1. each block of documents reports its distinct minimisers, and learns which
   of them the corpus has more than once;
2. it sends the distinct segments of those to their shards. A shard builds a
   compressed FM-index of its distinct segments, streams the segments of all
   blocks through it by backward search, and reports for each window whether
   an earlier place exists in its interval;
3. each block takes the reports and drops the covered words.

The three passes share one shuffle of the texts, by block. A minimiser that
occurs ``hot`` times or more is dealt by whole windows, so no shard holds it
alone; a passage that all blocks share costs a shard one row a block.
Words travel as 48-bit hashes.

Defined cases: null, empty and short texts have no window and lose nothing;
rows of one key are one document in the order of their texts (windows do not
cross rows, and a repeated row is the later one); rows without a key come
last, and of two of those the one whose window starts nearer to the
beginning counts as earlier. An empty table gives an empty one. A very long
text is one row of its block, read in pieces; columns of ``docs`` other than
those named are left out, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from meterlake.llm.fm_index import FMIndex
from meterlake.llm.words import SPACED, mix, pieces, ragged, tidy, words_of

GRAM = 5
_CHUNK = 1 << 19  # words that stream through an index together
_PIECE = 1 << 18  # bytes of a block's texts that become words together
_WINDOWS = 1 << 16  # windows of a block that are looked up together
_LAST = np.iinfo(np.int64).max
_ODD = np.uint64(0x9E3779B97F4A7C15)
_UNDO = np.uint64(pow(int(_ODD), -1, 1 << 64))


def _sliding_least(x: np.ndarray, span: int) -> np.ndarray:
    """Place of the first least of the ``span`` values from each place on
    (of fewer at the end)."""
    have, place = 1, np.arange(len(x))
    while have < span:
        step = min(have, span - have)
        near, far = place[: max(len(x) - step, 0)], place[step:]
        place = np.concatenate([np.where(x[near] <= x[far], near, far), place[len(near) :]])
        have += step
    return place


def _string_hash(hashes: np.ndarray, at: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Hash of the ``lens`` words from each place on."""
    power = np.cumprod(np.full(len(hashes) + 1, _ODD, np.uint64))
    undo = np.cumprod(np.full(len(hashes) + 1, _UNDO, np.uint64))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(hashes) * power[:-1])])
    return mix((total[at + lens] - total[at]) * undo[at] + lens.astype(np.uint64))


class _Block:
    """The segments of a block: place and number of windows, minimiser,
    hash; and for every text its key, words and order."""

    def __init__(self, table: pa.Table, window: int, gram: int):
        # rows of one key in the order of their texts
        order = pc.sort_indices(table, sort_keys=[("key", "ascending"), ("text", "ascending")])
        self.table = table.take(order).combine_chunks()
        n_words, at, lens, minimisers, hashes, base = [], [], [], [], [], 0
        words = []
        for batch in self.table.to_batches():
            for part in pieces(batch, "text", _PIECE):
                w = words_of(part.column("text"), SPACED, lower=False)
                n_words.append(np.diff(w.first))
                grams = mix(w.ngrams(gram)[0] if gram > 1 else w.hash)
                least = _sliding_least(grams, window - gram + 1)
                i = np.flatnonzero(np.arange(len(w.hash)) + window <= w.last())
                new = np.ones(len(i), bool)
                new[1:] = (i[1:] != i[:-1] + 1) | (least[i[1:]] != least[i[:-1]])
                s = i[new]
                k = np.diff(np.append(np.flatnonzero(new), len(i)))
                at.append(s + base)
                lens.append(k)
                minimisers.append(grams[least[s]])
                hashes.append(_string_hash(w.hash, s, k + window - 1))
                words.append(w.hash)
                base += len(w.hash)
        cat = lambda xs, t: np.concatenate([np.zeros(0, t), *xs])
        self.window = window
        self.n_words, self.words = cat(n_words, np.int64), cat(words, np.uint64)
        self.at, self.lens, self.min, self.hash = cat(at, np.int64), cat(lens, np.int64), cat(minimisers, np.uint64), cat(hashes, np.uint64)
        self.first = np.concatenate([[0], np.cumsum(self.n_words)])
        doc = np.searchsorted(self.first, self.at, side="right") - 1
        key = self.table.column("key").combine_chunks()
        nulls = key.is_null().to_numpy(zero_copy_only=False)
        keys = key.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        keys[nulls] = _LAST
        # places count on over the rows of one key (a row without a key stands alone)
        own = np.ones(len(keys), bool)
        own[1:] = nulls[1:] | (keys[1:] != keys[:-1])
        start = self.first[:-1][np.maximum.accumulate(np.where(own, np.arange(len(keys)), 0))] if len(keys) else self.first[:-1]
        text = self.table.column("text").combine_chunks()
        if nulls.any():  # equal texts without a key: the later ones follow
            for i in np.flatnonzero(nulls)[1:]:
                if text[i].as_py() == text[i - 1].as_py() and nulls[i - 1]:
                    start[i] = start[i - 1]
        self.key, self.place = keys[doc], self.at - start[doc]

    def split(self, rows: np.ndarray) -> tuple[np.ndarray, ...]:
        """Single windows of the segments ``rows`` (ascending): their segment,
        place in the block, and hash."""
        seg = np.repeat(rows, self.lens[rows])
        at = ragged(self.at[rows], self.lens[rows])
        low, high = (int(at[0]), int(at[-1]) + self.window) if len(at) else (0, 0)
        return seg, at, _string_hash(self.words[low:high], at - low, np.full(len(at), self.window, np.int64))


def _distinct(names: np.ndarray, key: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Index of the earliest row of each name, in the order of the names."""
    order = np.lexsort((place, key, names))
    lead = np.ones(len(order), bool)
    lead[1:] = names[order][1:] != names[order][:-1]
    return order[lead]


def _to48(x: np.ndarray) -> bytes:
    return np.ascontiguousarray((x & np.uint64((1 << 48) - 1)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _from48(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def _shard_of(names: np.ndarray, shards: int) -> np.ndarray:
    """Shards by ranges of a 64-bit value (``shards`` is a power of two)."""
    return (names >> np.uint64(64 - shards.bit_length() + 1)).astype(np.int64) if shards > 1 else np.zeros(len(names), np.int64)


def _spans(lens: np.ndarray, limit: int) -> list[tuple[int, int]]:
    """Stretches of strings with about ``limit`` words together."""
    cuts = np.append(np.unique(np.searchsorted(np.cumsum(lens) - lens, np.arange(0, int(lens.sum()), limit))), len(lens))
    return [(x, y) for x, y in zip(cuts[:-1], cuts[1:]) if y > x]


def _covered(b: _Block, reports: pa.Table) -> np.ndarray:
    """Whether each word of a block is in a window that starts earlier too,
    by the shards' reports. Windows are looked up a stretch at a time: a
    worker holds few arrays as long as the block's words."""
    edge = np.zeros(len(b.words) + 1, np.int32)

    def cover(starts: np.ndarray, n: np.ndarray | int) -> None:
        """The words of ``n`` windows in a row from each start on."""
        np.add.at(edge, starts, 1)
        np.add.at(edge, starts + (n + b.window - 1), -1)

    for single in (0, 1):
        some = reports.filter(pc.equal(reports["single"], single)) if reports.num_rows else reports
        if not some.num_rows:
            continue
        lens = [np.frombuffer(x.as_buffer(), "<u4").astype(np.int64) - b.window + 1 for x in some["lens"]]
        flags = np.concatenate([np.unpackbits(np.frombuffer(x.as_buffer(), np.uint8), count=int(k.sum())) for x, k in zip(some["earlier"], lens)]).view(bool)
        names, n = np.concatenate([np.frombuffer(x.as_buffer(), np.uint64) for x in some["names"]]), np.concatenate(lens)
        begin = np.cumsum(n) - n
        order = np.argsort(names)
        names, n, begin = names[order], n[order], begin[order]
        known = lambda own: names[np.minimum(np.searchsorted(names, own), len(names) - 1)] == own
        if single:
            cols = []
            for x, y in _spans(b.lens, _WINDOWS):
                seg, at, own = b.split(np.arange(x, y))
                hit = known(own)
                cols.append((seg[hit], at[hit], own[hit]))
            seg, at, own = (np.concatenate(c) for c in zip(*cols)) if cols else (b.at[:0], b.at[:0], b.hash[:0])
            key, place, size = b.key[seg], b.place[seg] + at - b.at[seg], np.ones(len(at), np.int64)
        else:
            hit = known(b.hash)
            at, own, key, place, size = b.at[hit], b.hash[hit], b.key[hit], b.place[hit], b.lens[hit]
        lead = _distinct(own, key, place)
        later = np.setdiff1d(np.arange(len(own)), lead, assume_unique=True)
        cover(at[later], size[later])  # an equal string starts earlier in this block
        spot = np.searchsorted(names, own[lead])
        at, size = at[lead], size[lead]
        for x, y in _spans(size, _WINDOWS):
            mine = ragged(begin[spot[x:y]], n[spot[x:y]])
            cover(ragged(at[x:y], size[x:y])[flags[mine]], 1)
    return np.cumsum(edge, out=edge)[:-1] > 0


def _earlier(words: np.ndarray, lens: np.ndarray, key: np.ndarray, place: np.ndarray, window: int) -> np.ndarray:
    """For strings sent to one shard: for each of their windows, string by
    string, whether the shard knows an earlier place.

    The index holds the distinct strings. All strings stream through it, a
    chunk at a time, and what is kept of them is the number of each window's
    interval; the earliest place of an interval is the least over the chunks,
    so no place is looked up in the index."""
    begin = np.cumsum(lens) - lens
    chosen = _distinct(_string_hash(words, begin, lens), key, place)
    _, symbols = np.unique(words, return_inverse=True)
    index = FMIndex(symbols[ragged(begin[chosen], lens[chosen])], lens[chosen], window)
    best_key, best_place = np.full(index.n_intervals, _LAST), np.full(index.n_intervals, _LAST)
    n_win = np.maximum(lens - window + 1, 0)
    numbers = np.empty(int(n_win.sum()), np.int32 if index.n < 1 << 31 else np.int64)
    win_begin = np.cumsum(n_win) - n_win
    spans = _spans(lens, _CHUNK)

    def places(x: int, y: int) -> tuple[slice, np.ndarray, np.ndarray, np.ndarray]:
        offset = ragged(np.zeros(y - x, np.int64), n_win[x:y])
        own = slice(int(win_begin[x]), int(win_begin[x] + n_win[x:y].sum()))
        return own, offset, np.repeat(key[x:y], n_win[x:y]), np.repeat(place[x:y], n_win[x:y]) + offset

    for x, y in spans:
        _, found = index.match(symbols[begin[x] : begin[y - 1] + lens[y - 1]], lens[x:y])
        own, offset, k, p = places(x, y)
        number = found[np.repeat(begin[x:y] - begin[x], n_win[x:y]) + offset]
        numbers[own] = number
        lead = _distinct(number, k, p)
        number, k, p = number[lead], k[lead], p[lead]
        less = (k < best_key[number]) | ((k == best_key[number]) & (p < best_place[number]))
        best_key[number[less]], best_place[number[less]] = k[less], p[less]
    earlier = np.empty(len(numbers), bool)
    for x, y in spans:
        own, _, k, p = places(x, y)
        number = numbers[own]
        earlier[own] = (best_key[number] < k) | ((best_key[number] == k) & (best_place[number] < p))
    return earlier


def substring_dedup(
    docs: DataFrame, *, window: int = 20, gram: int = GRAM, block_bytes: int = 8 << 20, hot: int = 1 << 16, id_col: str = "doc_id", text_col: str = "text",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row for each row of ``docs``: the key, ``n_words``, ``n_removed``
    and ``kept_text`` (the words that stay, joined by single spaces), then
    the columns ``keep`` of the row as they were."""
    gram = min(gram, window)
    size = docs.select(F.sum(F.octet_length(text_col))).first()[0] or 0
    blocks = int(size // block_bytes) + 1
    shards = 1 << (4 * blocks - 1).bit_length()  # an index takes more memory than the words it holds
    block = F.pmod(F.xxhash64(F.coalesce(F.col("key"), F.xxhash64("text"))), F.lit(blocks))
    others = [c for c in keep if c != text_col]  # the text itself travels once
    rest = F.struct(*(F.col(f"`{c}`") for c in others)) if others else F.lit(0)
    rows = docs.select(F.col(id_col).cast("long").alias("key"), F.col(text_col).alias("text"), rest.alias("rest")).withColumn("block", block)
    by_block = rows.groupBy("block")
    batch = pa.RecordBatch.from_pydict

    @tidy
    def report(table: pa.Table) -> pa.Table:
        b = _Block(table, window, gram)
        names, counts = np.unique(b.min, return_counts=True)
        edges = np.searchsorted(_shard_of(names, shards), np.arange(shards + 1))
        some = np.flatnonzero(np.diff(edges))
        return pa.table({
            "shard": pa.array(some, pa.int64()), "block": pa.array(np.full(len(some), table["block"][0].as_py()), pa.int64()),
            "names": pa.array([names[edges[s] : edges[s + 1]].tobytes() for s in some], pa.binary()),
            "counts": pa.array([counts[edges[s] : edges[s + 1]].astype("<u4").tobytes() for s in some], pa.binary()),
        })

    @tidy
    def count(table: pa.Table) -> pa.Table:
        raw = [np.frombuffer(x.as_buffer(), np.uint64) for x in table["names"]]
        names, inverse = np.unique(np.concatenate(raw), return_inverse=True)
        total = np.bincount(inverse, weights=np.concatenate([np.frombuffer(x.as_buffer(), "<u4") for x in table["counts"]]))
        state = np.where(total >= hot, 2, np.where(total > 1, 1, 0)).astype(np.uint8)[inverse]
        cuts = np.cumsum([len(x) for x in raw])[:-1]
        return pa.table({"block": table["block"].combine_chunks(), "shard": table["shard"].combine_chunks(), "state": pa.array([x.tobytes() for x in np.split(state, cuts)], pa.binary())})

    @tidy
    def send(left: pa.Table, right: pa.Table) -> pa.Table:
        out: dict[str, list] = {n: [] for n in ("shard", "block", "single", "lens", "keys", "places", "names", "words")}
        if left.num_rows and right.num_rows:
            b = _Block(left, window, gram)
            right = right.sort_by("shard")
            state = np.frombuffer(b"".join(x.as_py() for x in right["state"]), np.uint8)
            names = np.unique(b.min)
            own = state[np.searchsorted(names, b.min)]
            once = np.flatnonzero(own == 1)
            once = once[_distinct(b.hash[once], b.key[once], b.place[once])]
            pack = [(0, b.hash[once], b.min[once], b.at[once], b.lens[once] + window - 1, b.key[once], b.place[once])]
            seg, at, name = b.split(np.flatnonzero(own == 2))
            if len(seg):
                place = b.place[seg] + at - b.at[seg]
                one = _distinct(name, b.key[seg], place)
                pack.append((1, name[one], mix(name[one]), at[one], np.full(len(one), window, np.int64), b.key[seg][one], place[one]))
            for single, name, dealt, at, lens, key, place in pack:
                shard = _shard_of(dealt, shards)
                order = np.argsort(shard, kind="stable")
                edges = np.searchsorted(shard[order], np.arange(shards + 1))
                for s in np.flatnonzero(np.diff(edges)):
                    i = order[edges[s] : edges[s + 1]]
                    row = (s, left["block"][0].as_py(), single, lens[i].astype("<u4").tobytes(), key[i].tobytes(), place[i].tobytes(), name[i].tobytes(), _to48(b.words[ragged(at[i], lens[i])]))
                    for column, value in zip(out.values(), row):
                        column.append(value)
        kinds = (pa.int64(), pa.int64(), pa.int32(), *(pa.binary(),) * 5)
        return pa.table({n: pa.array(v, k) for (n, v), k in zip(out.items(), kinds)})

    @tidy
    def search(table: pa.Table) -> pa.Table:
        part = lambda n, t: np.concatenate([np.frombuffer(x.as_buffer(), t) for x in table[n]])
        lens = part("lens", "<u4").astype(np.int64)
        words = np.concatenate([_from48(x.as_buffer()) for x in table["words"]])
        flags = _earlier(words, lens, part("keys", np.int64), part("places", np.int64), window)
        counts = [len(x.as_buffer()) // 4 for x in table["lens"]]
        of_row = np.add.reduceat(lens - window + 1, np.concatenate([[0], np.cumsum(counts)[:-1]]))
        return pa.table({
            "block": table["block"].combine_chunks(), "single": table["single"].combine_chunks(), "lens": table["lens"].combine_chunks(), "names": table["names"].combine_chunks(),
            "earlier": pa.array([np.packbits(x).tobytes() for x in np.split(flags, np.cumsum(of_row)[:-1])], pa.binary()),
        })

    @tidy
    def remove(left: pa.Table, right: pa.Table) -> pa.Table:
        kept: list[pa.Array] = []
        if not left.num_rows:
            return empty
        b = _Block(left, window, gram)
        gone = _covered(b, right)
        removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[b.first])
        table, n_words, base = b.table, b.n_words, 0
        del b  # its arrays make room for the texts that stay
        for rb in table.to_batches():
            for part in pieces(rb, "text", _PIECE):
                w = words_of(part.column("text"), SPACED, lower=False)
                raw, stay = w.data.tobytes(), ~gone[base : base + len(w.hash)]
                texts: list[bytes] = []
                for i in range(part.num_rows):
                    x, y = int(w.first[i]), int(w.first[i + 1])
                    own = np.flatnonzero(stay[x:y]) + x
                    texts.append(b" ".join([raw[a:z] for a, z in zip(w.start[own].tolist(), w.end[own].tolist())]))
                kept.append(pa.array(texts, pa.binary()).cast(pa.string()))
                base += len(w.hash)
        cols = {"key": table["key"], "n_words": pa.array(n_words), "n_removed": pa.array(removed), "kept_text": pa.chunked_array(kept, pa.string()), "rest": table["rest"]}
        return pa.table(cols | ({"text": table["text"]} if text_col in keep else {}))

    names = by_block.applyInArrow(report, "shard long, block long, names binary, counts binary")
    states = names.groupBy("shard").applyInArrow(count, "block long, shard long, state binary")
    sent = by_block.cogroup(states.groupBy("block")).applyInArrow(send, "shard long, block long, single int, lens binary, keys binary, places binary, names binary, words binary")
    found = sent.groupBy("shard").applyInArrow(search, "block long, single int, lens binary, names binary, earlier binary")
    result = StructType.fromDDL("key long, n_words long, n_removed long, kept_text string").add(rows.schema["rest"])
    if text_col in keep:
        result = result.add("text", rows.schema["text"].dataType)
    empty = to_arrow_schema(result).empty_table()
    done = by_block.cogroup(found.groupBy("block")).applyInArrow(remove, result)
    own = [F.col("key").alias(id_col), "n_words", "n_removed", "kept_text"]
    return done.select(*own, *((F.col("text") if c == text_col else F.col("rest")[c]).alias(c) for c in keep))

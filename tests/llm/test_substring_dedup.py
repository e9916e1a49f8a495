"""Substring dedup against all windows; the index against plain search."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from meterlake.llm.fm_index import FMIndex
from meterlake.llm.substring_dedup import substring_dedup


def _brute(rows, window):
    """Rows in order: (key, text) with null keys last."""
    docs = {}
    placed = []
    for key, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or "")):
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        base = docs.get(key, 0)
        docs[key] = base + len(w)
        placed.append((key, base, w))
    first = {}
    for order, (key, base, w) in enumerate(placed):
        for i in range(len(w) - window + 1):
            at = ((1 << 62) if key is None else key, base + i)
            name = tuple(w[i : i + window])
            first[name] = min(first.get(name, at), at)
    out = []
    for key, base, w in placed:
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < ((1 << 62) if key is None else key, base + i):
                gone.update(range(i, i + window))
        out.append((key, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=str)


def _corpus(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefgh") * rng.randrange(1, 3)
    passages = [[word() for _ in range(rng.randrange(3, 30))] for _ in range(12)]
    rows = []
    for i in range(60):
        text = []
        for _ in range(rng.randrange(0, 6)):
            text += rng.choice(passages) if rng.random() < 0.5 else [word() for _ in range(rng.randrange(1, 12))]
        rows.append((i * 3, " ".join(text)))
    rows += [(1000, rows[5][1] + "  " + rows[6][1]), (4, "x " * 40), (7, "\t".join("aAbB" * 9)), (8, None), (9, "")]
    rows += [(1001, rows[5][1]), (1001, rows[5][1]), (1001, rows[7][1])]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,window,gram,block,hot", [(1, 6, 3, 200, 1 << 16), (2, 6, 3, 200, 3), (3, 4, 4, 1 << 20, 1), (4, 20, 5, 400, 1 << 16), (5, 3, 1, 300, 5)])
def test_against_all_windows(llm_spark, seed, window, gram, block, hot):
    rows = _corpus(seed)
    docs = llm_spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n_words long")
    got = substring_dedup(docs, window=window, gram=gram, block_bytes=block, hot=hot).collect()
    assert sorted((tuple(r) for r in got), key=str) == _brute(rows, window)


def test_edge_rows(llm_spark, edge):
    rows = [(r.doc_id, r.text) for r in edge.collect()]
    got = substring_dedup(edge, window=5).collect()
    assert sorted((tuple(r) for r in got), key=str) == _brute(rows, 5)
    assert substring_dedup(edge.where("false")).count() == 0


def _index(strings, window):
    flat = [np.array(x, np.int64) for x in strings]
    return FMIndex(np.concatenate([np.zeros(0, np.int64), *flat]), np.array([len(x) for x in strings], np.int64), window)


def _match(index, strings):
    flat = [np.array(x, np.int64) for x in strings]
    return index.match(np.concatenate([np.zeros(0, np.int64), *flat]), np.array([len(x) for x in strings], np.int64))


def _statistics(have, strings, window):
    grams = {tuple(x[i : i + k]) for x in have for k in range(1, window + 1) for i in range(len(x) - k + 1)}
    return [max([k for k in range(1, min(window, len(x) - i) + 1) if tuple(x[i : i + k]) in grams], default=0) for x in strings for i in range(len(x))]


def test_a_failed_word_shortens_the_match():
    statistic, number = _match(_index([[0, 1, 2], [2, 3, 5]], 3), [[0, 1, 2, 3]])
    assert statistic.tolist() == [3, 2, 2, 1]
    assert (number >= 0).tolist() == [True, False, False, False]


@pytest.mark.parametrize("seed,alphabet,window", [(1, 4, 3), (2, 2, 6), (3, 3, 5), (4, 9, 2), (5, 2, 20), (6, 3, 1)])
def test_index_matches_strings_that_it_does_not_hold(seed, alphabet, window):
    rng = random.Random(seed)
    string = lambda extra: [rng.randrange(alphabet) - extra for _ in range(rng.randrange(0, 30))]
    strings = [string(0) for _ in range(25)]
    index = _index(strings, window)
    foreign = [string(extra) for extra in (0, 0, 1) for _ in range(30)]  # -1: a word unknown to the index
    foreign += [strings[3] + strings[4], strings[5][2:] + [alphabet + 7] + strings[6]]
    for queries in (foreign, strings):
        statistic, number = _match(index, queries)
        assert statistic.tolist() == _statistics(strings, queries, window)
        places = [tuple(x[i : i + window]) for x in queries for i in range(len(x))]
        named = {}
        for gram, m, at in zip(places, statistic.tolist(), number.tolist()):
            assert (at >= 0) == (m == window)
            if at >= 0:
                assert named.setdefault(gram, at) == at < index.n_intervals
        assert len(set(named.values())) == len(named)


def test_index_keeps_neither_text_nor_suffix_array():
    rng = random.Random(9)
    strings = [[rng.randrange(1000) for _ in range(25)] for _ in range(4000)]
    index = _index(strings, 20)
    vectors = [b.words.nbytes + b.before.nbytes for b in index.levels]
    # ten levels of a bit a row with counts, a byte a row, the intervals' first rows
    assert sum(vectors) + index.shared.nbytes < 4 * index.n
    arrays = [k for k, v in vars(index).items() if isinstance(v, np.ndarray) and len(v) >= index.n and k != "shared"]
    assert arrays == []


def test_strings_in_small_chunks(monkeypatch):
    from meterlake.llm import substring_dedup as module

    rng = np.random.default_rng(3)
    lens = rng.integers(4, 12, 300)
    words = rng.integers(0, 3, int(lens.sum())).astype(np.uint64)
    key, place = rng.permutation(300).astype(np.int64), rng.integers(0, 50, 300)
    whole = module._earlier(words, lens, key, place, 4)
    monkeypatch.setattr(module, "_CHUNK", 17)
    assert (module._earlier(words, lens, key, place, 4) == whole).all()
    begin = np.cumsum(lens) - lens
    wins = [(tuple(words[begin[i] + j : begin[i] + j + 4].tolist()), (int(key[i]), int(place[i] + j))) for i in range(300) for j in range(int(lens[i]) - 3)]
    first = {}
    for gram, at in wins:
        first[gram] = min(first.get(gram, at), at)
    assert whole.tolist() == [first[gram] < at for gram, at in wins]


def test_a_block_takes_few_arrays_as_long_as_its_words():
    """A task holds a block of texts: what it computes along the way goes a
    piece of the texts, or a stretch of windows, at a time."""
    import tracemalloc

    import pyarrow as pa

    from meterlake.llm import substring_dedup as module

    rng = np.random.default_rng(4)
    common = [" ".join(f"w{x}" for x in rng.integers(0, 5000, 300)) for _ in range(200)]
    texts = [common[int(i)] for i in rng.integers(0, 200, 2500)]
    table = pa.table({"key": pa.array(range(len(texts)), pa.int64()), "text": texts})
    size = sum(map(len, texts))

    def peak(fn):
        tracemalloc.start()
        out = fn()
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return out, most

    block, most = peak(lambda: module._Block(table, 20, 5))
    assert most < 6 * size
    # a shard reports all segments as new here, so only those that the block itself has earlier go
    first = module._distinct(block.hash, block.key, block.place)
    lens = block.lens[first] + 19
    reports = pa.table({"single": pa.array([0], pa.int32()), "lens": [lens.astype("<u4").tobytes()], "names": [block.hash[first].tobytes()], "earlier": [np.packbits(np.zeros(int(block.lens[first].sum()), bool)).tobytes()]})
    gone, most = peak(lambda: module._covered(block, reports))
    assert most < 6 * size
    seen, want = set(), []
    for text in texts:
        want.append(0 if text not in seen else 300)
        seen.add(text)
    assert np.diff(np.concatenate([[0], np.cumsum(gone)])[block.first]).tolist() == want

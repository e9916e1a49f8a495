"""Token files, packing and decontamination against plain Python."""

from __future__ import annotations

import gc
import random
import re
import tracemalloc
import zlib
from collections import defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from meterlake.llm import encode, packing, token_files, words
from meterlake.llm.decontaminate import decontaminate
from meterlake.llm.encode import Encoder, encoder
from meterlake.llm.queries import tokenizer_path
from meterlake.session import shared_dir

PATH = tokenizer_path()


@pytest.fixture(scope="module")
def plain():
    tok = Tokenizer.from_file(PATH)
    return lambda text: tok.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=60), st.text(alphabet="aé'sΣİ<|endoftx>., \t́ ​Z9*", max_size=40)), max_size=6))
def test_word_tables_give_the_tokenizers_ids(texts):
    tok = Tokenizer.from_file(PATH)
    ids, offsets = encoder(PATH).encode(pa.array(texts, pa.string()))
    for i, t in enumerate(texts):
        assert ids[offsets[i] : offsets[i + 1]].tolist() == tok.encode(t or "", add_special_tokens=False).ids


def test_whole_text_tokenizer(plain):
    path = tokenizer_path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    ids, offsets = encoder(path).encode(pa.array(["two  words", None, "x"]))
    assert ids[: offsets[1]].tolist() == tok.encode("two  words", add_special_tokens=False).ids
    assert offsets[1] == offsets[2]


def test_word_tables_stay_small():
    """A worker keeps its tables between tasks: some 50 bytes a word here."""
    rng = random.Random(5)
    texts = pa.array([" ".join("".join(rng.choices("abcdefghij", k=8)) + rng.choice(["", ","]) for _ in range(500)) for _ in range(100)])
    enc = Encoder(PATH)
    tracemalloc.start()
    try:
        enc.encode(texts)
        gc.collect()
        assert tracemalloc.get_traced_memory()[0] < 100 * len(enc.known)
    finally:
        tracemalloc.stop()


def test_word_tables_are_bounded_by_their_ids(plain, monkeypatch):
    monkeypatch.setattr(encode, "MAX_IDS", 1000)
    enc = Encoder(PATH)
    for i in range(20):
        text = " ".join(f"{chr(97 + i)}{'xqzj' * 30}{j}" for j in range(10))
        ids, _ = enc.encode(pa.array([text]))
        assert ids.tolist() == plain(text)
        assert len(enc.pool) <= 1000 + len(ids)


@given(st.integers(1, 32), st.lists(st.integers(0, 2**32 - 1), max_size=70), st.integers(0, 70), st.integers(0, 70))
def test_bit_packing_round_trip(width, ids, a, b):
    ids = np.array([x % 2**width for x in ids], np.uint32)
    packed = token_files.pack_bits(ids, width)
    assert len(packed) == -(-len(ids) * width // 8)
    a, b = sorted((min(a, len(ids)), min(b, len(ids))))
    assert token_files.unpack_bits(packed, width, a, b - a).tolist() == ids[a:b].tolist()


def test_token_files(llm_spark, edge, plain):
    path = shared_dir(llm_spark, "test-tokens")
    token_files.write_tokens(edge, path, tokenizer=PATH, end_id=2)
    got = sorted(token_files.read_documents(llm_spark, path).collect(), key=lambda r: r.start)
    want = sorted(((r.doc_id, r.text) for r in edge.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    start, flat = 0, []
    for g, (key, text) in zip(got, want, strict=True):
        ids = [*plain(text), 2]
        assert (g.key, g.start, g.n_tokens, list(g.ids)) == (key, start, len(ids), ids)
        assert g.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
        flat += ids
    assert token_files.read_range(llm_spark, path, 5, 40).tolist() == flat[5:45]


def test_token_files_of_nothing(llm_spark, edge):
    path = shared_dir(llm_spark, "test-tokens")
    token_files.write_tokens(edge.where("false"), path, tokenizer=PATH, end_id=2)
    assert token_files.read_documents(llm_spark, path).count() == 0


def test_token_file_workers_give_back_memory(llm_spark, edge, monkeypatch):
    """Spark keeps its Python workers, so each task returns what it freed."""
    tasks, freed = [], []
    of = type(edge).mapInArrow
    monkeypatch.setattr(type(edge), "mapInArrow", lambda self, fn, *a, **k: (tasks.append(fn), of(self, fn, *a, **k))[1])
    path = shared_dir(llm_spark, "test-tokens")
    token_files.write_tokens(edge, path, tokenizer=PATH, end_id=2)
    assert token_files.read_documents(llm_spark, path).count() == len(edge.collect())
    monkeypatch.setattr(token_files, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    monkeypatch.setattr(words, "give_back", lambda: freed.append(1))
    for n, task in enumerate(tasks, 1):
        assert list(task(iter([]))) == [] and len(freed) == n
    assert len(tasks) == 2


def _check_plan(histogram, capacity):
    table = packing.plan(histogram, capacity)
    filled = defaultdict(list)
    seen = defaultdict(set)
    for length, first, last, q, seq, offset in table.tolist():
        for k in range(first, last):
            nth, own = divmod(k - first, q)
            assert k not in seen[length]
            seen[length].add(k)
            filled[seq + nth].append((offset + own * length, length))
    assert {x: len(s) for x, s in seen.items()} == {x: n for x, n in histogram.items() if n}
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
        assert sum(3 * n > capacity for _, n in parts) <= 2
    return len(filled)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(0, 40), max_size=25))
def test_plan_is_gapless_and_complete(histogram):
    used = _check_plan(histogram, 60)
    total = sum(k * n for k, n in histogram.items())
    assert used <= max(-(-total // 60) * 1.5 + 1, sum(n for k, n in histogram.items() if 2 * k > 60))


def test_plan_is_near_the_bound_on_mixed_lengths():
    rng = random.Random(3)
    histogram = defaultdict(int)
    for _ in range(20000):
        histogram[min(2048, int(rng.lognormvariate(6, 1)) + 1)] += 1
    bound = -(-sum(k * n for k, n in histogram.items()) // 2048)
    assert _check_plan(histogram, 2048) <= bound * 1.01


def test_packing_documents(llm_spark, edge, plain):
    packed = packing.pack_documents(edge, tokenizer=PATH, end_id=0, capacity=64)
    rows = packed.collect()
    want = []
    for r in edge.collect():
        ids = [*plain(r.text), 0]
        want += [(r.doc_id, i // 64, i, len(ids[i : i + 64]), zlib.crc32(np.array(ids[i : i + 64], "<u4").tobytes())) for i in range(0, len(ids), 64)]
    key = lambda x: tuple((v is not None, v or 0) for v in x)
    assert sorted([tuple(r)[:5] for r in rows], key=key) == sorted(want, key=key)
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    assert packing.pack_documents(edge.where("false"), tokenizer=PATH).count() == 0


def test_sequences_hold_the_ids(llm_spark, plain):
    docs = llm_spark.createDataFrame([(i, "word " * (i % 90)) for i in range(40)], "doc_id long, text string")
    packed = packing.pack_documents(docs, tokenizer=PATH, capacity=64)
    held = {r.sequence_id: list(r.ids) for r in packing.sequences(docs, packed, tokenizer=PATH, capacity=64).collect()}
    for r in packed.collect():
        ids = [*plain("word " * (r.doc_id % 90)), 0][r.start : r.start + r.length]
        assert held[r.sequence_id][r.offset : r.offset + r.length] == ids


def _leaks(docs, items, window):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    out = []
    for key, text in docs:
        w, hit, names = split(text), set(), set()
        for item, body in items:
            b = split(body)
            n = min(window, len(b))
            for s in range(len(b) - n + 1) if n else ():
                for i in range(len(w) - n + 1):
                    if w[i : i + n] == b[s : s + n]:
                        hit.update(range(i, i + n))
                        names.add("" if item is None else str(item))
        out.append((key, len(w), sorted(hit), sorted(names)))
    return out


@pytest.mark.parametrize("chunk_bytes", [1, 1 << 20])
def test_decontamination_against_brute_force(llm_spark, chunk_bytes):
    rng = random.Random(7)
    words = ["the", "Of", "é", "x1", "QUICK", "brown"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, text(rng.randrange(0, 9))) for i in range(12)] + [(None, "the the the the"), (50, None), (51, ""), (3, "Of x1")]
    docs = [(i, text(rng.randrange(0, 60))) for i in range(40)] + [(90, None), (90, ""), (None, "the x1."), (91, items[2][1])]
    d = llm_spark.createDataFrame([(*r, "n") for r in docs], "doc_id long, text string, n_hit string")
    b = llm_spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate(d, b, window=4, chunk_bytes=chunk_bytes).collect()
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2], r[3])
    flat = [(r.doc_id, r.n_words, [i for s in r.hit_spans for i in range(s.start, s.end)], list(r.item_ids)) for r in got]
    assert sorted(flat, key=key) == sorted(_leaks(docs, items, 4), key=key)
    assert all(r.n_hit == len(f[2]) for r, f in zip(got, flat))


def test_decontamination_of_nothing(llm_spark, edge):
    none = llm_spark.createDataFrame([], "item_id long, text string")
    assert {r.n_hit for r in decontaminate(edge, none).collect()} == {0}
    assert decontaminate(edge.where("false"), none).count() == 0

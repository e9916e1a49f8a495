"""Fingerprints against the similarity they estimate; edits in order."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from meterlake.llm import fingerprints as fp


def _jaccard(a, b):
    x, y = Counter(a.split()), Counter(b.split())
    return sum((x & y).values()) / sum((x | y).values())


def test_collisions_estimate_generalised_jaccard():
    rng = random.Random(1)
    a, b = [], []
    for _ in range(300):
        words = [f"w{min(int(rng.expovariate(0.02)), 400)}" for _ in range(rng.randrange(20, 200))]
        other = [w if rng.random() < rng.random() else f"v{rng.randrange(50)}" for w in words] + words[: rng.randrange(30)]
        a.append(" ".join(words))
        b.append(" ".join(other))
    x, xs = fp.fingerprints(pa.array(a), 256)
    y, ys = fp.fingerprints(pa.array(b), 256)
    want = np.array([_jaccard(*p) for p in zip(a, b)])
    error = fp.likeness(x, xs, y, ys) - want
    assert abs(error.mean()) < 0.01
    assert np.sqrt((error**2).mean()) < 1.2 * np.sqrt((want * (1 - want)).mean() / 256)


def test_a_text_has_one_fingerprint_in_any_batch():
    texts = ["a b b c", None, "", "c b a b", "x " * 5000]
    whole, some = fp.fingerprints(pa.array(texts))
    for i, t in enumerate(texts):
        one, s = fp.fingerprints(pa.array([t], pa.string()))
        assert (one[0] == whole[i]).all() and s[0] == some[i]
    assert (whole[0] == whole[3]).all()
    assert some.tolist() == [True, False, False, True, True]


@pytest.mark.parametrize("bucket_bytes", [1, 1 << 30])
def test_edit_report(llm_spark, edge, bucket_bytes):
    rng = random.Random(3)
    more = [(i * 5 + 11, " ".join(rng.choice("abcdefé🙂") * 3 for _ in range(rng.randrange(60)))) for i in range(50)]
    rows = [(r.doc_id, r.text) for r in edge.collect()] + more
    docs = llm_spark.createDataFrame([(*r, "n") for r in rows], "doc_id long, text string, n_chars string")
    got = fp.edit_report(docs, bucket_bytes=bucket_bytes, max_buckets=7).collect()
    lined = sorted(((k, t or "") for k, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    want = []
    for (key, text), (_, nxt) in zip(lined, lined[1:] + lined[:1]):
        n = len(text) // 3
        edited = text[: len(text) - n] + nxt[:n]
        (own, new, other), some = fp.fingerprints(pa.array([text, edited, nxt], pa.string()))
        like = lambda i, v: float(fp.likeness(own[None], some[:1], v[None], some[i : i + 1])[0])
        want.append((key, len(text), hashlib.sha256(edited.encode()).hexdigest(), own.astype(">u2").tobytes().hex() if some[0] else "", new.astype(">u2").tobytes().hex() if some[1] else "", like(1, new), like(2, other)))
    assert sorted((tuple(r) for r in got), key=str) == sorted(want, key=str)


def test_one_row_and_none(llm_spark):
    one = llm_spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    row = fp.edit_report(one).first()
    assert (row.near_edited, row.near_next) != (0.0, 0.0) and row.near_next == 1.0
    assert fp.edit_report(one.where("false")).count() == 0
    assert fp.fingerprint(one.where("false")).count() == 0


def test_fingerprint_column(llm_spark, edge):
    rows = fp.fingerprint(edge.withColumnRenamed("score", "fingerprint")).collect()
    assert {r.fingerprint for r in rows if r.text is None or not r.text.strip()} == {""}
    assert len({r.fingerprint for r in rows if r.text == "one two three four five six"}) == 1

"""Near-duplicates against all pairs; components against a search."""

from __future__ import annotations

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from meterlake.llm import near_dedup
from meterlake.llm.components import _large_star, _stars, components


def _brute(rows, percent, size=5):
    def shingles(text):
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set())

    sets = [shingles(t) for _, t in rows]
    up = {k: k for k, _ in rows if k is not None}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and None not in (rows[i][0], rows[j][0]) and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                x, y = sorted((find(rows[i][0]), find(rows[j][0])))
                up[y] = x
    return sorted(((k, len(s), find(k) if k is not None else None) for (k, _), s in zip(rows, sets)), key=str)


def _corpus(seed):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(4000)}"
    rows = []
    for group in range(25):
        base = [word() for _ in range(rng.choice([3, 5, 6, 40, 120, 300]))]
        for _ in range(rng.choice([1, 2, 12])):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3, 4])):
                text[rng.randrange(len(text))] = word()
            rows.append((len(rows), " ".join(text)))
    rng.shuffle(rows)
    return [(i, t.upper() if i % 7 == 0 else t) for i, (_, t) in enumerate(rows)]


@pytest.mark.parametrize("seed,block", [(1, 2048), (2, 4)])
def test_components_of_links(llm_spark, monkeypatch, seed, block):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    rows = _corpus(seed) + [(900, None), (901, ""), (902, " \t "), (None, "a b c d e f"), (903, "a b c d e f"), (904, "A B C D E F"), (5, "a b c d e f"), (5, "a b c d e f")]
    docs = llm_spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, kept string")
    got = near_dedup.near_duplicates(docs, percent=85).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == _brute(rows, 85)
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in got)


def test_edge_rows(llm_spark, edge):
    rows = [(r.doc_id, r.text) for r in edge.collect()]
    got = near_dedup.near_duplicates(edge, percent=80).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == _brute(rows, 80)
    assert near_dedup.near_duplicates(edge.where("false")).count() == 0


def test_components(llm_spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(400 + i, 401 + i) for i in range(60)] + [(7, None)]
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges[:-1]:
        x, y = sorted((find(a), find(b)))
        up[y] = x
    got = {r.node: r.root for r in components(llm_spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in up if find(x) != x}


def test_a_step_reads_its_edges_once_for_both_ends(llm_spark, capsys):
    """A union of the edges with themselves reads, and starts as tasks, all of
    their partitions twice."""
    edges = llm_spark.createDataFrame([(5, 1), (5, 2), (9, 5), (3, None)], "u long, v long")
    step = _large_star(edges)
    assert sorted(map(tuple, step.collect())) == [(5, 1), (5, 2), (9, 1)]
    step.explain()
    assert "Union" not in capsys.readouterr().out
    assert [_stars(edges.where(c)) for c in ("v < 5", "u = 9", "u > 3")] == [False, True, False]


@pytest.mark.parametrize("percent", [80, 85])
def test_signatures_keep_pairs_at_the_threshold(percent):
    """Fewer than one in a million pairs at the threshold fail the signature test."""
    n, p = near_dedup.MINIMA, percent / 100
    least = percent / 100 - near_dedup.SLACK
    assert sum(math.comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(n + 1) if k / n < least) < 1e-6


def test_key_filter_keeps_the_keys_without_a_python_worker(llm_spark, capsys):
    keys = llm_spark.range(0, 30_000, 7).select(F.col("id").alias("key"))
    rows = llm_spark.range(30_000).select(F.when(F.col("id") != 14, F.col("id")).alias("k"))
    for bits in (1 << 23, 1 << 14, 64):
        known = near_dedup.key_filter(keys, bits)
        among, others = known(rows, "k"), known(rows, "k", others=True)
        got = {r.k for r in among.collect()}
        assert got >= {k for k in range(0, 30_000, 7) if k != 14} and None not in got
        assert sorted(map(str, [*got, *(r.k for r in others.collect())])) == sorted(str(r.k) for r in rows.collect())
        assert bits < 1 << 20 or len(got) < 4400
    among.explain()
    plan = capsys.readouterr().out
    assert "BroadcastHashJoin" in plan and "Python" not in plan
    none = near_dedup.key_filter(keys.where("false"))
    assert none(rows, "k").count() == 0 and none(rows, "k", others=True).count() == 30_000

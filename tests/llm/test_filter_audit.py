"""The filter audit against filters applied one after another."""

from __future__ import annotations

import itertools
import random
import re

import pytest

from meterlake.llm import filter_audit


def _fails(text, key, keys):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {
        "A": len(w) < 100,
        "B": 100 * len(set(w)) < 80 * len(w),
        "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
        "D": bool(re.search(r"[#$%&*|]", text)),
        "E": key is not None and any(k is not None and k < key for k in keys[text]),
    }


def _brute(docs, labels):
    good = {k for k, q, _ in labels if q == 1 and k is not None}
    toxic = {k for k, _, t in labels if t == 1 and k is not None}
    keys = {}
    for k, text, _ in docs:
        keys.setdefault(text or "", []).append(k)
    parts = {}
    for k, text, lang in docs:
        parts.setdefault(lang or "", []).append((k, _fails(text or "", k, keys)))
    out = set()
    for part, rows in parts.items():
        steps, of_letter = {}, dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left, gone = list(rows), []
            for step, x in enumerate(order, 1):
                here = [r for r in left if r[1][x]]
                left = [r for r in left if not r[1][x]]
                steps["".join(order), step] = (
                    x, len(left), len(here), sum(f[x] for _, f in gone), sum(f[x] and sum(f.values()) == 1 for _, f in rows),
                    sum(k in good for k, _ in here), sum(k in toxic for k, _ in here),
                )
                gone += here
                of_letter[x] += len(here)
        out |= {(part, order, step, *c, of_letter[c[0]]) for (order, step), c in steps.items()}
    return out


def _run(spark, docs, labels):
    rows = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, lang string, mask int, part string")
    got = filter_audit.filter_audit(rows, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    return [tuple(r) for r in got.select("part", "filter_order", "step", "letter", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley").collect()]


def _documents():
    rng = random.Random(6)
    docs = []
    for i in range(90):
        n = rng.choice([0, 3, 99, 100, 130])
        words = [rng.choice(["Ab", "CD", "e" * 9, "é漢", "#1", "x|"]) if rng.random() < 0.1 else f"w{rng.randrange(rng.choice([60, 4000]))}" for _ in range(n)]
        docs.append((i, " ".join(words), rng.choice(["en", "fr", "", None])))
    docs += [(200 + i, docs[rng.randrange(5)][1], rng.choice(["en", "fr"])) for i in range(60)]  # a hot text
    docs += [(300, None, None), (301, "", "en"), (None, docs[0][1], "en"), (None, None, None), (7, docs[7][1], "en"), (7, docs[7][1], "fr"), (7, "other", "fr"), (302, "many " * 30_000, "de"), (303, " ".join(f"v{i}" for i in range(40_000)), "de"), (304, "\t \n", "en")]
    rng.shuffle(docs)
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 260)] + [(7, 1, 0), (7, 0, 1), (None, 1, 1), (999, 1, 1)]
    return docs, labels


@pytest.mark.parametrize("limit", ["1000000", "700"])
def test_equals_filters_one_by_one(llm_spark, limit):
    docs, labels = _documents()
    before = llm_spark.conf.get("spark.sql.cteRecursionRowLimit")
    llm_spark.conf.set("spark.sql.cteRecursionRowLimit", limit)  # the small one: each recursion holds two parts at most
    try:
        got = _run(llm_spark, docs, labels)
    finally:
        llm_spark.conf.set("spark.sql.cteRecursionRowLimit", before)
    assert len(got) == len(set(got)) == 600 * 4
    assert set(got) == _brute(docs, labels)


def test_empty_tables(llm_spark):
    assert _run(llm_spark, [], []) == []
    assert set(_run(llm_spark, [(1, "a", "en")], [])) == _brute([(1, "a", "en")], [])

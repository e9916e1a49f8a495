"""The pipeline's stages against brute force on the smallest tables."""

from __future__ import annotations

import pytest

import corpus_pipeline as pipeline
from meterlake.llm.queries import REGISTRY, SQL

from test_near_dedup import _brute as near_brute
from test_substring_dedup import _brute as window_brute
from test_tokens import _leaks

SF, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def test_every_operator_has_its_query():
    assert sorted(int(n[2:].split("_")[0]) for n in REGISTRY) == list(range(1, 14))
    assert set(SQL) <= set(REGISTRY)


def test_stages_one_by_one(llm_spark):
    docs = llm_spark.read.parquet(f"{LARGER}/documents.parquet")
    steps = dict(pipeline.STAGES)
    first = steps["toxicity"](llm_spark, docs, LARGER).checkpoint()
    assert first.columns == docs.columns and 0.5 * docs.count() < first.count() < docs.count()

    kept = {r.doc_id: r for r in steps["near_dedup"](llm_spark, first, LARGER).collect()}
    rows = [(r.doc_id, r.text) for r in first.collect()]
    assert set(kept) == {k for k, _, root in near_brute(rows, 80) if k == root}

    second = llm_spark.createDataFrame(list(kept.values()), docs.schema)
    cut = {r.doc_id: r for r in steps["substring_dedup"](llm_spark, second, LARGER).collect()}
    want = {k: (gone, text) for k, _, gone, text in window_brute([(r.doc_id, r.text) for r in kept.values()], 20)}
    for k, (gone, text) in want.items():
        assert cut[k].text == (text if gone else kept[k].text) and cut[k].n_chars == len(cut[k].text)
        assert (cut[k].lang, cut[k].source) == (kept[k].lang, kept[k].source)

    third = llm_spark.createDataFrame(list(cut.values()), docs.schema)
    items = [(r.item_id, r.text) for r in llm_spark.read.parquet(f"{LARGER}/benchmark.parquet").collect()]
    clean = {r.doc_id for r in steps["decontamination"](llm_spark, third, LARGER).collect()}
    words = {w for _, t in items for w in t.lower().split()}
    suspects = [(k, r.text) for k, r in cut.items() if sum(w in words for w in r.text.lower().split()) >= 10]
    dirty = {k for k, _, hit, _ in _leaks(suspects, items, 10) if hit}
    assert clean == set(cut) - dirty


@pytest.mark.parametrize("name", [n for n, _ in pipeline.STAGES])
def test_stages_on_edge_rows(llm_spark, name):
    rows = [(1, "one two three", None, "s", 3), (2, None, "en", None, None), (3, "", "en", "s", 0), (None, "no key", None, None, None), (1, "one two three", None, "s", 3), (5, "x " * 20000, "en", "s", 40000)]
    docs = llm_spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = dict(pipeline.STAGES)[name](llm_spark, docs, SF)
    assert out.count() > 0
    assert out.columns == docs.columns or name == "packing"
    assert dict(pipeline.STAGES)[name](llm_spark, docs.where("false"), SF).count() == 0


def test_run_places_every_kept_token(llm_spark):
    rows = pipeline.run(llm_spark, SF).collect()
    ends = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert ends.get(r.sequence_id, 0) == r.offset
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= 2048

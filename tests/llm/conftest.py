from __future__ import annotations

import pytest

from meterlake.llm.deploy import ship

EDGE = [
    (1, "one two three four five six", "x"),
    (2, None, None),
    (3, "", "x"),
    (4, "   \t\n ", None),
    (5, "one two three four five six", "x"),
    (5, "one two three four five six", "x"),
    (None, "a row without a key", "y"),
    (7, "é" * 30 + " Ünïcode 漢字 🙂 words", None),
    (8, "long " * 30000, "z"),
]


@pytest.fixture(scope="session")
def llm_spark(spark):
    ship(spark)
    return spark


@pytest.fixture()
def edge(llm_spark):
    """Nulls in every column, empty, blank and long texts, a repeated row,
    and columns whose names operators use for their results."""
    rows = [(*r, 7, "old", 1) for r in EDGE]
    return llm_spark.createDataFrame(rows, "doc_id long, text string, source string, n_words long, score string, n_chars long")

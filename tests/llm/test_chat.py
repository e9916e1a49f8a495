"""Chat windows against plain Python."""

from __future__ import annotations

import hashlib
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from meterlake.llm import chat

CONTROL = ["</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|end|>\n", "<|role:user|>\n", "\\", "|>", "<", "[", "|", "\n", "é🙂 ok"]


def _rows(seed):
    rng = random.Random(seed)
    rows = []
    for conv in range(25):
        for turn in range(rng.randrange(1, 14)):
            role = "system" if turn == 0 and rng.random() < 0.5 else rng.choice(["user", "assistant", "assistant", "tool|>", None])
            text = rng.choice([None, "", "".join(rng.choices(CONTROL, k=rng.randrange(12))), "word " * rng.randrange(40), "long " * 200])
            rows.append((conv, turn if rng.random() < 0.9 else 3, role, text))
    return rows + [(None, None, "user", "no number"), (None, 1, "assistant", "a"), (None, 1, "assistant", "a"), (7, 0, "assistant", "dup"), (7, 0, "assistant", "dup")]


def _expected(rows):
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in convs.items():
        turns.sort()
        all_text = "".join(f"{r}\n{t}\n" for _, _, r, t in turns)
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        out[conv] = (len(turns), hashlib.sha256(all_text.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


@pytest.mark.parametrize("seed,budget,history", [(1, 64, 16), (2, 40, 0), (3, 4096, 1024), (4, 5, 5)])
def test_turns_and_targets_come_back(llm_spark, seed, budget, history):
    rows = _rows(seed)
    turns = llm_spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, window long")
    windows = chat.format_chat(turns, budget=budget, history=history)
    got = {r.conv_id: r for r in chat.digest(windows).collect()}
    want = _expected(rows)
    assert {k: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for k, r in got.items()} == want
    held = windows.collect()
    assert {k: sum(len(w.formatted) for w in held if w.conv_id == k) for k in want} == {k: r.formatted_chars for k, r in got.items()}
    for w in held:
        parts = w.formatted.split(chat.END)[:-1]
        tokens = [len(re.findall(r"\w+|[^\w\s]", re.sub(r"\\", "", p.split(chat.NAMED, 1)[1]), re.ASCII)) for p in parts]
        assert all(p.startswith(chat.OPEN) for p in parts) and w.formatted.count("<|") == 2 * len(parts)
        roles = [p[len(chat.OPEN) :].split("|>", 1)[0] for p in parts]
        assert len(w.loss_spans) == sum(r == "assistant" for r in roles[w.n_repeated :])
        assert w.over_budget == (w.n_tokens > budget) and len(tokens) == len(parts)


def test_windows_keep_the_budget(llm_spark):
    rows = [(1, 0, "system", "be kind")] + [(1, i, "user" if i % 2 else "assistant", "w " * (i % 9)) for i in range(1, 200)]
    windows = chat.format_chat(llm_spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), budget=60, history=20).orderBy("window").collect()
    assert len(windows) > 10
    assert not any(w.over_budget for w in windows)
    for w in windows[1:]:
        assert w.formatted.startswith("<|role:system|>\nbe kind<|end|>\n") and w.n_repeated > 1
    assert [w.window for w in windows] == list(range(1, len(windows) + 1))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from(CONTROL + ["a"]), max_size=14).map("".join), min_size=1, max_size=12))
def test_escape_is_reversible(llm_spark, texts):
    df = llm_spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escape("t").alias("e")).select("t", "e", chat.unescape("e").alias("u"))
    for r in df.collect():
        assert r.u == r.t
        assert not re.search(r"<\||\|>|</?s>|\[/?INST\]|<</?SYS>>", r.e)


def test_empty(llm_spark):
    none = llm_spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.digest(chat.format_chat(none)).count() == 0


def test_no_python_in_the_plan(llm_spark):
    turns = llm_spark.createDataFrame(_rows(1), "conv_id long, turn long, role string, text string")
    plan = chat.digest(chat.format_chat(turns))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
    assert plan.count("Exchange hashpartitioning") == 1

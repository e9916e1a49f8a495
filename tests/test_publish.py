"""The publish job: line numbers and ids that a rerun gives again."""

from __future__ import annotations

from collections import Counter

from meterlake.__main__ import main
from meterlake.plans import jobs
from meterlake.schema import RAW_HEADER
from meterlake.sources import messages, text
from meterlake.streaming.aggregates import drop_repeats
from pyspark.sql import types as T

import pytest

HEADER = ";".join(RAW_HEADER)
LINE = "16/12/2006;17:{:02d}:00;4.2;0.4;234.8;18.4;0;1;17"
CARRY = [T.StructField(jobs.MESSAGE_ID, T.StringType())]


def _files(tmp_path, lines=2000):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "a.txt").write_text("\n".join([HEADER, "", *[LINE.format(i % 60) for i in range(lines)]]) + "\n")
    (raw / "b.txt").write_text("\n".join([HEADER, LINE.format(1), LINE.format(1), "16/12/2006;17:09:00;?;?;?;?;?;?;?"]))
    (raw / "empty.txt").write_text("")
    return str(raw)


def _numbers(df):
    return sorted((r.file.rsplit("/", 1)[1], r.line, r.value) for r in df.collect())


def test_line_numbers_do_not_depend_on_splits(spark, tmp_path):
    raw = _files(tmp_path)
    key = "spark.sql.files.maxPartitionBytes"
    want = sorted(
        (name, i, line)
        for name in ("a.txt", "b.txt")
        for i, line in enumerate((tmp_path / "raw" / name).read_text().splitlines())
    )
    before = spark.conf.get(key)
    try:
        for size in ("700", "5000", "128m"):
            spark.conf.set(key, size)
            lines = text.numbered_lines(spark, raw)
            assert _numbers(lines) == want, size
    finally:
        spark.conf.set(key, before)


def test_publishing_twice_gives_the_input_once(spark, tmp_path, monkeypatch):
    raw, spool = _files(tmp_path, 300), str(tmp_path / "spool")
    monkeypatch.setattr("meterlake.__main__.build_session", lambda name: spark)
    for _ in range(2):
        assert main(["publish", "--raw", raw, "--spool", spool]) == 0
    sent = messages.parse_json(messages.read_spool(spark, spool, stream=False), carry=CARRY)
    assert sent.count() == 2 * 303
    got = drop_repeats(sent).drop(jobs.MESSAGE_ID)
    want = text.read_raw(spark, raw)
    assert Counter(map(str, got.collect())) == Counter(map(str, want.collect()))


def test_publish_needs_one_target(spark, tmp_path):
    with pytest.raises(ValueError, match="spool folder or"):
        jobs.publish_job(spark, str(tmp_path))


def test_messages_are_keyed_by_id(spark, tmp_path):
    from meterlake.sinks.messages import to_messages

    rows = jobs.readings_to_publish(spark, _files(tmp_path, 5))
    got = to_messages(rows, carry=(jobs.MESSAGE_ID,), key=jobs.MESSAGE_ID)
    assert got.columns == ["key", "value"]
    keys = [r.key for r in got.collect()]
    assert len(set(keys)) == len(keys) == 8

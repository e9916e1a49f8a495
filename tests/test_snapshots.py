"""Snapshot tables: folding beside streams and readers, failures between
write and switch, replays, and removal of what has left the table."""

from __future__ import annotations

import os
import time

import pytest
from pyspark.sql import types as T

from meterlake.__main__ import main
from meterlake.operators import clean, rollup
from meterlake.plans import jobs
from meterlake.schema import PARTITION_COLUMNS
from meterlake.sinks.messages import to_messages, write_spool
from meterlake.sinks.snapshots import Conflict, SnapshotTable, start_landing
from meterlake.sources import messages
from meterlake.sources.readings import readings
from meterlake.streaming import ingest

from data_dirs import SF_SMALL

SCHEMA = T.StructType([T.StructField("x", T.LongType()), T.StructField("name", T.StringType()), T.StructField("part", T.IntegerType())])
NOW = {"availableNow": True}


def _table(spark, path):
    return SnapshotTable(spark, str(path), SCHEMA, partition_by=("part",))


def _batch(spark, start, n=6):
    return spark.createDataFrame([(i, f"n{i}" if i % 5 else None, i % 3 if i % 4 else None) for i in range(start, start + n)], SCHEMA)


def _rows(df):
    return sorted(map(str, map(tuple, df.collect())))


def test_land_fold_read(spark, tmp_path):
    table = _table(spark, tmp_path / "t")
    assert table.read().count() == 0 and table.fold().version == 0
    all_rows = []
    for i in range(4):
        assert table.land(_batch(spark, 10 * i), i)
        all_rows += _rows(_batch(spark, 10 * i))
    assert table.land(_batch(spark, 99, 0), 4)  # a batch without rows is a batch
    early = table.read()
    before = table.record()
    after = table.fold()
    assert len(before.live) == 5 and len(after.live) == 1 and after.version == before.version + 1
    assert _rows(table.read()) == sorted(all_rows) == _rows(table.read(before.version))
    assert _rows(early) == sorted(all_rows)  # a reader from before the switch
    assert "PartitionFilters: [isnotnull(part" in table.read().where("part = 1")._jdf.queryExecution().toString()
    assert table.vacuum(3600) == []
    assert sorted(table.vacuum(0)) == sorted(before.live)
    assert _rows(table.read()) == sorted(all_rows) and table.record().left == {}
    # batches go on after the fold; replays of folded ones are known
    assert not table.land(_batch(spark, 30), 3)
    assert table.land(_batch(spark, 50), 5)
    assert table.read().count() == len(all_rows) + 6


def test_killed_between_write_and_switch(spark, tmp_path, monkeypatch):
    table = _table(spark, tmp_path / "t")
    for i in range(3):
        table.land(_batch(spark, 10 * i), i)
    want, version = _rows(table.read()), table.record().version

    def die(self, record):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(SnapshotTable, "_publish", die)
        with pytest.raises(KeyboardInterrupt):
            table.fold()
        with pytest.raises(KeyboardInterrupt):
            table.land(_batch(spark, 30), 3)
    again = _table(spark, tmp_path / "t")
    assert again.record().version == version and _rows(again.read()) == want
    assert again.land(_batch(spark, 30), 3)  # the stream replays the batch
    again.fold()
    assert _rows(again.read()) == sorted(want + _rows(_batch(spark, 30)))
    assert len(os.listdir(tmp_path / "t" / "data")) == 7
    again.vacuum(0)  # also the two that never were in the table
    assert len(os.listdir(tmp_path / "t" / "data")) == 1 and again.read().count() == 24


def test_batches_landing_while_a_fold_runs_stay(spark, tmp_path):
    table = _table(spark, tmp_path / "t")
    for i in range(2):
        table.land(_batch(spark, 10 * i), i)

    def meanwhile(rows):
        _table(spark, tmp_path / "t").land(_batch(spark, 70), 2)
        return rows

    record = table.fold(meanwhile)
    assert len(record.live) == 2 and record.landed == {"stream": 2}
    assert table.read().count() == 18


def test_two_folds_do_not_both_win(spark, tmp_path):
    table = _table(spark, tmp_path / "t")
    for i in range(2):
        table.land(_batch(spark, 10 * i), i)

    def other(rows):
        _table(spark, tmp_path / "t").fold()
        return rows

    with pytest.raises(Conflict):
        table.fold(other)
    assert table.read().count() == 12
    assert not table._publish(table.record())  # a version is published once


def test_fold_job_under_a_running_stream(spark, tmp_path):
    spool, root = str(tmp_path / "spool"), str(tmp_path / "t")
    data = readings(spark, SF_SMALL)
    table = SnapshotTable(spark, root, partition_by=("year", "month"))
    write_spool(to_messages(data.where("event_id % 3 = 0")), spool)
    parsed = messages.parse_json(messages.read_spool(spark, spool))
    query = start_landing(table, ingest.to_stored(parsed), str(tmp_path / "ck"), {"processingTime": "200 milliseconds"})
    try:
        for i in (1, 2):
            write_spool(to_messages(data.where(f"event_id % 3 = {i}")), spool)
            query.processAllAvailable()
            jobs.fold_job(spark, root, ("year", "month"), keep_seconds=0)
            assert query.isActive and len(table.record().live) == 1
    finally:
        query.stop()
    whole = ingest.to_stored(messages.parse_json(to_messages(data)))
    assert _rows(table.read()) == _rows(whole.select(*table.schema.names))
    assert main(["fold", "--root", root, "--partition-by", "year,month"]) == 0


def test_partials_folded_by_merging(spark, tmp_path):
    data = clean.clean_stream(readings(spark, SF_SMALL))
    schema = rollup.hourly_rollup(data).schema
    table = SnapshotTable(spark, str(tmp_path / "t"), schema, partition_by=("year", "month"))
    for i in range(3):
        table.land(rollup.hourly_rollup(data.where(f"event_id % 3 = {i}")), i)
    partials = table.read().count()
    table.fold(lambda rows: rollup.merge(rows, PARTITION_COLUMNS, with_m2=True))
    assert table.read().count() == rollup.hourly_rollup(data).count() < partials
    for key, value in {tuple(r[:3]): r for r in rollup.daily_features(table.read()).collect()}.items():
        own = rollup.daily_features(rollup.hourly_rollup(data.where(f"year = {key[0]} AND month = {key[1]} AND day = {key[2]}"))).first()
        assert own.voltage_stability_daily == pytest.approx(value.voltage_stability_daily)
        break


def test_records_are_small_and_old_ones_stay_readable(spark, tmp_path):
    table = _table(spark, tmp_path / "t")
    began = time.time()
    for i in range(3):
        table.land(_batch(spark, 10 * i), i)
    table.fold()
    assert table.versions() == [1, 2, 3, 4]
    assert [len(table.record(v).live) for v in table.versions()] == [1, 2, 3, 1]
    assert all(t >= began for t in table.record().left.values())

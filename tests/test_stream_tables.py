"""Streams that land in snapshot tables: rejected rows, late rows, open hours
and alerts; failures between two commits, replays, NULLs, ties and repeats."""

from __future__ import annotations

import statistics
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from meterlake.operators import clean, insights
from meterlake.schema import METER
from meterlake.sinks.messages import write_spool
from meterlake.sources import messages
from meterlake.sources.readings import readings
from meterlake.streaming import aggregates, alerts, late, live, screening

from data_dirs import SF_SMALL

NOW = {"availableNow": True}
PARSED = "datetime timestamp, " + ", ".join(f"{m} double" for m in METER.measures)
T0 = datetime(2024, 3, 1, 10, 0)


def _reading(time, active=1.0, **other):
    row = {"datetime": time, **dict.fromkeys(METER.measures, 1.0), METER.active: active, **other}
    return tuple(row.values())


def _rows(df):
    return Counter(map(str, map(tuple, df.collect())))


# --- rejected rows ----------------------------------------------------------------


def test_screen_loses_nothing_and_agrees_with_the_policy_and_the_counts(spark):
    rows = readings(spark, SF_SMALL)
    out = clean.screen(rows).persist()
    kept = out.where("outcome = 'stored'").drop("outcome", "reasons")
    assert _rows(kept) == _rows(clean.clean_stream(rows).select(*kept.columns))
    bad = out.where("outcome = 'rejected'")
    assert bad.count() > 0 and kept.count() + bad.count() == rows.count()
    as_read = rows.join(bad.select("event_id"), "event_id", "left_semi").select(*rows.columns)
    assert _rows(bad.select(*rows.columns)) == _rows(as_read)
    counts = {r.reason: r.rejected for r in screening.reject_counts(bad).collect()}
    quality = insights.quality(rows).first().asDict()
    assert counts == {k: v for k, v in quality.items() if k.startswith("missing_") and v}
    out.unpersist()


def test_screen_names_all_a_row_lacks(spark):
    nan = float("nan")
    rows = [_reading(None), _reading(T0, None, voltage=nan), _reading(T0, -1.0), _reading(T0, -1.0), _reading(None, -2.0)]
    got = clean.screen(spark.createDataFrame(rows, PARSED)).collect()
    found = Counter((tuple(r.reasons), r.outcome, r.global_active_power, r.zone) for r in got)
    assert found == {
        (("missing_datetime",), "rejected", 1.0, None): 1,
        (("missing_global_active_power", "missing_voltage"), "rejected", None, None): 1,
        ((), "stored", 0.0, "zone1"): 2,
        (("missing_datetime",), "rejected", -2.0, None): 1,
    }
    assert clean.screen(spark.createDataFrame([], PARSED)).count() == 0
    with pytest.raises(ValueError, match="reasons"):
        clean.screen(spark.createDataFrame([], PARSED + ", reasons string"))


def test_screened_stream_keeps_the_text_of_what_it_rejects(spark, tmp_path):
    good = '{"datetime":"2024-03-01 10:00:00",' + ",".join(f'"{m}":1.5' for m in METER.measures) + "}"
    lines = [good, good, "not json", '{"datetime":"2024-03-01 10:01:00"}']
    write_spool(spark.createDataFrame([(x,) for x in lines], "value string"), str(tmp_path / "spool"))
    parsed = messages.parse_json(messages.read_spool(spark, str(tmp_path / "spool")), raw="message")
    table = screening.screened_table(spark, str(tmp_path / "t"), parsed.schema)
    for _ in range(2):  # the second run finds nothing new
        screening.start_screening(table, parsed, str(tmp_path / "c"), NOW).awaitTermination()
    assert screening.stored(table).count() == 2
    bad = {r.message: r.reasons for r in screening.rejected(table).collect()}
    assert set(bad) == set(lines[2:])
    assert "missing_datetime" in bad["not json"] and "missing_datetime" not in bad[lines[3]]
    plan = screening.stored(table)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(outcome" in plan


# --- late rows --------------------------------------------------------------------

SENT = "id long, datetime timestamp, x string"
DELAY = timedelta(hours=1)


def _sent(spark, *rows):
    return spark.createDataFrame([(i, t if t is None else T0 + timedelta(minutes=t), x) for i, t, x in rows], SENT)


def _once(table):
    return sorted(((r.id, r.x, r.late) for r in table.read().collect()), key=str)


def test_late_rows_are_stored_and_copies_of_any_age_dropped(spark, tmp_path):
    table = late.once_table(spark, str(tmp_path / "t"), _sent(spark).schema)
    batches = [
        _sent(spark, (1, 0, "a"), (1, 0, "a"), (2, 120, "b")),
        _sent(spark, (3, 60, "late: an hour behind"), (4, 61, "in time"), (1, 0, "a")),
        _sent(spark),  # without rows
        _sent(spark, (3, 60, "late: an hour behind"), (5, -5000, "late"), (None, 130, "n"), (None, 130, "n"), (6, None, "no time")),
        _sent(spark, (None, 130, "n"), (6, None, "no time"), (2, 121, "same key, other time")),
    ]
    for i, b in enumerate(batches):
        assert late.land_once(table, b, i, ("id",), DELAY)
        assert not late.land_once(table, b, i, ("id",), DELAY)  # a replay
        if i == 2:
            table.fold()
    assert _once(table) == sorted(
        [
            (1, "a", False), (2, "b", False), (3, "late: an hour behind", True), (4, "in time", False), (5, "late", True),
            (None, "n", False), (6, "no time", False), (2, "same key, other time", False),
        ],
        key=str,
    )
    assert late.late(table).count() == 2 and late.in_time(table).count() == 6
    assert late.late(table).columns == ["id", "datetime", "x"]


def test_late_rows_need_keys_and_free_names(spark, tmp_path):
    table = late.once_table(spark, str(tmp_path / "t"), _sent(spark).schema)
    with pytest.raises(ValueError, match="missing"):
        late.land_once(table, _sent(spark), 0, ("nothing",), DELAY)
    with pytest.raises(ValueError, match="late"):
        late.land_once(table, _sent(spark).withColumn("late", F.lit(1)), 0, ("id",), DELAY)


def test_a_batch_that_failed_before_its_commit_is_judged_alike(spark, tmp_path, monkeypatch):
    table = late.once_table(spark, str(tmp_path / "t"), _sent(spark).schema)
    late.land_once(table, _sent(spark, (1, 200, "a")), 0, ("id",), DELAY)
    batch = _sent(spark, (2, 100, "late"), (3, 900, "new"), (1, 200, "a"))
    with monkeypatch.context() as m:
        m.setattr(table, "commit", lambda change: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            late.land_once(table, batch, 1, ("id",), DELAY)
    assert late.land_once(table, batch, 1, ("id",), DELAY)
    assert _once(table) == [(1, "a", False), (2, "late", True), (3, "new", False)]


def test_once_stream_across_a_restart(spark, tmp_path):
    spool = str(tmp_path / "spool")
    table = None
    for i, minutes in enumerate(([0, 300], [10, 299, 300], [10, 5])):
        lines = [f'{{"datetime":"{T0 + timedelta(minutes=t)}","{METER.active}":{t}}}' for t in minutes]
        write_spool(spark.createDataFrame([(x,) for x in lines], "value string"), spool)
        parsed = messages.parse_json(messages.read_spool(spark, spool))
        table = table or late.once_table(spark, str(tmp_path / "t"), parsed.schema)
        late.start_once(table, parsed, str(tmp_path / "c"), ("datetime",), DELAY, NOW).awaitTermination()
    got = {(r.global_active_power, r.late) for r in table.read().collect()}
    assert got == {(0.0, False), (300.0, False), (10.0, True), (299.0, False), (5.0, True)} and table.read().count() == 5


# --- the open hour ----------------------------------------------------------------


def test_open_hour_is_readable_corrected_and_survives_folds(spark, tmp_path):
    spool, table, dropped = str(tmp_path / "spool"), None, 0
    seen = []
    for minutes in ([5, 10], [20, 65], [30], [400], [-600, 410]):
        lines = [f'{{"datetime":"{T0 + timedelta(minutes=t)}","{METER.active}":{t}}}' for t in minutes]
        write_spool(spark.createDataFrame([(x,) for x in lines], "value string"), spool)
        parsed = messages.parse_json(messages.read_spool(spark, spool))
        table = table or live.live_table(spark, str(tmp_path / "t"), parsed.schema)
        query = live.start_live_windows(table, parsed, str(tmp_path / "c"), delay="1 hour", trigger=NOW)
        query.awaitTermination()
        dropped += aggregates.late_rows(query)
        seen.append({r.window_start: r.record_count for r in live.current(table).collect()})
        if len(seen) == 2:
            live.fold(table)
    hour = [T0 + timedelta(hours=h) for h in range(8)]
    assert seen[0] == {hour[0]: 2}
    assert seen[1] == {hour[0]: 3, hour[1]: 1}  # the open hour, corrected
    assert seen[2] == {hour[0]: 4, hour[1]: 1}  # late within the delay
    assert seen[3] == {**seen[2], hour[6]: 1}
    assert seen[4] == {**seen[2], hour[6]: 2} and dropped == 1  # behind the watermark: counted, no window


# --- alerts -----------------------------------------------------------------------

LOADS = PARSED + ", meter string"


def _day(spark, day, load, meter="m", extra=()):
    return spark.createDataFrame([(*_reading(T0 + timedelta(days=day), load), meter), *extra], LOADS)


def test_alerts_judge_against_the_batches_before(spark, tmp_path):
    loads = [1.0, 2.0, 1.5, 9.0, 2.0, 9.0, 30.0]
    tables = alerts.AlertTables(spark, str(tmp_path / "t"), _day(spark, 0, 1.0).schema, by=("meter",))
    for i, load in enumerate(loads):
        other = [(*_reading(T0 + timedelta(days=i), 5.0), None), (*_reading(None, 99.0), "m"), (*_reading(T0, None), "m")]
        for _ in range(2):  # the second is a replay
            tables.judge_batch(_day(spark, i, load, extra=other), i, k=2.0, fold_at=3)
    tables.judge_batch(_day(spark, 0, 1.0).limit(0), len(loads), fold_at=3)
    got = {r.batch: r for r in tables.alerts.read().where("meter = 'm'").collect()}
    for i in range(len(loads)):
        before = loads[:i]
        bound = statistics.mean(before) + 2 * statistics.stdev(before) if i >= 2 else float("inf")
        assert (i in got) == (loads[i] > bound), i
        if i in got:
            assert got[i].threshold == pytest.approx(bound) and got[i].baseline_n == i
    assert set(got) == {3, 6}
    assert tables.alerts.read().where("meter IS NULL").count() == 0  # constant loads are no peaks
    assert len(tables.baseline.record().live) <= 3


def test_a_failure_between_alerts_and_baseline_is_replayed(spark, tmp_path, monkeypatch):
    tables = alerts.AlertTables(spark, str(tmp_path / "t"), _day(spark, 0, 1.0).schema)
    for i, load in enumerate([1.0, 2.0]):
        tables.judge_batch(_day(spark, i, load), i)
    with monkeypatch.context() as m:
        m.setattr(tables.baseline, "land", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            tables.judge_batch(_day(spark, 2, 50.0), 2)
    tables.judge_batch(_day(spark, 2, 50.0), 2)
    assert tables.alerts.read().count() == 1
    row = alerts.merge_moments(tables.baseline.read()).first()
    assert row.n == 3 and row["mean"] == pytest.approx(53 / 3)
    assert row.m2 == pytest.approx(statistics.variance([1.0, 2.0, 50.0]) * 2)

"""A hot key: meter 0 holds a third of all readings. Results stay exact and
the hot meter's raw rows never reach a shuffle."""

from __future__ import annotations

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from meterlake.operators import clean, insights, reports
from meterlake.sources.readings import readings

from data_dirs import SF_CHECK

BY = ("meter_id",)


@pytest.fixture(scope="module")
def hot(spark):
    data = readings(spark, SF_CHECK, keep_meter=True).withColumn(
        "meter_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("meter_id") + 1)
    )
    return clean.clean_stream(data)


def _shuffle_records(df) -> list[int]:
    """Records written by each shuffle of the final plan of an executed query."""
    plan = df._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.finalPhysicalPlan()
    out = []

    def walk(node):
        name = node.getClass().getSimpleName()
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        if name == "ShuffleExchangeExec":
            m = node.metrics().get("shuffleRecordsWritten")
            if m.isDefined():
                out.append(m.get().value())
        it = node.children().iterator()
        while it.hasNext():
            walk(it.next())

    walk(plan)
    return out


def test_hot_meter_holds_a_third(hot):
    counts = {r.meter_id: r["count"] for r in hot.groupBy("meter_id").count().collect()}
    assert counts[0] * 3 >= sum(counts.values()) * 0.95


def test_latest_per_meter_exact_and_limited_before_shuffle(hot):
    k = 5
    df = reports.latest(hot, limit=k, by=BY)
    got = defaultdict(list)
    for r in df.collect():
        got[r.meter_id].append(r.datetime)
    rows = hot.select("meter_id", "datetime", "event_id").collect()
    want = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.datetime, r.event_id), reverse=True):
        if len(want[r.meter_id]) < k:
            want[r.meter_id].append(r.datetime)
    assert dict(got) == dict(want)
    meters = len(want)
    tasks = hot.rdd.getNumPartitions()
    # each map task sends at most k rows per meter, whatever the hot meter holds
    assert max(_shuffle_records(df)) <= k * meters * tasks < hot.count()


def test_hour_profile_per_meter_sends_partials_only(hot):
    df = reports.hour_profile(hot, by=BY)
    got = {(r.meter_id, r.hour): r.record_count for r in df.collect()}
    want = defaultdict(int)
    for r in hot.select("meter_id", "hour").collect():
        want[(r.meter_id, r.hour)] += 1
    assert got == dict(want)
    groups, tasks = len(want), hot.rdd.getNumPartitions()
    assert _shuffle_records(df)[-1] <= groups * tasks < hot.count()


def test_peaks_and_day_compare_with_hot_meter(hot):
    hourly = defaultdict(list)
    for r in insights.hourly_load(hot, by=BY).collect():
        hourly[r.meter_id].append(r)
    peaks = {(r.meter_id, r.hour_start) for r in insights.peaks(hot, k=1.0, by=BY).collect()}
    import statistics

    want = set()
    for meter, rows in hourly.items():
        by_hour = defaultdict(list)
        for r in rows:
            by_hour[r.hour_start.hour].append(r.load)
        for r in rows:
            loads = by_hour[r.hour_start.hour]
            if len(loads) > 1 and r.load > statistics.mean(loads) + statistics.stdev(loads) + 1e-12:
                want.add((meter, r.hour_start))
    assert peaks == want
    compare = insights.day_compare(hot, by=BY)
    assert compare.filter(F.col("meter_id") == 0).count() == 23

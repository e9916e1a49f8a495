"""Plan shape: what Catalyst must do for these operators to scale."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from meterlake.plans.queries import REGISTRY
from meterlake.operators import insights, reports
from meterlake.plans.joins import bounded_broadcast
from meterlake.plans.queries import WRITES_ON_CALL
from meterlake.sinks.files import write_parquet
from meterlake.sources.readings import readings
from meterlake.streaming import ingest

from data_dirs import SF_SMALL

# Registered queries that run a write or a stream when called.
EAGER = WRITES_ON_CALL
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas", "MapInPandas", "PythonMapInArrow")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _walk(node, acc):
    name = node.getClass().getSimpleName()
    if name.endswith("QueryStageExec"):
        return _walk(node.plan(), acc)
    if name == "ReusedExchangeExec":
        return _walk(node.child(), acc)
    if name == "FileSourceScanExec":
        metrics = node.metrics()

        def value(key):
            m = metrics.get(key)
            return m.get().value() if m.isDefined() else None

        acc.append({"partitions": value("numPartitions"), "files": value("numFiles"),
                    "schema": node.requiredSchema().simpleString()})
    it = node.children().iterator()
    while it.hasNext():
        _walk(it.next(), acc)
    return acc


def executed_scans(df) -> list[dict]:
    """Scan metrics of the final adaptive plan of an executed query."""
    final = df._jdf.queryExecution().executedPlan()
    if final.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        final = final.finalPhysicalPlan()
    return _walk(final, [])


@pytest.fixture(scope="module")
def stored_path(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stored") / "t")
    write_parquet(ingest.to_stored(readings(spark, SF_SMALL)), path, partition_by=("year", "month", "day", "hour"))
    return path


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - EAGER))
def test_no_python_in_plan(spark, name):
    p = plan(entry.queries()[name](spark, SF_SMALL))
    assert not any(node in p for node in PYTHON_NODES), name


@pytest.mark.parametrize("name", ["latest", "timeseries", "latest_text", "submeter_latest"])
def test_top_k_is_take_ordered(spark, name):
    assert "TakeOrderedAndProject" in plan(entry.queries()[name](spark, SF_SMALL))


@pytest.mark.parametrize("name", ["statistics", "hour_profile", "hourly_features", "daily_features", "zone_counts"])
def test_partial_aggregation_before_shuffle(spark, name):
    p = plan(entry.queries()[name](spark, SF_SMALL))
    assert "partial_" in p


def test_stored_hour_profile_reads_no_timestamp(spark, stored_path):
    df = spark.read.parquet(stored_path)
    p = plan(reports.hour_profile(df))
    scan = [line for line in p.splitlines() if "FileScan parquet" in line][0]
    assert "ReadSchema: struct<global_active_power:double,voltage:double>" in scan
    assert "PartitionFilters: [isnotnull(hour" in scan


def test_statistics_prunes_columns(spark, stored_path):
    p = plan(reports.statistics(spark.read.parquet(stored_path)))
    scan = [line for line in p.splitlines() if "FileScan parquet" in line][0]
    assert "global_reactive_power" not in scan.split("ReadSchema:")[1]
    assert "zone" not in scan.split("ReadSchema:")[1]


def test_last_hours_on_stored_table_prunes_partitions(spark, stored_path):
    df = spark.read.parquet(stored_path)
    fast = insights.timeseries_hours(df, hours=24, partitioned=True)
    slow = insights.timeseries_hours(df, hours=24, partitioned=False)
    assert sorted(map(tuple, fast.collect())) == sorted(map(tuple, slow.collect()))
    total = df.select("year", "month", "day", "hour").distinct().count()
    (main,) = executed_scans(fast)
    assert total > 100 and main["partitions"] <= 25  # the window's hours only


def test_forecast_on_stored_table(spark, stored_path):
    df = spark.read.parquet(stored_path)
    rows = insights.forecast_profile(df).collect()
    assert len(rows) == 24 and len({r.hour_start for r in rows}) == 24


def test_bounded_broadcast_only_with_static_bound(spark):
    small = spark.range(24).withColumnRenamed("id", "hour")
    big = spark.range(1000).selectExpr("id % 24 AS hour", "id")
    assert "BroadcastHashJoin" in plan(big.join(bounded_broadcast(small, 24), "hour"))
    assert bounded_broadcast(small, None) is small
    assert bounded_broadcast(small, 10**9) is small


@pytest.mark.parametrize("by", [(), ("meter_id",)])
def test_peaks_scans_once_without_join(spark, by):
    df = insights.peaks(readings(spark, SF_SMALL, keep_meter=True), by=by)
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 1
    assert "Join" not in final


@pytest.mark.parametrize("by", [(), ("meter_id",)])
def test_forecast_scans_once_without_join(spark, by):
    df = insights.forecast_profile(readings(spark, SF_SMALL, keep_meter=True), by=by)
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 1
    assert "Join" not in final


def test_day_compare_scans_once(spark):
    df = insights.day_compare(readings(spark, SF_SMALL))
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 1
    assert "Join" not in final


@pytest.mark.parametrize("name", ["latest_by_meter", "timeseries_by_meter"])
def test_per_meter_top_k_limits_before_shuffle(spark, name):
    limits = [line for line in plan(entry.queries()[name](spark, SF_SMALL)).splitlines() if "WindowGroupLimit" in line]
    assert any(line.rstrip().endswith("Partial") for line in limits)
    assert any(line.rstrip().endswith("Final") for line in limits)


def test_latest_on_stored_table_without_row_id(spark, stored_path):
    df = spark.read.parquet(stored_path)
    assert "event_id" not in df.columns
    rows = reports.latest(df, limit=10).collect()
    assert len(rows) == 10
    assert [r.datetime for r in rows] == sorted((r.datetime for r in rows), reverse=True)


@pytest.mark.parametrize("report", ["latest", "timeseries"])
def test_newest_reports_on_stored_table_read_newest_partitions(spark, stored_path, report):
    df = spark.read.parquet(stored_path)
    fn = getattr(reports, report)
    fast, slow = fn(df, limit=20, partitioned=True), fn(df, limit=20)
    assert fast.collect() == slow.collect()
    scans = executed_scans(fast)
    full = [s for s in scans if "global_active_power" in s["schema"]]
    assert len(full) == 1 and full[0]["partitions"] <= 21

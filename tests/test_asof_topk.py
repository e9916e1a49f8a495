"""As-of join, two-level top-k and bounds from the partition list."""

from __future__ import annotations

import datetime as dt
import glob
import random

import pytest
from pyspark.sql import functions as F

from meterlake.operators import insights, reports
from meterlake.operators.asof import asof_join
from meterlake.plans import catalog, pruning
from meterlake.schema import PARTITION_COLUMNS
from meterlake.sinks.files import write_parquet
from meterlake.sources.readings import readings
from meterlake.streaming import ingest

from data_dirs import SF_SMALL

START = dt.datetime(2024, 1, 1)


def _brute(left, right, tolerance, by):
    out = []
    for key, i, t in left:
        fit = [(s, v) for k, s, v in right if s is not None and t is not None and s <= t and (not by or k == key) and (t - s).total_seconds() <= tolerance]
        best = max(fit, key=lambda x: (x[0], x[1] is not None, x[1] or 0), default=None)
        out.append((i, best[1] if best else None, (t - best[0]).total_seconds() if best else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("by", [(), ("k",)])
@pytest.mark.parametrize("tolerance,block", [(600, 600), (60, 5), (7200, 60), (0, 60)])
def test_asof_join(spark, by, tolerance, block):
    rng = random.Random(tolerance + len(by))
    when = lambda: START + dt.timedelta(seconds=rng.choice([rng.randrange(20_000), 60 * rng.randrange(300)]))
    left = [(rng.choice([1, 2, None]), i, when()) for i in range(150)] + [(1, 200 + i, START + dt.timedelta(minutes=33)) for i in range(80)] + [(1, 300, None)]
    right = [(rng.choice([1, 2, None]), when(), rng.choice([None, 1.0, 2.0, 3.0])) for _ in range(60)] + [(1, None, 5.0), (1, START + dt.timedelta(minutes=33), 1.5), (1, START + dt.timedelta(minutes=33), 0.5)]
    a = spark.createDataFrame([(*r, -1.0, "x") for r in left], "k int, i int, datetime timestamp, price double, _t string")
    b = spark.createDataFrame(right, "k int, datetime timestamp, price double")
    got = asof_join(a, b, ["price"], tolerance, by=by, block_seconds=block)
    assert got.columns == ["k", "i", "datetime", "_t", "price", "age_seconds"]
    assert sorted(((r.i, r.price, r.age_seconds) for r in got.collect()), key=str) == _brute(left, right, tolerance, by)


def test_asof_join_with_an_empty_side(spark):
    a = spark.createDataFrame([(1, START)], "i int, datetime timestamp")
    b = spark.createDataFrame([], "datetime timestamp, price double")
    assert [tuple(r) for r in asof_join(a, b, ["price"], 60).collect()] == [(1, START, None, None)]
    assert asof_join(a.where("false"), b, ["price"], 60).count() == 0


def test_weather_rows_of_an_hour_count_once(spark):
    data = readings(spark, SF_SMALL)
    hours = insights.hourly_load(data).select(F.col("hour_start").alias("h"), F.hour("hour_start").cast("double").alias("t"))
    once, twice = insights.weather_impact(data, hours).first(), insights.weather_impact(data, hours.union(hours)).first()
    assert tuple(once) == tuple(twice)


# --- two-level top-k ---------------------------------------------------------------


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_k_merges_buckets_not_splits(spark):
    df = spark.range(0, 5000, 1, 40).select((F.col("id") % 7).alias("x"), "id")
    order = [F.col("x").desc(), F.col("id").desc()]
    got = reports.top_k(df, order, 10, buckets=4)
    assert [r.id for r in got.collect()] == [r.id for r in df.orderBy(*order).limit(10).collect()]
    plan = _plan(got)
    assert "WindowGroupLimit [_bucket" in plan and "Partial" in plan and "TakeOrderedAndProject" in plan
    # what the last merge reads: k rows a bucket at most
    inner = df.withColumn("_bucket", F.pmod(F.spark_partition_id(), F.lit(4)))
    sizes = [r["count"] for r in reports.top_k(inner, order, 10, ["_bucket"]).groupBy("_bucket").count().collect()]
    assert len(sizes) == 4 and max(sizes) == 10


@pytest.mark.parametrize("k", [1, 5, 1500])
def test_top_k_ties_and_nulls(spark, k):
    rows = [(random.Random(i).choice([1, 2, 3, None]), i) for i in range(400)] + [(3, 1000)] * 3
    df = spark.createDataFrame(rows, "x int, id int").repartition(9)
    order = [F.col("x").desc_nulls_last(), F.col("id").desc()]
    want = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), -r[1]))[:k]
    assert [tuple(r) for r in reports.top_k(df, order, k).collect()] == want


# --- bounds from the catalog -----------------------------------------------------------


@pytest.fixture()
def table(spark, tmp_path):
    path = str(tmp_path / "stored")
    write_parquet(ingest.to_stored(readings(spark, SF_SMALL)), path, partition_by=PARTITION_COLUMNS)
    catalog.drop_table(spark, "bounds_tbl")
    catalog.ensure_table(spark, "bounds_tbl", path)
    yield path
    catalog.drop_table(spark, "bounds_tbl")


def _spoil(path, keep):
    """Make every file outside the named hours unreadable."""
    spoiled = 0
    for f in glob.glob(f"{path}/year=*/month=*/day=*/hour=*/*.parquet"):
        y, m, d, h = (int(p.split("=")[1]) for p in f.split("/")[-5:-1])
        if not keep(dt.datetime(y, m, d, h)):
            with open(f, "wb") as out:
                out.write(b"no parquet")
            spoiled += 1
    assert spoiled > 100


def test_newest_rows_open_no_other_file(spark, table):
    whole = catalog.read_table(spark, "bounds_tbl")
    want = reports.latest(whole, 20).collect(), reports.timeseries(whole, 20).collect(), insights.timeseries_hours(whole, 6).collect()
    newest = max(r.datetime for r in want[0])
    hours = pruning.newest_hours_of_table(spark, "bounds_tbl", 20)
    assert hours == sorted(hours, reverse=True) and len(hours) == 20 and hours[0] <= newest
    _spoil(table, lambda h: h >= hours[-1])
    spark.sql("REFRESH TABLE bounds_tbl")
    assert reports.latest(pruning.newest_in_table(spark, "bounds_tbl", 20), 20).collect() == want[0]
    assert reports.timeseries(pruning.newest_in_table(spark, "bounds_tbl", 20, distinct=True), 20).collect() == want[1]
    assert reports.timeseries(pruning.last_hours_in_table(spark, "bounds_tbl", 6), None).collect() == want[2]


def test_between_opens_no_other_file(spark, table):
    lo, hi = dt.datetime(2024, 1, 9, 22, 30), dt.datetime(2024, 1, 11, 3, 15)
    whole = catalog.read_table(spark, "bounds_tbl")
    want = sorted(map(tuple, whole.where((F.col("datetime") > F.lit(lo)) & (F.col("datetime") <= F.lit(hi))).collect()))
    _spoil(table, lambda h: dt.datetime(2024, 1, 9, 22) <= h <= hi)
    spark.sql("REFRESH TABLE bounds_tbl")
    got = pruning.between(catalog.read_table(spark, "bounds_tbl"), lo, hi, partitioned=True)
    assert sorted(map(tuple, got.collect())) == want and len(want) > 10


def test_registered_hours_without_rows(spark, table):
    catalog.add_partitions(spark, "bounds_tbl", [{"year": 2031, "month": 1, "day": d, "hour": h} for d in range(1, 4) for h in range(24)])
    whole = catalog.read_table(spark, "bounds_tbl")
    for k in (1, 5, 100_000):
        assert reports.latest(pruning.newest_in_table(spark, "bounds_tbl", k), k).collect() == reports.latest(whole, k).collect()
    assert pruning.last_hours_in_table(spark, "bounds_tbl", 6).count() == pruning.last_hours(whole, 6).count() > 0


def test_empty_table(spark, tmp_path):
    catalog.drop_table(spark, "empty_bounds_tbl")
    catalog.create_table(spark, "empty_bounds_tbl", str(tmp_path / "e"))
    assert pruning.newest_in_table(spark, "empty_bounds_tbl", 5).count() == 0
    assert pruning.last_hours_in_table(spark, "empty_bounds_tbl", 5).count() == 0
    catalog.drop_table(spark, "empty_bounds_tbl")

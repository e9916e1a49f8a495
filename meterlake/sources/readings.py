"""Meter readings derived from the driver's ``events`` table.

A deterministic mapping (FIXTURES.md §3) that yields NULL measures, negative
and zero power, tied sub-meters and repeated minutes, so every cleaning and
report rule is exercised on data that grows with the input tables.
``user_id`` doubles as the meter key when operators are run with ``by``.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


# The mapping of FIXTURES.md §3, as Spark SQL expressions (parsed in one call
# on the JVM side; the plan is the same as with the Column API).
READINGS_EXPRESSIONS = (
    "event_id",
    "date_trunc('minute', ts) AS datetime",
    "CASE WHEN event_type = 'error' AND k % 7 = 0 THEN NULL ELSE (value - 5) / 1e1 END AS global_active_power",
    "(k - 10) / 1e2 AS global_reactive_power",
    "CAST(220 + user_id % 21 AS DOUBLE) AS voltage",
    "CASE WHEN event_type = 'view' AND k % 11 = 0 THEN NULL ELSE k / 5e0 END AS global_intensity",
    "CAST(k % 40 AS DOUBLE) AS sub_metering_1",
    "CAST(user_id % 40 AS DOUBLE) AS sub_metering_2",
    "CAST(event_id % 20 AS DOUBLE) AS sub_metering_3",
)


def readings_from_events(events: DataFrame, keep_meter: bool = False) -> DataFrame:
    """events → readings: ``event_id, datetime`` + the seven measures
    (+ ``meter_id`` when ``keep_meter``)."""
    with_k = events.selectExpr(
        "event_id", "ts", "user_id", "event_type", "value", "try_cast(get_json_object(props, '$.k') AS INT) AS k"
    )
    extra = ("user_id AS meter_id",) if keep_meter else ()
    return with_k.selectExpr(*READINGS_EXPRESSIONS, *extra)


def readings(spark: SparkSession, sf_dir: str, keep_meter: bool = False) -> DataFrame:
    return readings_from_events(read_table(spark, sf_dir, "events"), keep_meter=keep_meter)


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second series with times of its own, at full precision: the value of
    every purchase event, ``datetime, price, meter_id``."""
    events = read_table(spark, sf_dir, "events")
    return events.filter("event_type = 'purchase' AND value IS NOT NULL").selectExpr("ts AS datetime", "value AS price", "user_id AS meter_id")

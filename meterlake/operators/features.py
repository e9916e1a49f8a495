"""Feature engineering.

``row_features`` adds calendar and ratio columns to every reading (narrow,
no shuffle). ``hourly_features`` and ``daily_features`` are partial
aggregations keyed by the calendar parts (plus ``by``), so the shuffle carries
one partial row per key per task, whatever the key skew.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.functions.calendar import calendar_parts, is_weekend, weekday
from meterlake.functions.measures import power_diff, power_per_voltage, reactive_ratio, sub_total
from meterlake.schema import METER, Meter


def with_calendar(df: DataFrame, meter: Meter = METER) -> DataFrame:
    """year, month, day, hour, weekday (1 = Sunday), is_weekend (0/1)."""
    t = F.col(meter.time)
    return df.withColumns({**calendar_parts(t), "weekday": weekday(t)}).withColumn(
        "is_weekend", is_weekend(F.col("weekday"))
    )


def row_features(df: DataFrame, meter: Meter = METER) -> DataFrame:
    """Every reading with calendar parts and the four derived measures."""
    a, r, v = F.col(meter.active), F.col(meter.reactive), F.col(meter.voltage)
    return with_calendar(df, meter).withColumns(
        {
            "sub_total": sub_total([F.col(s) for s in meter.submeters]),
            "power_diff": power_diff(a, r),
            "power_per_voltage": power_per_voltage(a, v),
            "reactive_ratio": reactive_ratio(r, a),
        }
    )


def _with_sub_total(df: DataFrame, meter: Meter) -> DataFrame:
    if "sub_total" in df.columns:
        return df
    return df.withColumn("sub_total", sub_total([F.col(s) for s in meter.submeters]))


def _with_parts(df: DataFrame, meter: Meter, parts: Sequence[str]) -> DataFrame:
    missing = {k: v for k, v in calendar_parts(F.col(meter.time)).items() if k in parts and k not in df.columns}
    return df.withColumns(missing) if missing else df


def hourly_features(df: DataFrame, meter: Meter = METER, by: Sequence[str] = ()) -> DataFrame:
    """A4: per hour: mean active power, voltage, intensity; sum of sub_total."""
    keys = [*by, "year", "month", "day", "hour"]
    src = _with_sub_total(_with_parts(df, meter, keys), meter)
    return src.groupBy(*keys).agg(
        F.avg(meter.active).alias("avg_power_hourly"),
        F.avg(meter.voltage).alias("avg_voltage_hourly"),
        F.avg(meter.intensity).alias("avg_intensity_hourly"),
        F.sum("sub_total").alias("total_sub_hourly"),
    )


def daily_features(df: DataFrame, meter: Meter = METER, by: Sequence[str] = ()) -> DataFrame:
    """A5: per day: mean active power, sample stddev of voltage (NULL for a
    single reading), sum of sub_total, mean intensity."""
    keys = [*by, "year", "month", "day"]
    src = _with_sub_total(_with_parts(df, meter, keys), meter)
    return src.groupBy(*keys).agg(
        F.avg(meter.active).alias("avg_power_daily"),
        F.stddev_samp(meter.voltage).alias("voltage_stability_daily"),
        F.sum("sub_total").alias("total_submetering_daily"),
        F.avg(meter.intensity).alias("avg_intensity_daily"),
    )

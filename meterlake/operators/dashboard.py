"""Dashboard-ready results (P22, P25-P27): the presentation rules of the
original page applied in Spark, so any client can draw the rows as they are.
Inputs are the (already small) report frames, so these are projections.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.functions.display import datetime_text, hour_label, rounded, zero_if_missing
from meterlake.schema import METER, Meter

# Digits shown on the statistic cards and in the latest table.
CARD_DIGITS = {"avg_active_power": 2, "avg_voltage": 1, "avg_intensity": 2}
TABLE_DIGITS = {
    "global_active_power": 3,
    "global_reactive_power": 3,
    "voltage": 2,
    "global_intensity": 2,
    "sub_metering_1": 1,
    "sub_metering_2": 1,
    "sub_metering_3": 1,
}


def hour_chart(profile: DataFrame) -> DataFrame:
    """Hour-of-day profile as chart points: ``label`` ("8:00"), ``hour``,
    ``value`` (mean active power, missing as 0)."""
    return profile.select(
        hour_label(F.col("hour")).alias("label"),
        "hour",
        zero_if_missing(F.col("avg_active_power")).alias("value"),
    )


def series_chart(series: DataFrame, meter: Meter = METER) -> DataFrame:
    """Time series as chart points: text timestamp + three lines, missing as 0."""
    return series.select(
        datetime_text(F.col(meter.time)).alias("label"),
        *[zero_if_missing(F.col(c)).alias(c) for c in ("avg_active_power", "avg_voltage", "avg_intensity")],
    )


def statistic_cards(stats: DataFrame) -> DataFrame:
    """Statistics rounded as on the cards."""
    return stats.select(
        "total_records",
        *[rounded(F.col(c), d).alias(c) for c, d in CARD_DIGITS.items()],
    )


def latest_table(rows: DataFrame, meter: Meter = METER) -> DataFrame:
    """Latest readings with the table's text timestamp and rounding."""
    digits = dict(zip(meter.measures, TABLE_DIGITS.values()))
    return rows.select(
        datetime_text(F.col(meter.time)).alias(meter.time),
        *[rounded(F.col(m), digits[m]).alias(m) for m in meter.measures],
    )

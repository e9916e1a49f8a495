"""Column expressions: built-in Spark functions only, no Python UDFs."""

from meterlake.functions.calendar import calendar_parts, hour_start, is_weekend, weekday
from meterlake.functions.display import datetime_text, hour_label, rounded, zero_if_missing
from meterlake.functions.measures import (
    clamp_negative,
    dominant_zone,
    power_diff,
    power_per_voltage,
    reactive_ratio,
    sub_total,
)
from meterlake.functions.parse import binary_text, iso_datetime, raw_datetime, to_number

__all__ = [
    "binary_text",
    "calendar_parts",
    "clamp_negative",
    "datetime_text",
    "dominant_zone",
    "hour_label",
    "hour_start",
    "is_weekend",
    "iso_datetime",
    "power_diff",
    "power_per_voltage",
    "raw_datetime",
    "reactive_ratio",
    "rounded",
    "sub_total",
    "to_number",
    "weekday",
    "zero_if_missing",
]

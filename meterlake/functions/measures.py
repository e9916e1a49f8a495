"""Expressions over the measures of one reading."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def clamp_negative(c: Column) -> Column:
    """Negative → 0.0; NULL stays NULL (``greatest`` would turn it into 0)."""
    return F.when(c < 0, F.lit(0.0)).otherwise(c)


def dominant_zone(submeters: Sequence[Column], zones: Sequence[str]) -> Column:
    """Name of the sub-meter with the largest value; ties go to the lower
    number, so all-zero readings land in the first zone."""
    top = F.greatest(*submeters)
    expr = None
    for sub, zone in zip(submeters[:-1], zones[:-1]):
        expr = F.when(top == sub, F.lit(zone)) if expr is None else expr.when(top == sub, F.lit(zone))
    last = F.lit(zones[-1])
    return last if expr is None else expr.otherwise(last)


def sub_total(submeters: Sequence[Column]) -> Column:
    """Sum of the sub-meters; NULL when any of them is NULL."""
    total = submeters[0]
    for s in submeters[1:]:
        total = total + s
    return total


def power_diff(active: Column, reactive: Column) -> Column:
    return active - reactive


def power_per_voltage(active: Column, voltage: Column) -> Column:
    """active / voltage; NULL when voltage is 0."""
    return F.try_divide(active, voltage)


def reactive_ratio(reactive: Column, active: Column) -> Column:
    """reactive / active; NULL when active is 0."""
    return F.try_divide(reactive, active)

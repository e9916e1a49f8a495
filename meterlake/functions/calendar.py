"""Calendar parts of a timestamp (P11-P13, P21), in the session zone (UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Dayofweek numbering is 1 = Sunday .. 7 = Saturday.
WEEKEND_DAYS = (1, 7)


def calendar_parts(ts: Column) -> dict[str, Column]:
    """year, month, day, hour as INT columns keyed by name."""
    return {
        "year": F.year(ts),
        "month": F.month(ts),
        "day": F.dayofmonth(ts),
        "hour": F.hour(ts),
    }


def weekday(ts: Column) -> Column:
    return F.dayofweek(ts)


def is_weekend(weekday_col: Column) -> Column:
    return F.when(weekday_col.isin(*WEEKEND_DAYS), F.lit(1)).otherwise(F.lit(0))


def hour_start(ts: Column) -> Column:
    """Start of the hour holding ``ts``."""
    return F.date_trunc("hour", ts)


def day_start(ts: Column) -> Column:
    return F.to_date(ts)

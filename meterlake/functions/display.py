"""Presentation expressions (P22, P25-P27): text timestamps, missing-as-zero,
fixed rounding and hour labels, done in Spark rather than in a page."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from meterlake.schema import WIRE_DATETIME_PATTERN


def datetime_text(ts: Column, pattern: str = WIRE_DATETIME_PATTERN) -> Column:
    return F.date_format(ts, pattern)


def zero_if_missing(c: Column) -> Column:
    """NULL and NaN → 0.0, for charting."""
    return F.coalesce(F.nanvl(c, F.lit(0.0)), F.lit(0.0))


def hour_label(hour: Column) -> Column:
    """8 → ``8:00``."""
    return F.concat(hour.cast("string"), F.lit(":00"))


def rounded(c: Column, digits: int) -> Column:
    """Round for display as ``round(x * 10^d) / 10^d``: the binary value
    scaled by 10^d, rounded half away from zero (the C / DuckDB rule). It
    follows the page's ``toFixed`` (1.005 → 1.00, where Spark's decimal-text
    ``round(x, d)`` gives 1.01) except where the scaling itself lands exactly
    on a tie (2.675 * 100 == 267.5 → 2.68; ``toFixed`` gives 2.67)."""
    scale = F.lit(float(10**digits))
    return F.round(c * scale) / scale

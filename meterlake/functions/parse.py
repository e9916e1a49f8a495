"""Column expressions that turn text into typed values.

Spark 4 runs in ANSI mode, where a plain cast of ``?`` or of a bad date
throws; every conversion here uses the ``try_`` family so that bad input
becomes NULL, to be counted (quality) and dropped (clean) later.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from meterlake.schema import MISSING_MARKER, RAW_DATETIME_PATTERN


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_number(c: Column | str) -> Column:
    """Text to double: padded numbers parse, ``?`` and junk give NULL."""
    text = F.trim(_col(c))
    return F.when(text == F.lit(MISSING_MARKER), F.lit(None).cast("double")).otherwise(
        text.try_cast("double")
    )


def raw_datetime(date: Column | str, time: Column | str) -> Column:
    """``d/M/yyyy`` + ``H:mm:ss`` to a timestamp; accepts unpadded days and
    months; anything unparsable gives NULL."""
    text = F.concat_ws(" ", F.trim(_col(date)), F.trim(_col(time)))
    return F.try_to_timestamp(text, F.lit(RAW_DATETIME_PATTERN))


def iso_datetime(c: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` (or ISO 8601) text to timestamp, bad → NULL."""
    return _col(c).try_cast("timestamp")


def binary_text(c: Column | str) -> Column:
    """Message payload bytes to text."""
    return _col(c).cast("string")

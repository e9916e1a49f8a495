"""Validation and labelling of readings.

Named policies, because the batch and stream rules of the original
disagree and must never be mixed silently:

* ``clean_stream`` — drop rows whose time or a measure is NULL/NaN, raise negative active and
  reactive power to 0 (zero is kept), add partition columns and the zone.
* ``screen`` — the streaming policy without losing a row: each one with what
  it lacks, those that lack nothing with the values of ``clean_stream``.
* ``clean_batch`` — drop rows whose active power is NULL or not strictly
  positive; other columns are left as they are.

All are narrow transformations (filter + project): no shuffle, and they run
unchanged on a streaming DataFrame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.functions.calendar import calendar_parts
from meterlake.functions.measures import clamp_negative, dominant_zone
from meterlake.schema import METER, Meter


def with_partition_columns(df: DataFrame, meter: Meter = METER) -> DataFrame:
    """Add ``year, month, day, hour`` (INT) from the time column."""
    return df.withColumns(calendar_parts(F.col(meter.time)))


def with_zone(df: DataFrame, meter: Meter = METER, name: str = "zone") -> DataFrame:
    subs = [F.col(s) for s in meter.submeters]
    return df.withColumn(name, dominant_zone(subs, meter.zones))


def clean_stream(df: DataFrame, meter: Meter = METER) -> DataFrame:
    """Streaming policy; the same function is used on bounded input. A row
    needs its time and every measure; other columns may be NULL."""
    complete = df.na.drop(how="any", subset=[meter.time, *meter.measures])
    clamped = complete.withColumns(
        {
            meter.active: clamp_negative(F.col(meter.active)),
            meter.reactive: clamp_negative(F.col(meter.reactive)),
        }
    )
    return with_zone(with_partition_columns(clamped, meter), meter)


def reject_reasons(meter: Meter = METER) -> Column:
    """What a row lacks under the streaming policy, one ``missing_<column>``
    for each (the names of ``insights.quality``); empty: nothing."""
    lacks = {meter.time: F.col(meter.time).isNull()}
    lacks |= {m: F.col(m).isNull() | F.isnan(m) for m in meter.measures}
    return F.array_compact(F.array(*[F.when(bad, F.lit(f"missing_{name}")) for name, bad in lacks.items()]))


def screen(df: DataFrame, meter: Meter = METER) -> DataFrame:
    """Every row once, with ``reasons`` and ``outcome`` (X12): ``stored`` rows
    are those of ``clean_stream`` with its values; ``rejected`` ones keep
    what was read (no zone, no raised powers) and say what they lack.

    NULL anywhere but in the time and the measures rejects nothing; repeated
    rows stay repeated; an empty frame gives an empty one. Input columns named
    ``reasons`` or ``outcome`` are refused, as they would be lost.
    """
    clash = {"reasons", "outcome"} & set(df.columns)
    if clash:
        raise ValueError(f"columns of the result are in the input: {sorted(clash)}")
    stored = F.size("reasons") == 0
    told = df.withColumn("reasons", reject_reasons(meter))
    raised = {m: F.when(stored, clamp_negative(F.col(m))).otherwise(F.col(m)) for m in (meter.active, meter.reactive)}
    rows = with_zone(with_partition_columns(told.withColumns(raised), meter), meter)
    return rows.withColumns({
        "zone": F.when(stored, F.col("zone")),
        "outcome": F.when(stored, F.lit("stored")).otherwise(F.lit("rejected")),
    })


def clean_batch(df: DataFrame, meter: Meter = METER) -> DataFrame:
    """Batch policy: active power present and strictly positive."""
    active = F.col(meter.active)
    return df.filter(active.isNotNull() & ~F.isnan(active) & (active > 0))

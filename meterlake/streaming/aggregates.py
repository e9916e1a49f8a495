"""Event-time operators for streams.

Watermarks need ``TIMESTAMP`` (not ``TIMESTAMP_NTZ``) event times, which is
what ``parse_json`` produces. In append mode a window is emitted once the
watermark passes its end, so its result is final; state for closed windows
and for keys older than the watermark is dropped, keeping state bounded.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from meterlake.schema import METER, Meter


def hourly_windows(
    df: DataFrame,
    delay: str = "1 hour",
    size: str = "1 hour",
    meter: Meter = METER,
    by: Sequence[str] = (),
) -> DataFrame:
    """Tumbling-window load per hour with a watermark of ``delay``."""
    t = F.col(meter.time)
    return (
        df.withWatermark(meter.time, delay)
        .groupBy(*[F.col(b) for b in by], F.window(t, size).alias("w"))
        .agg(
            F.avg(meter.active).alias("avg_active_power"),
            F.max(meter.active).alias("max_active_power"),
            F.sum(meter.active).alias("sum_active_power"),
            F.count(F.lit(1)).alias("record_count"),
        )
        .select(
            *by,
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "avg_active_power",
            "max_active_power",
            "sum_active_power",
            "record_count",
        )
    )


def drop_repeats(
    df: DataFrame,
    delay: str | None = None,
    keys: Sequence[str] = ("message_id",),
    meter: Meter = METER,
) -> DataFrame:
    """Drop messages repeated by a retrying publisher.

    ``keys`` must tell messages apart, so they name a message id (or a meter
    key and the time); measures alone do not, as two meters may well read
    alike. On a stream ``delay`` must be given: rows that arrive later than
    that behind the newest time are dropped by Spark's watermark rule, and
    ``late_rows`` tells how many.
    """
    missing = [k for k in keys if k not in df.columns]
    if missing or not keys:
        raise ValueError(f"keys must name columns that tell messages apart; missing: {missing}")
    if df.isStreaming:
        if not delay:
            raise ValueError("a stream needs a delay: how late a copy may arrive")
        return df.withWatermark(meter.time, delay).dropDuplicatesWithinWatermark(list(keys))
    return df.dropDuplicates(list(keys))


def late_rows(query: StreamingQuery) -> int:
    """Rows that a query's watermark has dropped, over the batches whose
    progress it still reports."""
    return sum(int(s.get("numRowsDroppedByWatermark", 0)) for p in query.recentProgress for s in p["stateOperators"])

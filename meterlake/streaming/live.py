"""The hour that is still open, readable and corrected.

Append mode gives a window once it is closed. Here the windows run in update
mode: every batch lands the windows it changed, with its number, and a reader
takes the newest row of each window. Folding keeps those only, so the table
stays at one row a window plus what the batches since the last fold changed.
Rows behind the watermark change no window; ``aggregates.late_rows`` counts
them and ``streaming.late`` stores them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from meterlake.schema import METER, Meter
from meterlake.sinks.snapshots import Record, SnapshotTable
from meterlake.streaming.aggregates import hourly_windows
from meterlake.streaming.ingest import with_trigger

BATCH = "batch"


def live_table(spark: SparkSession, root: str, rows: T.StructType, meter: Meter = METER, by: Sequence[str] = ()) -> SnapshotTable:
    """The table for the windows of frames with the schema ``rows``."""
    windows = hourly_windows(spark.createDataFrame([], rows), meter=meter, by=by).withColumn(BATCH, F.lit(0).cast("long"))
    return SnapshotTable(spark, root, windows.schema, partition_by=())


def start_live_windows(
    table: SnapshotTable,
    rows: DataFrame,
    checkpoint: str,
    delay: str = "1 hour",
    size: str = "1 hour",
    trigger: dict | None = None,
    meter: Meter = METER,
    by: Sequence[str] = (),
) -> StreamingQuery:
    """Stream readings into the changed windows of each batch. The table and
    the checkpoint belong together: batch numbers go on after a restart."""

    def each(batch: DataFrame, batch_id: int) -> None:
        table.land(batch.withColumn(BATCH, F.lit(batch_id).cast("long")), batch_id, "windows")

    windows = hourly_windows(rows, delay, size, meter, by)
    writer = windows.writeStream.outputMode("update").foreachBatch(each).option("checkpointLocation", checkpoint)
    return with_trigger(writer, trigger).start()


def newest(changes: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The last state of each window: one partial aggregation, no window
    function, as a batch holds a window once."""
    keys = [*by, "window_start", "window_end"]
    values = [c for c in changes.columns if c not in (*keys, BATCH)]
    last = changes.groupBy(*keys).agg(F.max(BATCH).alias(BATCH), F.max_by(F.struct(*values), BATCH).alias("_v"))
    return last.select(*keys, *[F.col(f"_v.{v}").alias(v) for v in values], BATCH)


def current(table: SnapshotTable, by: Sequence[str] = ()) -> DataFrame:
    """All windows as the last batch left them, open ones included."""
    return newest(table.read(), by).drop(BATCH)


def fold(table: SnapshotTable, by: Sequence[str] = ()) -> Record:
    """Replace the changes by the newest row of each window."""
    return table.fold(lambda changes: newest(changes, by))

"""Repeats dropped and late rows kept.

A stateful stream drops rows behind its watermark and can only count them.
Here each batch is compared with the table it lands in, so a row of any age is
known or new, and a new one behind the watermark is stored as late. The
newest time so far, from which the watermark follows, is noted in the commit
of each batch: a restart or a replay judges as the first run did.

Rows are copies of each other if their keys and their times agree. A batch
reads the keys of its own days only, from its oldest time on: the table is
partitioned by day, the bound is a literal that skips row groups of folded
files.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from meterlake.schema import METER, Meter
from meterlake.sinks.snapshots import SnapshotTable
from meterlake.streaming.ingest import with_trigger

LATE, DAY = "late", "event_day"


def once_table(spark: SparkSession, root: str, rows: T.StructType) -> SnapshotTable:
    """The table for frames with the schema ``rows``."""
    schema = T.StructType([*rows.fields, T.StructField(LATE, T.BooleanType()), T.StructField(DAY, T.DateType())])
    return SnapshotTable(spark, root, schema, partition_by=(LATE, DAY))


def land_once(
    table: SnapshotTable,
    batch: DataFrame,
    batch_id: int,
    keys: Sequence[str],
    delay: timedelta,
    meter: Meter = METER,
    stream: str = "once",
) -> bool:
    """Add the rows of a batch that the table does not hold, each once; False
    if the batch is there already. One stream writes to a table.

    A row is late if its time is not after the newest time of the batches
    before less ``delay``. NULL keys are equal to each other, a NULL time is
    never late. Rows that share keys and time but differ elsewhere are copies
    all the same, and one of them stays. A batch without rows changes nothing
    but the record.
    """
    missing = [k for k in keys if k not in batch.columns]
    if missing or not keys:
        raise ValueError(f"keys must name columns that tell messages apart; missing: {missing}")
    clash = {LATE, DAY} & set(batch.columns)
    if clash:
        raise ValueError(f"columns of the table are in the input: {sorted(clash)}")
    record = table.record()
    if batch_id <= record.landed.get(stream, -1):
        return False
    time = F.col(meter.time)
    same = list(dict.fromkeys([*keys, meter.time]))
    rows = batch.withColumn(DAY, F.to_date(time)).persist()
    try:
        # a row a day: the only thing that reaches the driver
        days = rows.groupBy(DAY).agg(F.unix_micros(F.min(time)).alias("lo"), F.unix_micros(F.max(time)).alias("hi")).collect()
        dated = [d for d in days if d[DAY] is not None]
        known = F.lit(False)
        if dated:
            oldest = F.timestamp_micros(F.lit(min(d.lo for d in dated)))
            known = F.col(DAY).isin([d[DAY] for d in dated]) & (time >= oldest)
        if len(dated) < len(days):
            known = known | F.col(DAY).isNull()
        there = table.read(record.version).where(known).select(DAY, *[F.col(c).alias(f"there_{i}") for i, c in enumerate(same)])
        match = rows[DAY].eqNullSafe(there[DAY])
        for i, c in enumerate(same):
            match = match & rows[c].eqNullSafe(there[f"there_{i}"])
        new = rows.join(there, match, "left_anti").dropDuplicates(same)
        before = record.notes.get(stream)
        late = F.lit(False)
        if before is not None:
            mark = F.timestamp_micros(F.lit(int(before) - delay // timedelta(microseconds=1)))
            late = F.coalesce(time <= mark, F.lit(False))
        newest = max([d.hi for d in dated] + ([int(before)] if before is not None else []), default=None)
        return table.land(new.withColumn(LATE, late), batch_id, stream, None if newest is None else str(newest))
    finally:
        rows.unpersist()


def start_once(
    table: SnapshotTable,
    rows: DataFrame,
    checkpoint: str,
    keys: Sequence[str],
    delay: timedelta,
    trigger: dict | None = None,
    meter: Meter = METER,
) -> StreamingQuery:
    """Stream rows into ``table`` without repeats, late ones marked."""

    def each(batch: DataFrame, batch_id: int) -> None:
        land_once(table, batch, batch_id, keys, delay, meter)

    writer = rows.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return with_trigger(writer, trigger).start()


def in_time(table: SnapshotTable) -> DataFrame:
    return table.read().where(~F.col(LATE)).drop(LATE, DAY)


def late(table: SnapshotTable) -> DataFrame:
    return table.read().where(LATE).drop(LATE, DAY)

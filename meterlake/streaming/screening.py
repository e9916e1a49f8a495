"""Rejected rows kept beside the stored ones.

A batch is screened and written once, partitioned by outcome, and one commit
of the snapshot table makes both parts visible: stored plus rejected rows are
always the whole input, whatever fails between. Readers of the stored rows
prune the directories of the others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from meterlake.operators.clean import screen
from meterlake.schema import METER, Meter
from meterlake.sinks.snapshots import SnapshotTable, start_landing

PARTITION_BY = ("outcome", "year", "month", "day")


def screened_table(spark: SparkSession, root: str, parsed: T.StructType, meter: Meter = METER) -> SnapshotTable:
    """The table for the screened rows of frames with the schema ``parsed``."""
    schema = screen(spark.createDataFrame([], parsed), meter).schema
    return SnapshotTable(spark, root, schema, PARTITION_BY)


def start_screening(
    table: SnapshotTable, parsed: DataFrame, checkpoint: str, trigger: dict | None = None, meter: Meter = METER
) -> StreamingQuery:
    """Stream typed readings into ``table``, those that the streaming policy
    drops with their reasons."""
    return start_landing(table, screen(parsed, meter), checkpoint, trigger, stream="screening")


def stored(table: SnapshotTable) -> DataFrame:
    """The rows that ``clean_stream`` keeps."""
    return table.read().where("outcome = 'stored'").drop("outcome", "reasons")


def rejected(table: SnapshotTable) -> DataFrame:
    return table.read().where("outcome = 'rejected'").drop("outcome")


def reject_counts(rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows a reason; a row that lacks several things counts for each."""
    reasons = rows.select(*by, F.explode("reasons").alias("reason"))
    return reasons.groupBy(*by, "reason").agg(F.count(F.lit(1)).alias("rejected"))

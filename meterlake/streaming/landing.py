"""Replay-safe landing with automatic partition registration.

``foreachBatch`` writes no ``_spark_metadata`` log, so appending from it is
at-least-once. Here every micro-batch overwrites its own ``batch_id=<n>``
directory, so a replayed batch replaces its first attempt instead of adding
to it, and the batch's partitions are added to the catalog table right after
the write. They are read from the directories just written, so the batch is
computed once and never kept.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from meterlake.plans import catalog
from meterlake.schema import PARTITION_COLUMNS, STORED
from meterlake.streaming.ingest import with_trigger

BATCH_COLUMN = "batch_id"


def landing_schema(schema: T.StructType = STORED) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(BATCH_COLUMN, T.LongType(), True)])


def land_batch(
    spark: SparkSession,
    batch: DataFrame,
    batch_id: int,
    path: str,
    table: str,
    partition_by: Sequence[str] = PARTITION_COLUMNS,
) -> int:
    """Write one batch idempotently and register its partitions."""
    target = os.path.join(path, f"{BATCH_COLUMN}={batch_id}")
    # a few files for each partition, and a hot one split, whatever the number of tasks
    batch.hint("rebalance", *partition_by).write.mode("overwrite").partitionBy(*partition_by).parquet(target)
    parts = written_partitions(spark, target, partition_by)
    return catalog.add_partitions(spark, table, [{BATCH_COLUMN: batch_id, **p} for p in parts])


def written_partitions(spark: SparkSession, target: str, partition_by: Sequence[str]) -> list[dict[str, str]]:
    """Partition values of the directories below ``target``: a listing of
    names, one level for each partition column."""
    sc = spark.sparkContext
    top = sc._jvm.org.apache.hadoop.fs.Path(os.path.join(target, *["*=*"] * len(partition_by)))
    found = top.getFileSystem(sc._jsc.hadoopConfiguration()).globStatus(top) or []
    paths = [f.getPath().toString() for f in found]
    return [dict(part.split("=", 1) for part in p.split("/")[-len(partition_by):]) for p in paths]


def start_landing(
    spark: SparkSession,
    stored: DataFrame,
    path: str,
    checkpoint: str,
    table: str,
    trigger: dict | None = None,
    partition_by: Sequence[str] = PARTITION_COLUMNS,
) -> StreamingQuery:
    """Stream stored-form rows into ``path`` via ``foreachBatch``."""
    catalog.create_table(
        spark, table, path, schema=landing_schema(), partition_by=[BATCH_COLUMN, *partition_by]
    )

    def each(batch: DataFrame, batch_id: int) -> None:
        land_batch(spark, batch, batch_id, path, table, partition_by)

    writer = stored.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return with_trigger(writer, trigger).start()

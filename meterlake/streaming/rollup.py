"""Incremental hourly rollup maintained by a stream.

Every micro-batch writes the rollup of its own rows into ``batch_id=<n>``
(overwritten when a batch is replayed, so the output is exactly-once per
batch). Readers merge the partial rows with ``operators.rollup`` functions,
which group on the report keys and ignore ``batch_id``; ``compact`` folds the
partials into one row per hour in a new directory.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from meterlake.operators import rollup
from meterlake.schema import METER, PARTITION_COLUMNS, Meter
from meterlake.sinks.files import write_parquet
from meterlake.streaming.ingest import with_trigger

BATCH_COLUMN = "batch_id"


def start_rollup(
    stored: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    meter: Meter = METER,
    by: Sequence[str] = (),
) -> StreamingQuery:
    """Stream cleaned readings into per-batch hourly partials under ``path``."""

    def each(batch: DataFrame, batch_id: int) -> None:
        target = os.path.join(path, f"{BATCH_COLUMN}={batch_id}")
        rollup.hourly_rollup(batch, meter, by).write.mode("overwrite").parquet(target)

    writer = stored.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return with_trigger(writer, trigger).start()


def read_partials(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def compact(spark: SparkSession, path: str, out: str, meter: Meter = METER, by: Sequence[str] = ()) -> DataFrame:
    """Fold all partials into one rollup row per (by, hour), written to a new
    directory (the partials stay valid until a reader switches over)."""
    merged = rollup.merge(read_partials(spark, path), [*by, *PARTITION_COLUMNS], meter, with_m2=True)
    write_parquet(merged, out, partition_by=("year", "month"))
    return spark.read.parquet(out)

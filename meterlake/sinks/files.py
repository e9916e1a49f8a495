"""File sinks: partitioned Parquet, CSV export, compaction.

All writes go to a directory the caller names; a job never overwrites the
directory it reads from (G6), because Spark deletes the target before the
lazy read has finished.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.paths import qualified, root_paths
from meterlake.schema import METER, PARTITION_COLUMNS, Meter


def guard_overlap(df: DataFrame, target: str) -> None:
    """Refuse when the target equals, contains or lies inside a directory or
    file that the frame reads. Both are compared as Hadoop qualifies them;
    the files below a root are not listed."""
    spark = df.sparkSession
    t = qualified(spark, target) + "/"
    for root in root_paths(df):
        src = qualified(spark, root) + "/"
        if src.startswith(t) or t.startswith(src):
            raise ValueError(f"output {target!r} overlaps input {root!r}; write to a new directory")


def write_parquet(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    cluster_by_partitions: bool = True,
    sort_by: Sequence[str] = (),
) -> None:
    """Write Parquet, optionally partitioned (K2, K3).

    With ``partition_by`` the rows are first rebalanced on the partition
    columns (the ``REBALANCE`` hint), so a directory gets a few large files
    instead of one small file per input task. Unlike ``repartition``, AQE may
    split a hot partition value over several tasks and merge small ones, so
    an hour holding a third of all rows is not written by a single task.

    ``sort_by`` orders rows inside each file (after the partition columns,
    which the partitioned writer needs first anyway), so Parquet row-group
    min/max statistics on, say, the time column let range filters skip row
    groups inside a partition.
    """
    guard_overlap(df, path)
    out = df
    if partition_by and cluster_by_partitions:
        out = df.hint("rebalance", *partition_by)
    if sort_by:
        out = out.sortWithinPartitions(*partition_by, *sort_by)
    writer = out.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def export_csv(df: DataFrame, path: str, header: bool = True, sep: str = ",") -> None:
    """Any report as CSV files under ``path`` (X10); timestamps as ISO text."""
    guard_overlap(df, path)
    (
        df.write.mode("overwrite")
        .option("header", str(header).lower())
        .option("sep", sep)
        .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss")
        .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss")
        .csv(path)
    )


def compact(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = ("year", "month"),
    rows_per_file: int = 5_000_000,
    meter: Meter = METER,
) -> None:
    """Rewrite readings into a coarser layout in a *new* directory.

    Rows are range-partitioned on the coarse partition columns, the time
    column and a hash of the row, so the readings that all meters took in one
    minute can be split; files are sorted by time and sized by
    ``maxRecordsPerFile``.
    Never run this in place under a streaming file sink: readers of that path
    trust its ``_spark_metadata`` log.
    """
    guard_overlap(df, path)
    fine = [c for c in PARTITION_COLUMNS if c not in partition_by]
    out = df.drop(*[c for c in fine if c in df.columns])
    order = [*partition_by, meter.time] if meter.time in out.columns else list(partition_by)
    (
        out.repartitionByRange(*[F.col(c) for c in order], F.xxhash64(*out.columns))
        .sortWithinPartitions(*order)
        .write.mode("overwrite")
        .option("maxRecordsPerFile", str(rows_per_file))
        .partitionBy(*partition_by)
        .parquet(path)
    )

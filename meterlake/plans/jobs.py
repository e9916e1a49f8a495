"""Batch jobs (§3.3): raw text → cleaned Parquet; cleaned → features.

One typed reader replaces the RDD split of the original; the cleaning job
refuses to overwrite its own input (G6); the feature job derives hourly and
daily tables from the same cleaned input and writes both, plus optionally
the per-reading features.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from meterlake.operators.clean import clean_batch, clean_stream
from meterlake.operators import rollup
from meterlake.operators.features import row_features
from meterlake.session import shared_dir
from meterlake.schema import METER, Meter
from meterlake.sinks.files import write_parquet
from meterlake.sinks.snapshots import Record, SnapshotTable
from meterlake.settings import Settings
from meterlake.sinks.messages import publish_kafka, to_messages, write_spool
from meterlake.sources.text import line_id, numbered_lines, parse_raw_lines, read_raw


@dataclass(frozen=True)
class FeaturePaths:
    hourly: str
    daily: str
    rows: str | None = None


def clean_job(
    spark: SparkSession,
    raw_path: str,
    out_path: str,
    policy: str = "batch",
    partition_by: Sequence[str] = (),
    meter: Meter = METER,
) -> DataFrame:
    """Read raw ``;`` text, apply the named cleaning policy, write Parquet
    (K2). Returns the written data, read back."""
    readings = read_raw(spark, raw_path, meter)
    cleaned = clean_batch(readings, meter) if policy == "batch" else clean_stream(readings, meter)
    write_parquet(cleaned, out_path, partition_by=partition_by)
    return spark.read.parquet(out_path)


def feature_job(
    spark: SparkSession,
    cleaned: DataFrame,
    paths: FeaturePaths,
    meter: Meter = METER,
    by: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """Hourly and daily features of ``cleaned`` written to ``paths`` (K3).

    The readings are aggregated once, into the hourly rollup kept in the
    shared checkpoint folder (about 1/60 of the readings per meter); both
    tables derive from it, so the input is scanned once rather than per table.
    """
    rollup_path = shared_dir(spark, "hourly-rollup")
    write_parquet(rollup.hourly_rollup(cleaned, meter, by), rollup_path)
    hourly_rollup = spark.read.parquet(rollup_path)
    write_parquet(rollup.hourly_features(hourly_rollup, meter, by), paths.hourly, partition_by=("year", "month"))
    write_parquet(rollup.daily_features(hourly_rollup, meter, by), paths.daily, partition_by=("year",))
    if paths.rows:
        write_parquet(row_features(cleaned, meter), paths.rows, partition_by=("year", "month"))
    return spark.read.parquet(paths.hourly), spark.read.parquet(paths.daily)


MESSAGE_ID = "message_id"


def readings_to_publish(spark: SparkSession, raw_path: str, meter: Meter = METER) -> DataFrame:
    """Readings of raw text files with the id that a rerun gives them again."""
    lines = numbered_lines(spark, raw_path).withColumn(MESSAGE_ID, line_id())
    return parse_raw_lines(lines, "value", meter, carry=(MESSAGE_ID,))


def publish_job(
    spark: SparkSession,
    raw_path: str,
    spool: str | None = None,
    settings: Settings | None = None,
    meter: Meter = METER,
    key: str = MESSAGE_ID,
) -> None:
    """Publish raw text files as JSON messages (K4), to a spool folder or to
    the topic of ``settings``.

    Each message carries the file, number and hash of its line as
    ``message_id``: a publisher that failed is run again whole, and readers
    drop what came twice by that id (``drop_repeats``). Messages are keyed by
    the id, so no topic partition gets more than its share, or by ``key``.
    Blank and header lines are no messages; a missing measure stays absent.
    """
    if (spool is None) == (settings is None):
        raise ValueError("publish to a spool folder or to a topic")
    messages = to_messages(readings_to_publish(spark, raw_path, meter), meter, carry=(MESSAGE_ID,), key=key)
    if spool is not None:
        write_spool(messages, spool)
    else:
        publish_kafka(messages, settings)


def fold_job(
    spark: SparkSession,
    root: str,
    partition_by: Sequence[str],
    at_least: int = 2,
    keep_seconds: float = 24 * 3600,
    meter: Meter = METER,
) -> Record:
    """Fold the landed batches of the snapshot table at ``root`` once there
    are ``at_least`` of them, beside running streams and readers, and remove
    directories that left the table longer than ``keep_seconds`` ago (X13)."""
    table = SnapshotTable(spark, root, partition_by=partition_by)
    record = table.record()
    if len(record.live) >= at_least:
        record = table.fold(sort_by=(meter.time,))
    table.vacuum(keep_seconds)
    return record

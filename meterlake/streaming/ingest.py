"""Streaming ingest: messages → parse → clean_stream → partitioned Parquet
(K1, K5, W1-W5).

The transformation is the batch ``clean_stream`` itself, so the stored table
always equals ``clean_stream`` over the same messages. Exactly-once into the
file sink comes from the checkpointed source offsets plus the sink's
``_spark_metadata`` log; a restarted query resumes from the checkpoint and
never writes a batch twice.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from meterlake.operators.clean import clean_stream
from meterlake.plans import catalog
from meterlake.schema import METER, PARTITION_COLUMNS, Meter, stored_schema
from meterlake.settings import Settings
from meterlake.sources.messages import parse_json, parse_json_zone, read_kafka
from meterlake.sources.text import parse_raw_lines

log = logging.getLogger(__name__)


# Files a batch may write into one partition directory.
FILES_PER_PARTITION = 4


def stored_columns(meter: Meter = METER, by: Sequence[str] = ()) -> list[str]:
    return [meter.time, *meter.measures, "zone", *by, *PARTITION_COLUMNS]


def with_trigger(writer: DataStreamWriter, trigger: dict | None) -> DataStreamWriter:
    """``{"processingTime": "60 seconds"}`` (default cadence),
    ``{"availableNow": True}`` (drain and stop) or ``{"once": True}``."""
    return writer.trigger(**trigger) if trigger else writer


def interval(seconds: int) -> dict:
    return {"processingTime": f"{int(seconds)} seconds"}


def to_stored(parsed: DataFrame, meter: Meter = METER, by: Sequence[str] = ()) -> DataFrame:
    """The stateless chain shared with batch, projected to the stored
    form, with the key columns ``by`` (a meter id; NULL stays NULL)."""
    return clean_stream(parsed, meter).select(*stored_columns(meter, by))


def deal_by_partition(df: DataFrame, partition_by: Sequence[str], files: int) -> DataFrame:
    """Rows of one partition directory in at most ``files`` tasks, so that a
    batch writes that many files into it however many tasks have read it. A
    hot hour is spread by the hash of its other columns over all of them;
    give more files where one hour holds most of a batch."""
    if files < 1:
        raise ValueError("files must be at least 1")
    others = [c for c in df.columns if c not in partition_by]
    return df.repartition(*partition_by, F.pmod(F.xxhash64(*others), F.lit(files)))


def start_parquet_sink(
    df: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: Sequence[str] = PARTITION_COLUMNS,
    trigger: dict | None = None,
    query_name: str | None = None,
    files_per_partition: int | None = None,
) -> StreamingQuery:
    """K1 + W2: append to partitioned Parquet with a checkpoint (required:
    there is no default location, G12). With ``files_per_partition`` a batch
    writes at most so many files into a directory, for one shuffle; without,
    each task writes one into each directory it has rows for."""
    if not checkpoint:
        raise ValueError("a checkpoint location is required")
    if partition_by and files_per_partition is not None:
        df = deal_by_partition(df, partition_by, files_per_partition)
    writer = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if query_name:
        writer = writer.queryName(query_name)
    return with_trigger(writer, trigger).start()


def start_console_sink(df: DataFrame, truncate: bool = False, trigger: dict | None = None) -> StreamingQuery:
    """K5: print each micro-batch, untruncated, append mode."""
    writer = df.writeStream.format("console").outputMode("append").option("truncate", str(truncate).lower())
    return with_trigger(writer, trigger).start()


def start_memory_sink(df: DataFrame, name: str, output_mode: str = "append", trigger: dict | None = None) -> StreamingQuery:
    """In-session table ``name`` holding the stream's output (tests, notebooks)."""
    writer = df.writeStream.format("memory").queryName(name).outputMode(output_mode)
    return with_trigger(writer, trigger).start()


def start_ingest(
    spark: SparkSession,
    parsed: DataFrame,
    path: str,
    checkpoint: str,
    table: str | None = None,
    trigger: dict | None = None,
    meter: Meter = METER,
    partition_by: Sequence[str] = PARTITION_COLUMNS,
    by: Sequence[str] = (),
    files_per_partition: int | None = FILES_PER_PARTITION,
) -> StreamingQuery:
    """Set up the catalog table first (G18), then start the sink.

    ``parsed`` is a streaming frame of typed readings (from ``parse_json``,
    ``parse_raw_lines`` …); its columns ``by`` (a meter id) are stored as
    well. The caller awaits or stops the returned query.
    """
    if table:
        schema = stored_schema(meter, [parsed.schema[c] for c in by])
        catalog.create_table(spark, table, path, schema, partition_by)
    stored = to_stored(parsed, meter, by)
    return start_parquet_sink(stored, path, checkpoint, partition_by, trigger, files_per_partition=files_per_partition)


def parse_wire(messages: DataFrame, wire: str = "json", meter: Meter = METER, carry: Sequence[T.StructField] = ()) -> DataFrame:
    """Message values → typed readings: ``json`` (M2, with the fields
    ``carry`` of the publisher) or ``raw`` ``;`` lines (M5); ``zone`` (M4)
    gives the legacy time text, zone and power, which are not readings."""
    if carry and wire != "json":
        raise ValueError(f"{wire} messages carry no further fields")
    if wire == "json":
        return parse_json(messages, "value", meter, carry)
    if wire == "raw":
        return parse_raw_lines(messages, "value", meter)
    if wire == "zone":
        return parse_json_zone(messages, "value")
    raise ValueError(f"unknown wire format {wire!r}")


def start_kafka_ingest(
    spark: SparkSession,
    settings: Settings,
    path: str,
    checkpoint: str,
    table: str | None = None,
    wire: str = "json",
    trigger: dict | None = None,
    meter: Meter = METER,
    carry: Sequence[T.StructField] = (),
) -> StreamingQuery:
    """The deployed pipeline: Kafka topic → parse → clean_stream → Parquet,
    every ``settings.trigger_seconds`` unless another trigger is given, with
    the key fields ``carry`` of the messages in the stored form."""
    if wire == "zone":
        raise ValueError("legacy messages are no readings: they can be watched, not stored")
    parsed = parse_wire(read_kafka(spark, settings), wire, meter, carry)
    keys = [f.name for f in carry]
    return start_ingest(spark, parsed, path, checkpoint, table, trigger or interval(settings.trigger_seconds), meter, by=keys)


def start_watch(
    spark: SparkSession,
    messages: DataFrame,
    wire: str = "zone",
    meter: Meter = METER,
    trigger: dict | None = None,
) -> StreamingQuery:
    """A stream of messages of any wire, parsed and printed batch by
    batch. A message that cannot be parsed shows as a row of NULLs."""
    return start_console_sink(parse_wire(messages, wire, meter), trigger=trigger)


def run_until_stopped(query: StreamingQuery, on_stop: Callable[[], None] | None = None) -> None:
    """Await termination; on interrupt or error stop the query and
    re-raise, so a failure is never reported as success."""
    try:
        query.awaitTermination()
    except BaseException:
        log.warning("stopping stream %s", query.id)
        query.stop()
        raise
    finally:
        if on_stop:
            on_stop()

"""Readings carried as messages: JSON values (M2, M4), Kafka or file spools.

The Kafka connector is a run-time package; only ``read_kafka`` needs it, so
everything else (parsing, the file-spool stream used in tests) works without.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.functions.parse import binary_text, iso_datetime
from meterlake.schema import METER, WIRE_LEGACY, Meter, wire_schema
from meterlake.settings import Settings

MESSAGE_SCHEMA = "value string"
# Fixed value: topic of the legacy messages.
LEGACY_TOPIC = "energy-data"


def kafka_options(settings: Settings, topic: str | None = None, starting_offsets: str | None = None) -> dict[str, str]:
    """Source options (S4, S5, W3): brokers, one topic, offsets, loss policy;
    optionally a cap on records per micro-batch (bounded batch size after a
    backlog) and more read tasks than topic partitions."""
    opts = {
        "kafka.bootstrap.servers": ",".join(settings.brokers),
        "subscribe": topic or settings.kafka_topic,
        "startingOffsets": starting_offsets or settings.starting_offsets,
        "failOnDataLoss": str(settings.fail_on_data_loss).lower(),
    }
    if settings.max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(settings.max_offsets_per_trigger)
    if settings.min_partitions:
        opts["minPartitions"] = str(settings.min_partitions)
    return opts


def read_kafka(spark: SparkSession, settings: Settings, **overrides: str) -> DataFrame:
    """Streaming frame of raw Kafka records (needs the Kafka connector)."""
    return spark.readStream.format("kafka").options(**kafka_options(settings, **overrides)).load()


def read_spool(
    spark: SparkSession, path: str, stream: bool = True, max_files_per_trigger: int | None = None, max_bytes_per_trigger: int | None = None
) -> DataFrame:
    """Messages written one per line under ``path`` (a Kafka stand-in):
    ``value`` text, as a stream (default) or a batch frame."""
    if not stream:
        return spark.read.schema(MESSAGE_SCHEMA).text(path)
    reader = spark.readStream.schema(MESSAGE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes_per_trigger))
    return reader.text(path)


def parse_json(
    df: DataFrame, column: str = "value", meter: Meter = METER, carry: Sequence[T.StructField] = (), raw: str | None = None
) -> DataFrame:
    """JSON message values → typed readings (P7-P9), with the fields
    ``carry`` that a publisher added (a message id, a meter key) and, on request, the
    text itself in the column ``raw``.

    PERMISSIVE parsing: a malformed document gives all NULLs, a field of the
    wrong type gives NULL for that field only; the datetime text is converted
    with ``try_cast``. Batch or stream.
    """
    data = F.from_json(binary_text(F.col(column)), wire_schema(meter, carry))
    text = [binary_text(F.col(column)).alias(raw)] if raw else []
    out = df.select(data.alias("_m"), *text).select("_m.*", *([raw] if raw else [])).withColumn("datetime", iso_datetime(F.col("datetime")))
    return out if meter.time == "datetime" else out.withColumnRenamed("datetime", meter.time)


def parse_json_zone(df: DataFrame, column: str = "value") -> DataFrame:
    """Legacy JSON values (M4) → ``timestamp`` (text), ``zone``, ``power``."""
    data = F.from_json(binary_text(F.col(column)), WIRE_LEGACY)
    return df.select(data.alias("_m")).select("_m.*")

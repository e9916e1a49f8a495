"""Readings and results as JSON text (P10, K4, K6).

Serialisation is a projection (``to_json``) evaluated in the executors; the
driver never sees the rows. Publishing is a distributed write: every task
sends its own partition, unlike a row loop on one machine.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.functions.display import datetime_text
from meterlake.schema import ISO_DATETIME_PATTERN, METER, Meter
from meterlake.settings import Settings

# Timestamps in results as ISO 8601 without fraction; NULL fields kept.
RESULT_JSON_OPTIONS = {
    "timestampFormat": ISO_DATETIME_PATTERN,
    "timestampNTZFormat": ISO_DATETIME_PATTERN,
    "ignoreNullFields": "false",
}


def message_value(meter: Meter = METER, carry: Sequence[str] = ()) -> Column:
    """One reading → its wire JSON (M2): datetime text, the measures, and the
    columns ``carry`` (a message id, a meter key)."""
    t = F.col(meter.time)
    return F.to_json(F.struct(datetime_text(t).alias("datetime"), *[F.col(m) for m in (*meter.measures, *carry)]))


def to_messages(df: DataFrame, meter: Meter = METER, carry: Sequence[str] = (), key: str | None = None) -> DataFrame:
    """Readings → ``value`` column of JSON messages (K4), with the text of the
    column ``key`` as message key if one is named."""
    keys = [F.col(key).cast("string").alias("key")] if key else []
    return df.select(*keys, message_value(meter, carry).alias("value"))


def legacy_message_value(meter: Meter = METER) -> Column:
    """Labelled reading → legacy JSON (M4): timestamp text, zone, power."""
    return F.to_json(
        F.struct(
            datetime_text(F.col(meter.time)).alias("timestamp"),
            F.col("zone"),
            F.col(meter.active).alias("power"),
        )
    )


def write_spool(messages: DataFrame, path: str, mode: str = "append") -> None:
    """Messages as JSON lines under ``path`` (the file stand-in for a topic)."""
    messages.select("value").write.mode(mode).text(path)


def publish_kafka(messages: DataFrame, settings: Settings, topic: str | None = None) -> None:
    """Batch-publish ``value`` rows, by ``key`` where there is one, to a topic
    (needs the Kafka connector)."""
    (
        messages.select(*[c for c in ("key", "value") if c in messages.columns])
        .write.format("kafka")
        .option("kafka.bootstrap.servers", ",".join(settings.brokers))
        .option("topic", topic or settings.kafka_topic)
        .save()
    )


def result_json(df: DataFrame, column: str = "json") -> DataFrame:
    """Any result → one JSON object per row (K6): ISO timestamps, NULLs kept,
    every Spark type serialisable (decimals included)."""
    return df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), RESULT_JSON_OPTIONS).alias(column))


def json_array(df: DataFrame) -> Iterator[str]:
    """A result as the lines of one JSON array, an object a line, fetched
    partition by partition; an empty result is ``[]``. A failing query raises
    at its first line, before any bracket is given."""
    rows = result_json(df).toLocalIterator()
    line = next(rows, None)
    if line is None:
        yield "[]"
        return
    yield "["
    for following in rows:
        yield line.json + ","
        line = following
    yield line.json
    yield "]"

"""Declared schemas of every form a reading takes, and the column roles.

Schemas are always declared, never inferred: inference turns the time of day
into a timestamp dated today and measure columns holding ``?`` into strings.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Header of the raw ';' text (M1), in file order.
RAW_HEADER = (
    "Date",
    "Time",
    "Global_active_power",
    "Global_reactive_power",
    "Voltage",
    "Global_intensity",
    "Sub_metering_1",
    "Sub_metering_2",
    "Sub_metering_3",
)
# The marker for a missing measure and the raw date/time layout.
MISSING_MARKER = "?"
RAW_SEPARATOR = ";"
RAW_DATETIME_PATTERN = "d/M/yyyy H:mm:ss"
# Text layout of the wire datetime and of report timestamps.
WIRE_DATETIME_PATTERN = "yyyy-MM-dd HH:mm:ss"
ISO_DATETIME_PATTERN = "yyyy-MM-dd'T'HH:mm:ss"


@dataclass(frozen=True)
class Meter:
    """Names of the time column, the measures and the sub-meters.

    Every operator takes one of these so that another meter layout only needs
    a different ``Meter``; the default is the household layout.
    """

    time: str = "datetime"
    active: str = "global_active_power"
    reactive: str = "global_reactive_power"
    voltage: str = "voltage"
    intensity: str = "global_intensity"
    submeters: tuple[str, ...] = ("sub_metering_1", "sub_metering_2", "sub_metering_3")

    @property
    def measures(self) -> tuple[str, ...]:
        return (self.active, self.reactive, self.voltage, self.intensity, *self.submeters)

    @property
    def zones(self) -> tuple[str, ...]:
        return tuple(f"zone{i}" for i in range(1, len(self.submeters) + 1))


METER = Meter()

# Partition columns of the stored form, coarse to fine.
PARTITION_COLUMNS = ("year", "month", "day", "hour")


def _doubles(names) -> list[T.StructField]:
    return [T.StructField(n, T.DoubleType(), True) for n in names]


# M1: raw text, every column read as text and converted afterwards.
RAW = T.StructType([T.StructField(n, T.StringType(), True) for n in RAW_HEADER])

def wire_schema(meter: Meter = METER, carry=()) -> T.StructType:
    """M2: JSON value of a wire message for a meter's measures, with the
    fields ``carry`` after them."""
    return T.StructType([T.StructField("datetime", T.StringType(), True), *_doubles(meter.measures), *carry])


WIRE = wire_schema()

# M4: legacy JSON value.
WIRE_LEGACY = T.StructType(
    [
        T.StructField("timestamp", T.StringType(), True),
        T.StructField("zone", T.StringType(), True),
        T.StructField("power", T.DoubleType(), True),
    ]
)

def stored_schema(meter: Meter = METER, keys=()) -> T.StructType:
    """M3: stored reading of a meter, with the fields ``keys`` (a meter id)
    after the zone and the partition columns last."""
    return T.StructType(
        [
            T.StructField(meter.time, T.TimestampType(), True),
            *_doubles(meter.measures),
            T.StructField("zone", T.StringType(), True),
            *keys,
            *[T.StructField(p, T.IntegerType(), True) for p in PARTITION_COLUMNS],
        ]
    )


STORED = stored_schema()

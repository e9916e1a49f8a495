"""Raw ``;`` text readings (M1, M5): files and message values.

One parser for both places the raw form shows up: the CSV reader for files
(splittable, parallel across the cluster, header and blank lines handled by
the reader) and ``from_csv`` for single lines carried as message values.
Both use the same all-text schema; conversion happens in ``parse_raw_columns``
with ``try_`` functions so ``?`` and junk become NULL instead of failing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterlake.functions.parse import raw_datetime, to_number
from meterlake.schema import METER, MISSING_MARKER, RAW, RAW_HEADER, RAW_SEPARATOR, Meter

RAW_DDL = ", ".join(f"{name} STRING" for name in RAW_HEADER)
CSV_OPTIONS = {"sep": RAW_SEPARATOR, "header": "true", "mode": "PERMISSIVE"}


def parse_raw_columns(df: DataFrame, meter: Meter = METER, carry: Sequence[str] = ()) -> DataFrame:
    """Raw text columns → ``datetime`` + seven doubles, lower-case names
    (P1-P6), and the columns ``carry`` as they are."""
    date, time, *measures = RAW_HEADER
    cols: list[Column] = [raw_datetime(F.col(date), F.col(time)).alias(meter.time)]
    cols += [to_number(F.col(src)).alias(dst) for src, dst in zip(measures, meter.measures)]
    return df.select(*cols, *carry)


def read_raw(spark: SparkSession, path: str, meter: Meter = METER) -> DataFrame:
    """Raw file(s) or a directory of them → typed readings.

    A missing path raises Spark's ``PATH_NOT_FOUND``; a directory is read as
    all files below it. The header row is consumed by the reader; blank lines
    are skipped by it.
    """
    raw = spark.read.schema(RAW).options(**CSV_OPTIONS).csv(path)
    return parse_raw_columns(raw, meter)


def read_raw_lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw file(s) as one ``value`` line per row, unparsed (the M5 wire form)."""
    return spark.read.text(path)


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw lines with the file they are in and their number there (``value,
    file, line``, from 0, blank and header lines counted).

    A first scan counts the lines of each split, a running sum over the splits
    of a file tells where each begins, and a second scan adds the place in
    the split. The numbers do not depend on how files are split; a window
    holds one row a split of one file, never lines. Should the second scan be
    split otherwise than the first, it fails instead of numbering wrongly.
    """
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_id"),
    )
    before = Window.partitionBy("file").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    splits = (
        lines.groupBy("file", "_start")
        .agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0).cast("long")))
    )
    place = F.col("_id") - F.col("_first")
    checked = F.when((place >= 0) & (place < F.col("_n")), F.col("_before") + place).otherwise(
        F.raise_error(F.lit("the files were split otherwise than when their lines were counted")).cast("long")
    )
    return lines.join(splits, ["file", "_start"]).select("value", "file", checked.alias("line"))


def line_id() -> Column:
    """File, number and hash of a numbered line: the same whenever the same
    file is published, and different for equal lines at two places."""
    return F.concat_ws(":", F.col("file"), F.col("line").cast("string"), F.hex(F.xxhash64("value")))


def write_raw(df: DataFrame, path: str, meter: Meter = METER) -> None:
    """Readings as raw text files (M1) in the frame's own partitioning, each
    file with the header line. The line is the only column, so the separator
    of the writer is one that no line holds."""
    lines = df.select(raw_line(meter).alias(RAW_SEPARATOR.join(RAW_HEADER)))
    options = {"header": "true", "sep": "\u0001", "quote": "", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    lines.write.options(**options).csv(path)


def is_data_line(line: Column) -> Column:
    """Not blank and not the header line."""
    text = F.trim(line)
    return (text != F.lit("")) & ~text.startswith(RAW_HEADER[0] + RAW_SEPARATOR)


def parse_raw_lines(df: DataFrame, column: str = "value", meter: Meter = METER, carry: Sequence[str] = ()) -> DataFrame:
    """Lines of raw text (file lines or message values) → typed readings.

    Works on batch and streaming frames alike.
    """
    line = F.col(column).cast("string")
    parsed = F.from_csv(line, F.lit(RAW_DDL), {"sep": RAW_SEPARATOR})
    fields = df.filter(is_data_line(line)).select(parsed.alias("_raw"), *carry).select("_raw.*", *carry)
    return parse_raw_columns(fields, meter, carry)


def raw_line(meter: Meter = METER) -> Column:
    """A reading rendered back to its raw line: ``d/M/yyyy;HH:mm:ss;x.xxx;…``
    with ``?`` for a missing measure."""
    t = F.col(meter.time)
    parts = [F.date_format(t, "d/M/yyyy"), F.date_format(t, "HH:mm:ss")]
    # format_string renders NULL as "nul" under %.3f, so test for NULL first
    parts += [
        F.when(F.col(m).isNull(), F.lit(MISSING_MARKER)).otherwise(F.format_string("%.3f", F.col(m)))
        for m in meter.measures
    ]
    return F.concat_ws(RAW_SEPARATOR, *parts)

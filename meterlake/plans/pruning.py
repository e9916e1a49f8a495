"""Time windows that prune stored partitions (X9, §4.1).

Catalyst cannot derive ``year/month/day/hour`` predicates from a filter on
``datetime``, so these helpers add them. Bounds may be literals or scalar
subqueries (``DataFrame.scalar()``): the plan stays lazy and one piece, and a
scalar subquery over partition columns is evaluated at run time as a
partition filter, so only the matching directories are listed and read.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.plans import catalog
from meterlake.schema import METER, PARTITION_COLUMNS, Meter


def has_partitions(df: DataFrame) -> bool:
    return all(c in df.columns for c in PARTITION_COLUMNS)


def partition_hour() -> Column:
    """Start of the hour a stored partition holds, from its partition values."""
    y, m, d, h = (F.col(c) for c in PARTITION_COLUMNS)
    return F.make_timestamp(y, m, d, h, F.lit(0), F.lit(0))


def _as_col(x: Column | dt.datetime | str) -> Column:
    if isinstance(x, Column):
        return x
    return F.lit(x).cast("timestamp")


def latest_instant(df: DataFrame, meter: Meter = METER, partitioned: bool = False) -> Column:
    """``max(time)`` as a scalar subquery.

    With ``partitioned`` (a stored table whose ``year/month/day/hour`` are
    directory partitions) the newest hour is found from partition values
    alone, which reads no data column, and the maximum timestamp is then
    taken inside that one hour. On any other frame those columns would be
    computed from the data, so the plain maximum is cheaper.
    """
    t = F.col(meter.time)
    if partitioned and has_partitions(df):
        newest_hour = df.select(F.max(partition_hour())).scalar()
        return df.filter(partition_hour() == newest_hour).select(F.max(t)).scalar()
    return df.select(F.max(t)).scalar()


def between(
    df: DataFrame,
    start: Column | dt.datetime | str | None,
    end: Column | dt.datetime | str | None,
    meter: Meter = METER,
    include_start: bool = False,
    partitioned: bool = False,
) -> DataFrame:
    """Rows with ``start < time <= end`` (``start <= time`` when
    ``include_start``); either bound may be omitted. With ``partitioned``
    the implied ``year/month/day/hour`` predicates are added as well, which
    Spark applies as partition filters."""
    t = F.col(meter.time)
    conds = []
    ph = partition_hour() if partitioned and has_partitions(df) else None
    if start is not None:
        s = _as_col(start)
        conds.append((t >= s) if include_start else (t > s))
        if ph is not None:
            conds.append(ph >= F.date_trunc("hour", s))
    if end is not None:
        e = _as_col(end)
        conds.append(t <= e)
        if ph is not None:
            conds.append(ph <= e)
    for c in conds:
        df = df.filter(c)
    return df


def last_hours(df: DataFrame, hours: int, meter: Meter = METER, partitioned: bool = False) -> DataFrame:
    """Rows in the ``hours`` hours up to the newest reading (X9). The newest
    reading is the upper bound by definition, so only the lower one is
    applied."""
    newest = latest_instant(df, meter, partitioned)
    return between(df, newest - F.make_interval(hours=F.lit(hours)), None, meter, partitioned=partitioned)


def newest_hours_bound(df: DataFrame, k: int) -> Column:
    """On a stored partitioned table: the k-th newest hour that it has
    (scalar subquery). Every stored hour holds a reading, so the newest k
    hours hold the newest k rows and the newest k timestamps; the bound comes
    from partition values, and no data column is read for it."""
    hours = df.select(partition_hour().alias("_h")).distinct()
    return hours.orderBy(F.col("_h").desc()).limit(k).select(F.min("_h")).scalar()


def newest_bound(df: DataFrame, k: int, meter: Meter = METER, distinct: bool = False) -> Column:
    """The k-th newest timestamp (of distinct timestamps when ``distinct``)
    as a scalar subquery: a top-k over the time column alone. With
    ``distinct`` the distinct step shuffles first, so the final top-k merges
    k rows per shuffle partition, not per input split."""
    t = F.col(meter.time)
    times = df.select(t).filter(t.isNotNull())
    if distinct:
        times = times.distinct()
    return times.orderBy(t.desc()).limit(k).select(F.min(t)).scalar()


def newest(df: DataFrame, k: int, meter: Meter = METER, distinct: bool = False) -> DataFrame:
    """Rows no older than needed for a newest-k report, on a stored
    partitioned table: full rows are read from the newest partitions only.

    The newest k hours come from partition values; the k-th newest time (of
    distinct times, when ``distinct``) from the time column of those hours
    alone. Everything at or after it is kept, so a top-k over the result is
    exact, and no step of it runs over the whole table's data.
    """
    recent = between(df, newest_hours_bound(df, k), None, meter, include_start=True, partitioned=True)
    bound = newest_bound(recent, k, meter, distinct)
    return between(df, bound, None, meter, include_start=True, partitioned=True)


# --- catalog tables: bounds from the partition list, without opening a file ----


def newest_hours_of_table(spark: SparkSession, table: str, k: int) -> list[dt.datetime]:
    """The ``k`` newest hours for which ``table`` has a partition, newest
    first. They come from the catalog's list of partitions; no directory is
    listed and no file is opened."""
    values = [F.regexp_extract("partition", f"(?:^|/){c}=([0-9]+)(?:/|$)", 1).try_cast("int") for c in PARTITION_COLUMNS]
    hours = catalog.partitions(spark, table).select(F.try_make_timestamp(*values, F.lit(0), F.lit(0)).alias("_h"))
    return [r["_h"] for r in hours.dropna().distinct().orderBy(F.col("_h").desc()).limit(k).collect()]


def newest_in_table(spark: SparkSession, table: str, k: int, meter: Meter = METER, distinct: bool = False) -> DataFrame:
    """Rows of a catalog table that a newest-``k`` report needs. The first
    guess is its ``k`` newest hours, of which each normally holds a row; the
    rows (distinct times) there are counted, and hours are added while they
    are too few, as hours may be registered that hold none. Every bound is a
    literal, so only those partitions are planned, listed and read."""
    df, hours, t = catalog.read_table(spark, table), k, F.col(meter.time)
    while True:
        found = newest_hours_of_table(spark, table, hours)
        if not found:
            return df.filter(F.lit(False))
        recent = between(df, found[-1], None, meter, include_start=True, partitioned=True)
        times = recent.select(t).filter(t.isNotNull())
        enough = (times.distinct() if distinct else times).limit(k).count() >= k
        if enough or len(found) < hours:  # all hours there are
            return recent
        hours *= 4


def last_hours_in_table(spark: SparkSession, table: str, hours: int, meter: Meter = METER) -> DataFrame:
    """The ``hours`` hours up to the newest reading of a catalog table (X9);
    the newest reading is sought in the newest hours that hold one."""
    newest_row = newest_in_table(spark, table, 1, meter).select(F.max(meter.time).alias("t")).first()
    df = catalog.read_table(spark, table)
    if newest_row is None or newest_row["t"] is None:
        return df.filter(F.lit(False))
    return between(df, newest_row["t"] - dt.timedelta(hours=hours), None, meter, partitioned=True)

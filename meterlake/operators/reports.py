"""Dashboard and catalog reports.

Every report is ``DataFrame → DataFrame`` and takes ``by`` (extra grouping
keys such as a meter id; ``()`` reproduces the single-household results).
Aggregates are all algebraic (count/sum/avg/min/max), so Spark runs them as a
partial aggregate before the shuffle and a hot key never reaches one task
with its raw rows. Top-k uses ``row_number() <= k``, which Spark turns into a
partial ``WindowGroupLimit`` below the shuffle: per group, or per bucket of
input splits with a last merge of k rows a bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.functions.display import datetime_text
from meterlake.plans.pruning import newest
from meterlake.schema import METER, Meter


def _keys(by: Sequence[str]) -> list[Column]:
    return [F.col(b) for b in by]


#: Buckets of input splits whose best rows are merged apart, before the last merge.
TOP_K_BUCKETS = 256


def top_k(df: DataFrame, order: Sequence[Column], k: int, by: Sequence[str] = (), buckets: int = TOP_K_BUCKETS) -> DataFrame:
    """The first ``k`` rows in ``order``, overall or per ``by`` group.

    Overall in two levels: every task keeps its first ``k`` rows, the tasks'
    rows meet in ``buckets`` groups that keep ``k`` each, and the last merge
    reads ``buckets * k`` rows at most, however many input splits there are.
    """
    if not by:
        rows = df.withColumn("_bucket", F.pmod(F.spark_partition_id(), F.lit(buckets)))
        return top_k(rows, order, k, ["_bucket"]).drop("_bucket").orderBy(*order).limit(k)
    rank = F.row_number().over(Window.partitionBy(*_keys(by)).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= k).drop("_rank")


def statistics_columns(meter: Meter = METER) -> dict[str, str]:
    """What the statistics report holds: each output column and the SQL
    aggregate it is. The report and SQL text over files or views are both
    built from it."""
    active, total = meter.active, " + ".join(meter.submeters)
    return {
        "total_records": "count(*)",
        **{f"{fn}_active_power": f"{fn}({active})" for fn in ("avg", "max", "min")},
        "avg_voltage": f"avg({meter.voltage})",
        "avg_intensity": f"avg({meter.intensity})",
        # a row with any sub-meter NULL is skipped, not counted as 0
        "total_sub_metering": f"sum({total})",
    }


def statistics(df: DataFrame, meter: Meter = METER, by: Sequence[str] = ()) -> DataFrame:
    """A1: whole-table statistics; empty input gives count 0 and NULLs."""
    return df.groupBy(*_keys(by)).agg(*[F.expr(e).alias(name) for name, e in statistics_columns(meter).items()])


def statistics_sql(source: str, meter: Meter = METER) -> str:
    """A1 as SQL text over a view, a table or a file path."""
    return "SELECT " + ", ".join(f"{e} AS {name}" for name, e in statistics_columns(meter).items()) + f" FROM {source}"


def timeseries(
    df: DataFrame,
    limit: int | None = 100,
    meter: Meter = METER,
    by: Sequence[str] = (),
    partitioned: bool = False,
) -> DataFrame:
    """A2 + T2: averages per exact timestamp, newest ``limit`` groups (all
    when ``None``), returned oldest first for charting. On a stored
    partitioned table (``partitioned``) only the newest partitions are read
    in full (``pruning.newest``)."""
    t = F.col(meter.time)
    if partitioned and limit is not None and not by:
        df = newest(df, limit, meter, distinct=True)
    grouped = (
        df.filter(t.isNotNull())
        .groupBy(*_keys(by), t)
        .agg(
            F.avg(meter.active).alias("avg_active_power"),
            F.avg(meter.voltage).alias("avg_voltage"),
            F.avg(meter.intensity).alias("avg_intensity"),
            *[F.avg(s).alias(s) for s in meter.submeters],
        )
    )
    picked = grouped if limit is None else top_k(grouped, [t.desc()], limit, by)
    return picked.orderBy(*_keys(by), t)


def default_tiebreak(df: DataFrame, meter: Meter = METER) -> list[str]:
    """A row id when there is one, else the measures: readings equal in time
    and every measure are indistinguishable, so either order is the same."""
    return [c for c in ("event_id",) if c in df.columns] or list(meter.measures)


def latest(
    df: DataFrame,
    limit: int = 100,
    meter: Meter = METER,
    tiebreak: Sequence[str] | None = None,
    by: Sequence[str] = (),
    partitioned: bool = False,
) -> DataFrame:
    """Newest ``limit`` readings, newest first; ``tiebreak`` columns make
    the cut deterministic when readings share a timestamp (G8). On a stored
    partitioned table (``partitioned``) only the newest partitions are read
    in full (``pruning.newest``)."""
    if tiebreak is None:
        tiebreak = default_tiebreak(df, meter)
    if partitioned and not by:
        df = newest(df, limit, meter)
    order = [F.col(meter.time).desc_nulls_last(), *[F.col(c).desc() for c in tiebreak]]
    picked = top_k(df, order, limit, by)
    if by:  # per-group top-k comes back unordered
        picked = picked.orderBy(*_keys(by), *order)
    return picked.select(*_keys(by), meter.time, *meter.measures)


def latest_text(
    df: DataFrame,
    limit: int = 100,
    meter: Meter = METER,
    tiebreak: Sequence[str] | None = None,
    by: Sequence[str] = (),
    partitioned: bool = False,
) -> DataFrame:
    """T1 + P22: as ``latest`` with the timestamp as ``yyyy-MM-dd HH:mm:ss``."""
    rows = latest(df, limit, meter, tiebreak, by, partitioned)
    return rows.withColumn(meter.time, datetime_text(F.col(meter.time)))


def hour_profile(df: DataFrame, meter: Meter = METER, by: Sequence[str] = ()) -> DataFrame:
    """A3: mean active power and voltage and row count by hour of day.

    On stored readings the ``hour`` partition column is grouped on directly,
    so the timestamp column is never read and the NULL test is a partition
    filter; otherwise the hour is derived from the timestamp.
    """
    if "hour" in df.columns:
        hour = F.col("hour")
        keep = hour.isNotNull()
    else:
        hour = F.hour(meter.time)
        keep = F.col(meter.time).isNotNull()
    return (
        df.filter(keep)
        .groupBy(*_keys(by), hour.alias("hour"))
        .agg(
            F.avg(meter.active).alias("avg_active_power"),
            F.avg(meter.voltage).alias("avg_voltage"),
            F.count(F.lit(1)).alias("record_count"),
        )
        .orderBy(*_keys(by), "hour")
    )


def zone_counts(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows per zone."""
    return df.groupBy(*_keys(by), "zone").agg(F.count(F.lit(1)).alias("record_count"))


def month_counts(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows per year and month (partition columns of stored readings)."""
    return df.groupBy(*_keys(by), "year", "month").agg(F.count(F.lit(1)).alias("record_count"))


def record_count(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Row count as a one-row frame (Parquet footers answer it)."""
    return df.groupBy(*_keys(by)).agg(F.count(F.lit(1)).alias("record_count"))


def year_slice(df: DataFrame, year: int) -> DataFrame:
    """rows of one year; on stored readings a partition filter."""
    return df.filter(F.col("year") == F.lit(year))


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    """T4: any ``n`` rows."""
    return df.limit(n)


def _submeter_rows(meter: Meter, value_of) -> Column:
    """Array of (submeter, zone, value) structs, exploded by the caller: a
    fixed-size unpivot of one row per group."""
    return F.array(
        *[
            F.struct(F.lit(s).alias("submeter"), F.lit(z).alias("zone"), value_of(s).alias("value_wh"))
            for s, z in zip(meter.submeters, meter.zones)
        ]
    )


def submeter_latest(
    df: DataFrame,
    meter: Meter = METER,
    tiebreak: Sequence[str] | None = None,
    by: Sequence[str] = (),
    partitioned: bool = False,
) -> DataFrame:
    """A9 (a): the newest reading's sub-meter values, one row per sub-meter."""
    newest_row = latest(df, 1, meter, tiebreak, by, partitioned)
    unpivot = F.inline(_submeter_rows(meter, F.col))
    return newest_row.select(*_keys(by), unpivot)


def submeter_share(df: DataFrame, meter: Meter = METER, by: Sequence[str] = ()) -> DataFrame:
    """A9 (b): total Wh per sub-meter and its share of the sum of the three.

    Aggregates first (one partial-aggregated pass), then unpivots the single
    row per group, so the input is never tripled.
    """
    totals = df.groupBy(*_keys(by)).agg(*[F.sum(s).alias(s) for s in meter.submeters])
    grand = sum((F.coalesce(F.col(s), F.lit(0.0)) for s in meter.submeters[1:]), F.coalesce(F.col(meter.submeters[0]), F.lit(0.0)))
    rows = totals.select(*_keys(by), grand.alias("_grand"), F.inline(_submeter_rows(meter, F.col)))
    return rows.select(
        *_keys(by),
        "submeter",
        "zone",
        F.col("value_wh").alias("total_wh"),
        F.try_divide(F.col("value_wh"), F.col("_grand")).alias("share"),
    )

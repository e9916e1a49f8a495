"""Forward-looking analytics.

Readings are first reduced by partial aggregations to hourly, daily or
weekday × hour rows; everything after that works on those small tables.
Windows run only over such pre-aggregated rows with a per-key bound (one
row per day for a (meter, hour of day) key, at most 168 slots per meter),
joins only where there are two inputs, and a join side is broadcast only
with a static size bound (``plans.joins``). No task ever holds an
unbounded group of readings.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.functions.calendar import hour_start, is_weekend
from meterlake.operators import regression
from meterlake.operators.reports import timeseries
from meterlake.plans.joins import bounded_broadcast, profile_bound
from meterlake.plans.pruning import last_hours
from meterlake.schema import METER, Meter
from meterlake.session import checkpoint_root

HOURS_PER_DAY = 24
HOURS_PER_WEEK = 7 * 24


def _keys(by: Sequence[str]) -> list[Column]:
    return [F.col(b) for b in by]


def hourly_load(df: DataFrame, meter: Meter = METER, by: Sequence[str] = ()) -> DataFrame:
    """Mean active power per clock hour: ``hour_start, load, readings``."""
    return df.groupBy(*_keys(by), hour_start(F.col(meter.time)).alias("hour_start")).agg(
        F.avg(meter.active).alias("load"), F.count(F.lit(1)).alias("readings")
    )


def quality(df: DataFrame, meter: Meter = METER, by: Sequence[str] = ()) -> DataFrame:
    """Rows, missing values per column (NULL or NaN), unparsable or
    missing timestamps, negative and zero power; one pass."""
    def missing(c: str) -> Column:
        col = F.col(c)
        return F.count_if(col.isNull() | F.isnan(col)).alias(f"missing_{c}")

    return df.groupBy(*_keys(by)).agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(F.col(meter.time).isNull()).alias(f"missing_{meter.time}"),
        *[missing(m) for m in meter.measures],
        F.count_if(F.col(meter.active) < 0).alias("negative_active_power"),
        F.count_if(F.col(meter.reactive) < 0).alias("negative_reactive_power"),
        F.count_if(F.col(meter.active) == 0).alias("zero_active_power"),
    )


def timeseries_hours(df: DataFrame, hours: int = 24, meter: Meter = METER, partitioned: bool = False) -> DataFrame:
    """The time series of the last ``hours`` hours before the newest
    reading (all timestamps in the window, oldest first). On a stored
    partitioned table (``partitioned``) only the window's partitions are read."""
    return timeseries(last_hours(df, hours, meter, partitioned), limit=None, meter=meter)


def weekday_profile(df: DataFrame, meter: Meter = METER, by: Sequence[str] = ()) -> DataFrame:
    """X11: mean active power and rows by weekday (1 = Sunday) × hour."""
    t = F.col(meter.time)
    return (
        df.groupBy(*_keys(by), F.dayofweek(t).alias("weekday"), F.hour(t).alias("hour"))
        .agg(F.avg(meter.active).alias("avg_active_power"), F.count(F.lit(1)).alias("record_count"))
        .withColumn("is_weekend", is_weekend(F.col("weekday")))
    )


def weekend_profile(df: DataFrame, meter: Meter = METER, by: Sequence[str] = ()) -> DataFrame:
    """X11: weekend against weekday, by hour of day."""
    t = F.col(meter.time)
    return df.groupBy(*_keys(by), is_weekend(F.dayofweek(t)).alias("is_weekend"), F.hour(t).alias("hour")).agg(
        F.avg(meter.active).alias("avg_active_power"), F.count(F.lit(1)).alias("record_count")
    )


def weekday_pivot(df: DataFrame, meter: Meter = METER, by: Sequence[str] = ()) -> DataFrame:
    """X11 for display: one row per hour, one column per weekday. The pivot
    values are listed, so Spark does not run a job to discover them, and the
    pivot runs as one partial aggregation."""
    t = F.col(meter.time)
    days = list(range(1, 8))
    wide = (
        df.withColumn("_weekday", F.dayofweek(t))
        .groupBy(*_keys(by), F.hour(t).alias("hour"))
        .pivot("_weekday", days)
        .agg(F.avg(meter.active))
    )
    return wide.select(*by, "hour", *[F.col(str(d)).alias(f"day_{d}") for d in days])


def peaks(df: DataFrame, k: float = 2.0, meter: Meter = METER, by: Sequence[str] = ()) -> DataFrame:
    """Clock hours whose mean load exceeds the mean + ``k`` sample standard
    deviations of the hourly means at the same hour of day.

    The hour-of-day statistics are window aggregates over the hourly table,
    partitioned by (by, hour of day): one scan of the readings, no join, and
    a window partition holds one row per day, however hot the key.
    """
    hourly = hourly_load(df, meter, by).withColumn("hour", F.hour("hour_start"))
    same_hour = Window.partitionBy(*_keys(by), F.col("hour"))
    stats = hourly.withColumns(
        {"profile_mean": F.avg("load").over(same_hour), "profile_std": F.stddev_samp("load").over(same_hour)}
    )
    threshold = F.col("profile_mean") + F.lit(k) * F.col("profile_std")
    return stats.filter(F.col("load") > threshold).select(
        *by,
        "hour_start",
        "hour",
        F.col("load").alias("avg_active_power"),
        "profile_mean",
        "profile_std",
        threshold.alias("threshold"),
    )


def align_shifted(
    df: DataFrame,
    time_col: str,
    value_col: str,
    shifts: dict[str, Column],
    by: Sequence[str] = (),
    current: str = "value",
) -> DataFrame:
    """A self-join on shifted time, written as one aggregation.

    Every row is emitted once as itself and once per shift (its time moved
    forward by that amount, its value under the shift's name); grouping on
    (by, time) puts each row next to the values from the shifted-away times.
    One shuffle of ``df`` instead of one join per shift, no skew (a key
    holds at most 1 + len(shifts) rows), and absent times stay NULL. Keys of
    ``df`` must be unique per (by, time).
    """
    names = [current, *shifts]
    null = F.lit(None).cast("double")

    def copy(at: Column, slot: str) -> Column:
        return F.struct(at.alias("_t"), *[(F.col(value_col) if n == slot else null).alias(n) for n in names])

    copies = F.array(copy(F.col(time_col), current), *[copy(F.col(time_col) + d, n) for n, d in shifts.items()])
    return (
        df.select(*by, F.inline(copies))
        .groupBy(*_keys(by), F.col("_t").alias(time_col))
        .agg(*[F.max(n).alias(n) for n in names])
    )


def day_compare(df: DataFrame, days_back: int = 7, meter: Meter = METER, by: Sequence[str] = ()) -> DataFrame:
    """Daily mean against the mean ``days_back`` days earlier.

    A self-join on the shifted date done by ``align_shifted``: one scan and
    one small shuffle of daily rows; missing days stay visible as gaps (a
    ``lag`` would silently compare with whatever day came before).
    """
    daily = df.groupBy(*_keys(by), F.to_date(meter.time).alias("day")).agg(F.avg(meter.active).alias("_avg"))
    paired = align_shifted(
        daily, "day", "_avg", {"prev_avg_active_power": F.make_interval(days=F.lit(days_back))},
        by, current="avg_active_power",
    ).withColumn("day", F.col("day").cast("date"))
    cur, prev = F.col("avg_active_power"), F.col("prev_avg_active_power")
    return paired.filter(cur.isNotNull() & prev.isNotNull()).withColumn("relative_change", F.try_divide(cur - prev, prev))


def forecast_profile(df: DataFrame, horizon: int = 24, meter: Meter = METER, by: Sequence[str] = ()) -> DataFrame:
    """Seasonal forecast of the ``horizon`` hours after the last hour
    seen: mean active power of the same weekday × hour (NULL for a slot
    never seen).

    One aggregation gives each (by, weekday, hour) slot its mean and newest
    time; a window over a group's slots (at most 168 rows, whatever the data
    size) gives the last hour seen. Each slot then emits the future hours
    that fall on it, one row per group emits the whole horizon with NULLs,
    and a final group-by keeps one row per hour: a left join of the horizon
    to the profile, with one scan and no join.
    """
    t = F.col(meter.time)
    slots = df.groupBy(*_keys(by), F.dayofweek(t).alias("weekday"), F.hour(t).alias("hour")).agg(
        F.avg(meter.active).alias("_f"), F.max(t).alias("_seen")
    )
    group = Window.partitionBy(*_keys(by))
    slots = slots.withColumns(
        {
            "_last": F.date_trunc("hour", F.max("_seen").over(group)),
            "_rn": F.row_number().over(group.orderBy("weekday", "hour")),
        }
    )
    last = F.col("_last")
    week = F.lit(HOURS_PER_WEEK)

    def slot_of(wd: Column, hr: Column) -> Column:
        return (wd - 1) * HOURS_PER_DAY + hr

    gap = F.pmod(slot_of(F.col("weekday"), F.col("hour")) - slot_of(F.dayofweek(last), F.hour(last)), week)
    first = F.when(gap == 0, week).otherwise(gap)
    offsets = F.when(first <= horizon, F.sequence(first, F.lit(horizon), week)).otherwise(
        F.array().cast("array<int>")
    )

    def at(k: Column, value: Column) -> Column:
        return F.struct((last + F.make_interval(hours=k)).alias("hour_start"), value.alias("f"))

    seen = F.transform(offsets, lambda k: at(k, F.col("_f")))
    horizon_rows = F.when(
        F.col("_rn") == 1,
        F.transform(F.sequence(F.lit(1), F.lit(horizon)), lambda k: at(k, F.lit(None).cast("double"))),
    ).otherwise(F.array().cast("array<struct<hour_start:timestamp,f:double>>"))
    rows = slots.select(*by, F.inline(F.concat(seen, horizon_rows)))
    return (
        rows.groupBy(*_keys(by), "hour_start")
        .agg(F.max("f").alias("forecast_active_power"))
        .select(
            *by,
            "hour_start",
            F.dayofweek("hour_start").alias("weekday"),
            F.hour("hour_start").alias("hour"),
            "forecast_active_power",
        )
    )


def hourly_means(series: DataFrame, values: Sequence[str], meter: Meter = METER) -> DataFrame:
    """An irregular series by the hour: ``h`` and the mean of each value."""
    return series.groupBy(hour_start(F.col(meter.time)).alias("h")).agg(*[F.avg(v).alias(v) for v in values])


def weather_impact(
    df: DataFrame, weather: DataFrame, meter: Meter = METER, by: Sequence[str] = ()
) -> DataFrame:
    """Hourly load left-joined to hourly weather (``h`` + numeric columns);
    Pearson correlation of each weather column with the load. Several weather
    rows of an hour count as their mean, so no hour of load counts twice."""
    load = hourly_load(df, meter, by)
    cols = [c for c in weather.columns if c != "h"]
    hours = weather.groupBy(F.col("h").alias("hour_start")).agg(*[F.avg(c).alias(c) for c in cols])
    joined = load.join(hours, on="hour_start", how="left")
    return joined.groupBy(*_keys(by)).agg(
        F.count(F.lit(1)).alias("hours"),
        *[F.count(c).alias(f"hours_with_{c}") for c in cols],
        *[F.corr(c, "load").alias(f"corr_{c}_load") for c in cols],
    )


LAGS = {"lag_1h": "INTERVAL 1 HOUR", "lag_24h": "INTERVAL 24 HOURS"}
FORECAST_FEATURES = (*LAGS, "hour", "is_weekend")


def lag_features(
    df: DataFrame, meter: Meter = METER, by: Sequence[str] = (), features: Sequence[str] = FORECAST_FEATURES
) -> DataFrame:
    """Hourly load with the named ``features``: its value 1 h and 24 h
    earlier, hour of day, the weekend flag. Hours lacking a named lag are
    dropped. Lags only look back, so a time-ordered split never feeds
    test-period values into training."""
    hourly = hourly_load(df, meter, by)
    lags = [c for c in features if c in LAGS]
    if lags:
        shifts = {c: F.expr(LAGS[c]) for c in lags}
        hourly = align_shifted(hourly, "hour_start", "load", shifts, by, current="load")
    made = {"hour": F.hour("hour_start").cast("double"), "is_weekend": is_weekend(F.dayofweek("hour_start")).cast("double")}
    return hourly.dropna(subset=["load", *lags]).select(
        *by, "hour_start", "load", *[made[c].alias(c) if c in made else F.col(c) for c in features]
    )


def ml_forecast(
    df: DataFrame,
    test_days: int = 7,
    meter: Meter = METER,
    by: Sequence[str] = (),
    features: Sequence[str] = FORECAST_FEATURES,
    daily: bool = False,
) -> DataFrame:
    """Linear regression on ``features`` trained on all but the last
    ``test_days`` days (of the whole input) and scored on them, next to the
    seasonal (weekday × hour) profile of the training period. One row per
    group and model: ``by, model, mae, test_hours``; groups without a test
    hour have none.

    The fit is one aggregation to moments, solved on columns in every group
    (``operators.regression``); with ``daily`` the moments are kept per day
    and merged, as a job that adds one day at a time does. The split is by
    time through a scalar bound, never random.
    """
    # The fit, the split bound and both scorings all read the features:
    # materialise them once in the shared checkpoint folder (hourly rows, far
    # smaller than the readings); a lost executor re-reads them from there.
    checkpoint_root(df.sparkSession)
    feats = lag_features(df, meter, by, features).checkpoint(eager=True)
    cutoff = feats.select(F.max("hour_start")).scalar() - F.make_interval(days=F.lit(test_days))
    train = feats.filter(F.col("hour_start") <= cutoff)
    test = feats.filter(F.col("hour_start") > cutoff)

    if daily:
        parts = regression.moments(train.withColumn("day", F.to_date("hour_start")), features, "load", [*by, "day"])
        fit = regression.merge(parts, len(features), by)
    else:
        fit = regression.moments(train, features, "load", by)
    scored = regression.predict(test, regression.solve(fit, len(features), by), features, by)

    def score(rows: DataFrame, model: str, value: str) -> DataFrame:
        return rows.groupBy(*_keys(by)).agg(
            F.lit(model).alias("model"),
            F.avg(F.abs(F.col(value) - F.col("load"))).alias("mae"),
            F.count(F.lit(1)).alias("test_hours"),
        )

    slot = [*by, F.dayofweek("hour_start").alias("weekday"), F.hour("hour_start").alias("hour_of_day")]
    profile = train.groupBy(*slot).agg(F.avg("load").alias("profile"))
    profile = bounded_broadcast(profile, profile_bound(by, HOURS_PER_WEEK))
    test_slots = test.select(*by, "hour_start", "load", *slot[len(by):])
    seasonal = test_slots.join(profile, on=[*by, "weekday", "hour_of_day"], how="left")
    return score(scored, "linear_regression", "prediction").unionByName(score(seasonal, "seasonal_profile", "profile"))

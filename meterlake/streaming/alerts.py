"""Alerts on a stream against a baseline that the stream keeps.

The baseline is the count, the mean and the second central moment of hourly
loads by hour of day, kept as partials that merge exactly. A batch is reduced
to its hourly loads, these are judged by the baseline of the batches before,
and only then its partials join the baseline. Alerts land first: a batch that
fails between the two is judged again by the same baseline, and its alerts,
which have landed, are left out the second time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from meterlake.operators.insights import hourly_load
from meterlake.schema import METER, Meter
from meterlake.sinks.snapshots import SnapshotTable
from meterlake.streaming.ingest import with_trigger

STREAM = "alerts"
BATCH = "batch"


def batch_loads(batch: DataFrame, meter: Meter = METER, by: Sequence[str] = ()) -> DataFrame:
    """Mean active power of each clock hour in the batch; rows without a time
    or power have no load."""
    return hourly_load(batch, meter, by).where("hour_start IS NOT NULL AND load IS NOT NULL").withColumn("hour", F.hour("hour_start"))


def moments(loads: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Count, mean and second central moment of the loads by hour of day."""
    return loads.groupBy(*by, "hour").agg(
        F.count("load").alias("n"), F.avg("load").alias("mean"), (F.var_pop("load") * F.count("load")).alias("m2")
    )


def merge_moments(partials: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row a key: M2 = sum(M2_i) + sum(n_i (mean_i - mean)^2). The window
    holds a row for each batch since the last fold, of one key."""
    group = Window.partitionBy(*by, "hour")
    mean = F.sum(F.col("n") * F.col("mean")).over(group) / F.sum("n").over(group)
    return (
        partials.withColumn("_mean", mean)
        .groupBy(*by, "hour")
        .agg(
            F.sum("n").alias("n"),
            F.max("_mean").alias("mean"),
            F.sum(F.col("m2") + F.col("n") * (F.col("mean") - F.col("_mean")) ** 2).alias("m2"),
        )
    )


def judge(loads: DataFrame, baseline: DataFrame, k: float = 2.0, by: Sequence[str] = ()) -> DataFrame:
    """Loads above mean + ``k`` sample standard deviations of the baseline
    at their hour of day. Hours with fewer than two loads raise no alert."""
    std = F.sqrt(F.col("m2") / (F.col("n") - 1))
    base = baseline.where("n >= 2").select(*[F.col(b).alias(f"_{b}") for b in by], F.col("hour").alias("_hour"), F.col("n").alias("baseline_n"), F.col("mean").alias("baseline_mean"), std.alias("baseline_std"))
    match = F.col("hour") == F.col("_hour")
    for b in by:
        match = match & F.col(b).eqNullSafe(F.col(f"_{b}"))
    threshold = F.col("baseline_mean") + F.lit(k) * F.col("baseline_std")
    return loads.join(base, match).where(F.col("load") > threshold).select(
        *by, "hour_start", "hour", "load", "baseline_n", "baseline_mean", "baseline_std", threshold.alias("threshold")
    )


class AlertTables:
    """Alerts and baseline below ``root``, for frames with the schema ``rows``."""

    def __init__(self, spark: SparkSession, root: str, rows: T.StructType, meter: Meter = METER, by: Sequence[str] = ()):
        self.by, self.meter = tuple(by), meter
        loads = batch_loads(spark.createDataFrame([], rows), meter, by)
        partials = moments(loads, by)
        found = judge(loads, partials, by=by).withColumn(BATCH, F.lit(0).cast("long"))
        self.alerts = SnapshotTable(spark, f"{root}/alerts", found.schema, partition_by=())
        self.baseline = SnapshotTable(spark, f"{root}/baseline", partials.schema, partition_by=())

    def judge_batch(self, batch: DataFrame, batch_id: int, k: float = 2.0, fold_at: int = 24) -> None:
        """Land the alerts of a batch, then its part of the baseline; fold the
        baseline when it has ``fold_at`` directories (2 at least)."""
        loads = batch_loads(batch, self.meter, self.by)
        if batch_id > self.baseline.record().landed.get(STREAM, -1):
            before = merge_moments(self.baseline.read(), self.by)
            found = judge(loads, before, k, self.by).withColumn(BATCH, F.lit(batch_id).cast("long"))
            self.alerts.land(found, batch_id, STREAM)
            self.baseline.land(moments(loads, self.by), batch_id, STREAM)
        if len(self.baseline.record().live) >= max(fold_at, 2):
            self.baseline.fold(lambda partials: merge_moments(partials, self.by))


def start_alerts(
    tables: AlertTables, rows: DataFrame, checkpoint: str, k: float = 2.0, trigger: dict | None = None, fold_at: int = 24
) -> StreamingQuery:
    """Judge every batch of the stream of cleaned readings."""

    def each(batch: DataFrame, batch_id: int) -> None:
        tables.judge_batch(batch, batch_id, k, fold_at)

    writer = rows.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return with_trigger(writer, trigger).start()

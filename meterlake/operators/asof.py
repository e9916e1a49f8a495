"""As-of join of two irregular series (X5): each row of one with the last
value of the other at or before its time, if that is no older than a
tolerance.

Time is cut into blocks at least as long as the tolerance, so a match lies in
the row's own block or in the one before, and of the latter only its last
value can be it. That one is carried over: every block's last value also
enters the next block. So blocks are independent of each other, and a key
with a third of all rows is spread over as many tasks as it has blocks.

Only distinct times meet in a block (both sides are reduced by a partial
aggregation first); a time that very many rows share is one row there, and
the rows get its match by an equi-join on (key, time), which adaptive
execution can split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _micros(c: str) -> Column:
    return F.unix_micros(F.col(c).cast("timestamp"))


def asof_join(
    left: DataFrame,
    right: DataFrame,
    values: Sequence[str],
    tolerance_seconds: int,
    time: str = "datetime",
    right_time: str = "datetime",
    by: Sequence[str] = (),
    block_seconds: int = 3600,
) -> DataFrame:
    """``left`` with ``values`` of the last row of ``right`` (of the same
    ``by``) at or before its time, at most ``tolerance_seconds`` older, and
    ``age_seconds``; NULL where there is none. Every left row stays, also one
    without a time. Right rows without a time are ignored; of several at one
    time the one with the greatest values (in their order) counts; NULL keys
    match each other."""
    width = max(tolerance_seconds, block_seconds, 1) * 1_000_000
    keys = [f"_key_{i}" for i in range(len(by))]
    named = lambda: [F.col(b).alias(k) for b, k in zip(by, keys)]
    block = F.floor(F.col("_t") / F.lit(width)).cast("bigint")

    asked = left.where(F.col(time).isNotNull()).select(*named(), _micros(time).alias("_t")).distinct()
    known = right.where(F.col(right_time).isNotNull()).select(*named(), _micros(right_time).alias("_t"), F.struct(*values).alias("_v"))
    known = known.groupBy(*keys, "_t").agg(F.max("_v").alias("_v")).select(*keys, block.alias("_block"), F.struct("_t", "_v").alias("_m"))
    carried = known.groupBy(*keys, "_block").agg(F.max("_m").alias("_m")).withColumn("_block", F.col("_block") + 1)

    given = known.unionByName(carried).select(*keys, "_block", F.col("_m._t").alias("_t"), F.lit(0).alias("_side"), "_m")
    none = F.lit(None).cast(given.schema["_m"].dataType)
    rows = asked.select(*keys, block.alias("_block"), "_t", F.lit(1).alias("_side"), none.alias("_m")).union(given)
    so_far = Window.partitionBy(*keys, "_block").orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, 0)
    found = rows.withColumn("_m", F.last("_m", ignorenulls=True).over(so_far)).where("_side = 1")
    found = found.where(F.col("_t") - F.col("_m._t") <= tolerance_seconds * 1_000_000)

    match = found.select(*keys, F.col("_t").alias("_at"), "_m")
    same = [F.col(b).eqNullSafe(F.col(k)) for b, k in zip(by, keys)] + [F.col("_own") == F.col("_at")]
    joined = left.withColumn("_own", _micros(time)).join(match, same, "left")
    kept = [c for c in left.columns if c not in (*values, "age_seconds")]
    age = ((F.col("_own") - F.col("_m._t")) / F.lit(1e6)).alias("age_seconds")
    return joined.select(*kept, *[F.col(f"_m._v.{v}").alias(v) for v in values], age)

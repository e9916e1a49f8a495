"""Connected components by alternating large-star and small-star steps.

Each step keeps the components and moves every node nearer to the smallest
node of its component; the edges end as stars around those. Steps are joins
and aggregations of edges, and each result is checkpointed to the folder the
cluster shares, so lineage stays short and a lost executor costs no more
than one step. Shuffle files and checkpoints of earlier steps are let go
after each, so the disk holds about one step.
"""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.session import checkpoint_root


def release(spark: SparkSession) -> None:
    """Let Spark delete shuffle files (and, where it is set to, checkpoints)
    of frames that are no longer held. It does so when the driver's JVM
    collects garbage, which a driver with little to do seldom does."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _ends(edges: DataFrame, *two: Column) -> DataFrame:
    """Two rows of each edge, of which the edges are read once."""
    return edges.select(F.inline(F.array(*two)))


def _large_star(edges: DataFrame) -> DataFrame:
    both = _ends(edges, F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")


def _small_star(down: DataFrame) -> DataFrame:
    """``down``: edges from the larger to the smaller node."""
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).where("u != v").distinct()


def _stars(edges: DataFrame) -> bool:
    """Whether every node has one edge at most or only edges from larger nodes."""
    row = lambda x, up: F.struct(F.col(x).alias("x"), F.lit(up).alias("up"), F.lit(1 - up).alias("down"))
    ends = _ends(edges, row("u", 1), row("v", 0))
    sides = ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not sides.where("up > 1 OR (up = 1 AND down = 1)").take(1)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``root`` (the smallest node of its component), for every
    node that has an edge to another one; roots themselves are left out.
    Edges with a null end are ignored; no edges give no rows."""
    spark = edges.sparkSession
    checkpoint_root(spark)
    now = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col(a) != F.col(b)).distinct().checkpoint()
    while not _stars(now):
        now = _small_star(_large_star(now)).checkpoint()
        release(spark)
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))

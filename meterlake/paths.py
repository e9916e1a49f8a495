"""Paths as Hadoop sees them, so that two spellings of one place compare equal."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with its file system's scheme and authority, without a
    trailing slash (``/p``, ``file:/p`` and ``file:///p`` are one place)."""
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(sc._jsc.hadoopConfiguration()).makeQualified(p).toString().rstrip("/")


def total_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below ``path`` (one metadata call)."""
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(sc._jsc.hadoopConfiguration()).getContentSummary(p).getLength()


def version(spark: SparkSession, path: str) -> tuple[str, int, int]:
    """Place, newest modification and size of a file or directory, from the
    file system that holds it."""
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    status = p.getFileSystem(sc._jsc.hadoopConfiguration()).getFileStatus(p)
    return qualified(spark, path), status.getModificationTime(), total_bytes(spark, path)


def root_paths(df: DataFrame) -> list[str]:
    """The directories or files that the frame's file sources were given,
    from its analysed plan; files below them are not listed."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    out = []
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName() != "LogicalRelation":
            continue
        relation = leaf.relation()
        if relation.getClass().getSimpleName() == "HadoopFsRelation":
            roots = relation.location().rootPaths()
            out += [roots.apply(j).toString() for j in range(roots.size())]
    return out

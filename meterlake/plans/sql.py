"""SQL text in, DataFrame out.

Replaces the one-JVM-per-query bridge of the original with a call on a live
session. Failures raise (they are never turned into an empty result), and
results stay distributed; serialise them with ``sinks.messages.result_json``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def register_views(views: Mapping[str, DataFrame]) -> None:
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def run_sql(spark: SparkSession, text: str, views: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Run ``text`` over the catalog plus the given temporary views."""
    if views:
        register_views(views)
    return spark.sql(text)


def parquet_source(path: str) -> str:
    """``FROM parquet.`path``` form for SQL over files without a table."""
    return "parquet.`" + path.replace("`", "``") + "`"

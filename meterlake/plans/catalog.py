"""Catalog table over stored readings.

Works with Spark's built-in catalog (no Hive service needed) and with a Hive
metastore when the session has one. For a streaming file sink the table must
be created *before* the stream starts: it then reads through the sink's
``_spark_metadata`` log and sees new rows without a repair (G18).

Names and locations are quoted, and only external tables are ever dropped
here, so no call deletes data files.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from meterlake.paths import qualified
from meterlake.schema import PARTITION_COLUMNS, STORED


def quoted(name: str) -> str:
    """A table name, with its database if it has one, in backticks."""
    return ".".join("`" + part.strip("`").replace("`", "``") + "`" for part in name.split("."))


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _ddl_columns(schema: T.StructType) -> str:
    return ", ".join(f"{quoted(f.name)} {f.dataType.simpleString().upper()}" for f in schema.fields)


def create_table(
    spark: SparkSession,
    name: str,
    location: str,
    schema: T.StructType = STORED,
    partition_by: Sequence[str] = PARTITION_COLUMNS,
) -> None:
    """External partitioned Parquet table at ``location``. A table of the
    name at the same location is left as it is; one elsewhere is an error, and
    so is one that lacks columns of ``schema`` (they would stay unseen)."""
    known = table_location(spark, name)
    if known is not None:
        if known != qualified(spark, location):
            raise ValueError(f"table {name} is at {known}, not at {location}")
        lacking = set(schema.names) - set(read_table(spark, name).columns)
        if lacking:
            raise ValueError(f"table {name} has no columns {sorted(lacking)}")
        return
    parts = f" PARTITIONED BY ({', '.join(map(quoted, partition_by))})" if partition_by else ""
    spark.sql(f"CREATE TABLE {quoted(name)} ({_ddl_columns(schema)}) USING parquet{parts} LOCATION {_text(location)}")


def table_exists(spark: SparkSession, name: str) -> bool:
    """D2 (a)."""
    return spark.catalog.tableExists(quoted(name))


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    """D2 (b): partition columns as the catalog reports them (empty when the
    table is unpartitioned)."""
    return [c.name for c in spark.catalog.listColumns(quoted(name)) if c.isPartition]


def ensure_table(
    spark: SparkSession,
    name: str,
    location: str,
    schema: T.StructType = STORED,
    partition_by: Sequence[str] = PARTITION_COLUMNS,
) -> bool:
    """Create the table, or drop and recreate it when it exists with
    other partition columns or another location, then register the
    partitions already on disk. Returns True when the table was (re)created.
    A managed table of that name is never touched: that raises.
    """
    created = False
    if table_exists(spark, name):
        same = partition_columns(spark, name) == list(partition_by) and table_location(spark, name) == qualified(spark, location)
        if not same:
            drop_table(spark, name)
    if not table_exists(spark, name):
        create_table(spark, name, location, schema, partition_by)
        created = True
    if partition_by:
        repair(spark, name)
    return created


def drop_table(spark: SparkSession, name: str) -> None:
    """D3: drop the entry of an external table; its files remain. Dropping a
    managed table would delete its data, so that raises."""
    if not table_exists(spark, name):
        return
    kind = _described(spark, name, "Type")
    if kind != "EXTERNAL":
        raise ValueError(f"table {name} is {kind}, not EXTERNAL: dropping it would delete its data")
    spark.sql(f"DROP TABLE {quoted(name)}")


def repair(spark: SparkSession, name: str) -> None:
    """Register partition directories found on disk."""
    spark.catalog.recoverPartitions(quoted(name))


def add_partitions(spark: SparkSession, name: str, values: Iterable[dict[str, object]], at_once: int = 1000) -> int:
    """Register the given partitions (``ADD IF NOT EXISTS``, so a
    replayed batch is harmless), ``at_once`` in a statement. Returns how many
    specs were sent."""
    specs = ["PARTITION (" + ", ".join(f"{quoted(k)}={_literal(x)}" for k, x in v.items()) + ")" for v in values]
    for i in range(0, len(specs), at_once):
        spark.sql(f"ALTER TABLE {quoted(name)} ADD IF NOT EXISTS {' '.join(specs[i:i + at_once])}")
    return len(specs)


def _literal(x: object) -> str:
    if x is None:
        raise ValueError("a partition value is missing")
    return str(int(x)) if isinstance(x, (int, bool)) else _text(str(x))


def partitions(spark: SparkSession, name: str) -> DataFrame:
    """The catalog's list of a table's partitions, one ``a=1/b=2`` a row."""
    return spark.sql(f"SHOW PARTITIONS {quoted(name)}")


def list_tables(spark: SparkSession, database: str | None = None) -> list[str]:
    """D6."""
    return [t.name for t in spark.catalog.listTables(database)]


def _described(spark: SparkSession, name: str, item: str) -> str | None:
    """One line of the catalog's description of a table."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(name)}").filter(f"col_name = '{item}'").collect()
    return rows[-1].data_type if rows else None


def table_location(spark: SparkSession, name: str) -> str | None:
    """Location of an existing table from catalog metadata (no listing);
    None when the table does not exist."""
    if not table_exists(spark, name):
        return None
    found = _described(spark, name, "Location")
    return qualified(spark, found) if found else None


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """The catalog table as a DataFrame (partition filters prune)."""
    return spark.table(quoted(name))

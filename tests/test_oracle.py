"""Every registered query against its DuckDB SQL (the driver's gate), on
the small tables; ``tools/oracle_check.py`` runs the same on sf0.01."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from meterlake.plans.queries import REGISTRY
from tools.oracle_check import SPARK_TO_DUCK, duck_connection, rows_key

from data_dirs import SF_SMALL

SQL = {name: sql for name, sql in entry.oracle_sql().items() if name in REGISTRY}


@pytest.fixture(scope="module")
def duck():
    return duck_connection(SF_SMALL)


def test_every_query_has_oracle_or_is_listed():
    no_sql = set(REGISTRY) - set(SQL)
    assert not no_sql, no_sql


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["hour", "avg_active_power", "avg_voltage", "record_count"]


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(SQL[name])
    drows = cur.fetchall()
    dnames = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dnames)
    dtypes = dict(zip(dnames, [str(t) for t in duck.sql(SQL[name]).types]))
    for f in df.schema.fields:
        spark_type = type(f.dataType).__name__
        assert SPARK_TO_DUCK.get(spark_type, spark_type) == dtypes[f.name], f.name
    assert len(srows) == len(drows)
    assert rows_key(df.columns, srows) == rows_key(dnames, drows)


def test_query_order_does_not_matter_for_the_catalog_table(spark):
    """The pass-through view must not shadow the stored catalog table."""
    queries = entry.queries()
    first = queries["sql_passthrough"](spark, SF_SMALL).collect()
    queries["catalog_count"](spark, SF_SMALL).collect()
    kinds = [t.tableType for t in spark.catalog.listTables() if t.name.startswith("energy_data")]
    assert kinds == ["EXTERNAL"]
    assert queries["sql_over_files"](spark, SF_SMALL).collect() == first

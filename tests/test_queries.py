"""Every registered query against its SQL on the smallest supplied tables."""
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry_module
from mercaflow.workload.oracle import oracle
from mercaflow.workload.registry import queries as registered

SF_DIR = "/root/testdata/sf0.001"
TABLES = sorted(name.removesuffix(".parquet") for name in os.listdir(SF_DIR)) if os.path.isdir(SF_DIR) else []
QUERIES, ORACLE = registered(), oracle()
TYPES = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "date": "DATE",
    "boolean": "BOOLEAN",
}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="supplied tables not present")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def test_every_oracle_has_its_query():
    assert set(ORACLE) <= set(QUERIES)
    assert set(registered()) == set(oracle())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, database, name):
    df = QUERIES[name](spark, SF_DIR)
    expected = database.sql(ORACLE[name])
    columns = sorted(df.columns)
    assert columns == sorted(expected.columns)
    types = dict(zip(expected.columns, map(str, expected.types)))
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    rows = expected.select(*[f'"{c}"' for c in columns]).fetchall()
    assert len(rows) > 0
    assert Counter(tuple(r) for r in df.select(*columns).collect()) == Counter(rows)


def test_entry_returns_the_fact(spark):
    df = entry_module.entry(spark)
    assert "channel_mix" in df.columns and df.count() == 5783

"""Every registered query with SQL against DuckDB on the smallest tables, values included."""

import os

import duckdb
import pytest

import __spark_entry__ as driver
from kerbline.checks import registry

FOLDER = os.environ.get("KERBLINE_TABLES", "/root/testdata/sf0.001")
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def in_order(rows, names, wanted):
    at = [names.index(n) for n in wanted]
    picked = [tuple(r[i] for i in at) for r in rows]
    return sorted(picked, key=lambda r: [(v is None, str(v)) for v in r])


def test_keys_agree():
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_entry(spark):
    assert driver.entry(spark).count() == 24


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = driver.queries()[name](spark, FOLDER)
    found = duck.sql(driver.oracle_sql()[name])
    columns = sorted(df.columns)
    assert columns == sorted(found.columns)
    types = {f.name: TYPES[f.dataType.simpleString()] for f in df.schema.fields}
    assert types == dict(zip(found.columns, map(str, found.types), strict=True))
    ours = in_order([tuple(r) for r in df.collect()], df.columns, columns)
    theirs = in_order(found.fetchall(), found.columns, columns)
    assert ours == theirs

"""Every registered query against its SQL equivalent, row for row and type for type."""

import math
import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from threatlens.plans import catalog, oracles

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = catalog.queries()
ORACLES = oracles.oracle_sql()
SQL_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in Path(SF_DIR).glob("*.parquet"):
        connection.sql(f"CREATE VIEW {table.stem} AS SELECT * FROM '{table}'")
    return connection


def canonical(rows):
    def cell(v):
        return round(v, 9) if isinstance(v, float) and not math.isnan(v) else v

    return sorted((tuple(map(cell, r)) for r in rows), key=lambda r: [(v is None, str(v)) for v in r])


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    expected = duck.sql(ORACLES[name])
    types = {f.name: SQL_TYPES[f.dataType.simpleString()] for f in result.schema}
    assert types == dict(zip(expected.columns, map(str, expected.types)))
    columns = sorted(types)
    picked = ", ".join(f'"{c}"' for c in columns)
    rows = canonical(result.select(*columns).collect())
    assert rows == canonical(expected.query("q", f"SELECT {picked} FROM q").fetchall())
    assert rows


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry_is_the_profile(spark):
    profile = contract.entry(spark)
    assert profile.columns == ["ip", "batch_layer", "speed_layer", "recommendation", "confidence"]
    assert profile.count() > 0

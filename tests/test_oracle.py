"""Every registered query against its SQL on an independent engine."""

import os

import pytest
from compare import duck, duck_rows, duck_types, spark_rows

import __spark_entry__ as entry_module
from feedloom.plans.queries import all_queries

TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
}
SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(all_queries()) <= set(entry_module.oracle_sql())
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(entry_module.oracle_sql()))
def test_query_equals_oracle(spark, connection, name):
    frame = entry_module.queries()[name](spark, SF_DIR)
    types = {column: TYPES[kind] for column, kind in frame.dtypes}
    assert types == duck_types(connection, entry_module.oracle_sql()[name])
    names, rows = spark_rows(frame)
    oracle_names, oracle_rows = duck_rows(connection, entry_module.oracle_sql()[name])
    assert names == oracle_names
    assert rows and sum(rows.values()) == sum(oracle_rows.values())
    assert rows == oracle_rows


def test_entry_runs(spark):
    frame = entry_module.entry(spark)
    assert frame.columns == ["key", "pos", "raw"]
    assert frame.count() > 0

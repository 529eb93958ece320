"""Every registered query against its SQL in DuckDB, over whole tables."""

import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from clickweave.plans.registry import ORACLE_SQL, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
SQL = ORACLE_SQL


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def as_rows(frame, columns):
    return sorted((tuple(map(repr, row)) for row in frame), key=str)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, oracle, name):
    frame = QUERIES[name](spark, SF_DIR)
    relation = oracle.sql(SQL[name])
    columns = sorted(frame.columns)
    assert columns == sorted(relation.columns)
    quoted = ", ".join(f'"{c}"' for c in columns)
    found = as_rows([tuple(r) for r in frame.select(*columns).collect()], columns)
    expected = as_rows(oracle.sql(f"SELECT {quoted} FROM ({SQL[name]}) t").fetchall(), columns)
    assert len(expected) > 0
    assert len(found) == len(expected)
    assert found == expected


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert QUERIES.items() <= contract.queries().items()
    assert SQL.items() <= contract.oracle_sql().items()


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.columns[:2] == ["uuid", "session_id"]
    assert frame.count() > 0

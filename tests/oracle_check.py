"""Runs a registered query and its SQL side by side."""

from __future__ import annotations

import duckdb

import __spark_entry__ as entry
from mercato.plans.registry import load_all

TABLES = "region nation customer supplier part orders lineitem events".split()
# The warehouse queries; optional parts of the registry have tests of their own.
QUERIES = {name: query for name, query in entry.queries().items() if name in load_all()}
ORACLES = {name: sql for name, sql in entry.oracle_sql().items() if name in load_all()}
# Spark type to DuckDB type.
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


def connect(directory: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{directory}/{table}.parquet'")
    return connection


def assert_same(spark, database: duckdb.DuckDBPyConnection, name: str, directory: str) -> None:
    """Same columns, types and rows; the order of rows is not compared."""
    frame = QUERIES[name](spark, directory)
    columns = sorted(frame.columns)
    got = sorted(tuple(str(r[c]) for c in columns) for r in frame.collect())
    relation = database.execute(ORACLES[name])
    names = [c[0] for c in relation.description]
    types = {c[0]: str(c[1]) for c in relation.description}
    assert sorted(names) == columns
    assert {c: TYPES[frame.schema[c].dataType.simpleString()] for c in columns} == types
    at = [names.index(c) for c in columns]
    assert got == sorted(tuple(str(r[i]) for i in at) for r in relation.fetchall())

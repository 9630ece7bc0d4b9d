"""A query of this package and its SQL side by side."""

from __future__ import annotations

import duckdb

from mercato.llm.queries import ORACLE

DATA = "/root/testdata/sf0.001"
TYPES = {"bigint": "BIGINT", "string": "VARCHAR", "boolean": "BOOLEAN"}


def assert_equals_sql(spark, name, query, directory=DATA):
    database = duckdb.connect()
    for table in ("documents", "labels", "pages"):
        database.execute(f"create view {table} as select * from '{directory}/{table}.parquet'")
    frame = query(spark, directory)
    names = sorted(frame.columns)
    relation = database.sql(ORACLE[name])
    assert sorted(relation.columns) == names
    assert dict(zip(relation.columns, map(str, relation.types))) == {c: TYPES[frame.schema[c].dataType.simpleString()] for c in names}
    want = sorted(str(r) for r in relation.select(*names).fetchall())
    got = sorted(str(tuple(r)) for r in frame.select(*names).collect())
    assert got == want and got

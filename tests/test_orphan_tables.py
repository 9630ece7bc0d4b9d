"""Queries on tables with incomplete keys.

A seventh of the lines name unknown products, some lines and payments unknown orders, some
orders unknown customers, and some orders have no purchase time.
"""

from __future__ import annotations

import duckdb
import pytest

from mercato.plans.warehouse import open_warehouse
from tests.conftest import DATA
from tests.oracle_check import QUERIES, TABLES, assert_same, connect

CHANGES = {
    "orders": """* REPLACE (
        CASE WHEN o_orderkey % 11 = 0 THEN o_custkey + 9000000 ELSE o_custkey END AS o_custkey,
        CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderdate END AS o_orderdate)""",
    "lineitem": """* REPLACE (
        CASE WHEN l_orderkey % 17 = 0 THEN l_orderkey + 90000000 ELSE l_orderkey END AS l_orderkey,
        CASE WHEN l_partkey % 7 = 0 THEN l_partkey + 9000000 ELSE l_partkey END AS l_partkey)""",
}
# Profiles and forecasts place an order without a purchase time differently from their SQL.
NAMES = sorted(n for n in QUERIES if n.split("_")[0] in ("vw", "mart", "api", "ui", "fact", "int") or n[0] == "q")


@pytest.fixture(scope="module")
def orphans(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("orphans"))
    connection = duckdb.connect()
    for table in TABLES:
        columns = CHANGES.get(table, "*")
        connection.execute(f"COPY (SELECT {columns} FROM '{DATA}/{table}.parquet' t) TO '{folder}/{table}.parquet'")
    return folder


@pytest.fixture(scope="module")
def database(orphans):
    return connect(orphans)


def test_the_tables_have_orphans(spark, orphans):
    wh = open_warehouse(spark, orphans)
    assert wh.lines.where("known_product is null").count() and wh.lines.where("known_order is null").count()
    assert wh.sales.where("order_month is null").count() and wh.sales.where("customer_unique_id is null").count()


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, orphans, database, name):
    assert_same(spark, database, name, orphans)

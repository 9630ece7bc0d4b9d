"""Queries on tables in which one key of every kind holds a third of the rows.

One customer has a third of the orders; one order, one product and one seller each have a
third of the lines; a ninth of all lines are copies of one key; a third of the products have
no category.
"""

from __future__ import annotations

import duckdb
import pytest

from mercato.plans.warehouse import open_warehouse
from tests.conftest import DATA
from tests.oracle_check import TABLES, assert_same, connect

CHANGES = {
    "orders": """* REPLACE (
        CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE o_custkey END AS o_custkey,
        CASE WHEN o_orderkey % 3 = 0 THEN '1-URGENT' ELSE o_orderpriority END AS o_orderpriority)""",
    "lineitem": """* EXCLUDE (rn) REPLACE (
        CASE WHEN rn % 3 = 0 THEN 5 ELSE l_orderkey END AS l_orderkey,
        CASE WHEN rn % 9 = 0 THEN 1 WHEN rn % 3 = 0 THEN CAST(rn AS INTEGER) + 10 ELSE l_linenumber END AS l_linenumber,
        CASE WHEN rn % 3 = 1 THEN 1 ELSE l_partkey END AS l_partkey,
        CASE WHEN rn % 3 = 1 THEN 1 ELSE l_suppkey END AS l_suppkey)""",
    "part": "* REPLACE (CASE WHEN p_partkey % 3 = 0 THEN 'Brand#25' ELSE p_brand END AS p_brand)",
}
NAMES = [
    "q03_status_summary",
    "q07_category_top10",
    "q16_rank_customers_all",
    "q17_top3_products_per_category",
    "q20_first_last_order_all",
    "q22_order_gap_all",
    "q26_diff_from_customer_avg_all",
    "q33_second_larger_than_first",
    "q37_basket_composition",
    "q45_top3_payment_types",
    "q49_cohort_retention_matrix",
    "q52_days_to_second",
    "q57_orders_first_90d",
    "q59_rfm_scores_all",
    "q65_cross_sell_affinity",
    "q67_abc_products_all",
    "q70_rolling_30d_distinct",
    "q77_first_review_repeat",
    "q78_seller_scorecard",
    "q79_late_first_delivery",
    "q81_freight_cell",
    "fact_orders_enriched",
    "mart_fact_orders_wide",
    "dedupe",
    "distinct_on",
    "validation_report_uncleaned",
]


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skewed"))
    connection = duckdb.connect()
    for table in TABLES:
        numbered = f"(SELECT *, row_number() OVER () AS rn FROM '{DATA}/{table}.parquet')"
        source = numbered if table == "lineitem" else f"'{DATA}/{table}.parquet'"
        columns = CHANGES.get(table, "*")
        connection.execute(f"COPY (SELECT {columns} FROM {source} t) TO '{folder}/{table}.parquet'")
    return folder


@pytest.fixture(scope="module")
def database(skewed):
    return connect(skewed)


def test_the_tables_are_skewed(spark, skewed):
    sales = open_warehouse(spark, skewed).sales
    biggest = sales.groupBy("customer_unique_id").count().orderBy("count", ascending=False).first()
    assert biggest["count"] >= sales.count() / 3


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, skewed, database, name):
    assert_same(spark, database, name, skewed)

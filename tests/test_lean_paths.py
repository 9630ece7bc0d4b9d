"""Queries that need nothing of an order's payments, items or reviews don't build the marts that hold them."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from mercato.operators import quality
from mercato.plans.registry import load_all
from mercato.plans.warehouse import Warehouse
from mercato.sources.adapter import source_tables
from tests.conftest import DATA

QUERIES = load_all()


@pytest.mark.parametrize(
    ("name", "left_out"),
    [
        ("q74_margin_proxy", {"lines", "sales", "order_payments"}),
        ("q08_freight_pct", {"lines", "sales", "order_payments"}),
        ("q65_cross_sell_affinity", {"lines", "sales", "order_payments"}),
        ("ui_top_n_by_metric", {"lines", "sales", "order_payments"}),
        ("q07_category_top10", {"lines", "sales", "order_payments"}),
        ("q61_quintile_revenue", {"sales", "buyers", "rfm"}),
        ("q85_cohort_revenue_matrix", {"sales"}),
    ],
)
def test_without_and_with_the_marts(spark, wh, name, left_out):
    lean = Warehouse(spark, source_tables(spark, DATA))
    found = QUERIES[name](lean).collect()
    assert not any(lean.has(mart) for mart in left_out)
    wh.build_marts()
    assert found and found == QUERIES[name](wh).collect()


def test_keys_of_numbers_and_of_text_are_checked_alike(spark):
    items = spark.createDataFrame([(1, 1, 7), (1, 1, None), (1, None, 8), (1, None, 9), (11, 1, 9), (None, 1, 9)], "o long, n int, p int")
    parts = spark.createDataFrame([(7,), (8,)], "p long")
    told = []
    for kind in ("bigint", "string"):
        frame = items.select(*[F.col(c).cast(kind) for c in items.columns])
        found = quality.check_all(spark, [quality.Subject("i", frame, {"o": F.col("o").isNull()}, ["o", "n"], {"p": "parts.p"})], {"parts": lambda: parts})
        told.append({r.check_name: r.violations for r in found.collect()})
    assert told[0] == told[1] == {"o": 1, "pk_unique[o,n]": 2, "fk[p->parts.p]": 3}


def test_number_keys_are_shuffled_as_numbers(wh):
    plan = QUERIES["validation_report_uncleaned"](wh)._jdf.queryExecution().executedPlan().toString()
    assert "lambda" not in plan and "cast(order_id" not in plan and "concat(" not in plan


def test_products_are_classed_without_storing_the_lines(spark, wh):
    sources = source_tables(spark, DATA)
    found = QUERIES["q67_abc_products_all"](Warehouse(spark, sources)).collect()
    assert "clean-lines" not in sources["order_items"].__self__._kept
    wh.build_marts()
    assert found and found == QUERIES["q67_abc_products_all"](wh).collect()


def test_prices_of_narrow_lines_are_those_of_the_cleaned_ones(spark, tmp_path):
    """Several lines of one key, keys and leading columns that are null, and an order with most of the lines."""
    def line(order, number, *rest):
        part, supplier, day, price = rest
        return (order, number, part, supplier, day, price, 1.0, 0.0, 0.1, "N", "O")

    rows = [
        line(1, 1, 7, 3, None, 5.0), line(1, 1, 7, 3, "2020-01-02", 4.0), line(1, 1, 7, None, "2020-01-01", 3.0), line(1, 1, 8, 1, None, 1.0),
        line(1, 2, None, 1, None, 2.0), line(1, 2, 9, 4, None, None), line(2, 1, None, None, None, None), line(2, 1, None, None, None, 6.0),
        line(None, 1, 5, 1, None, 1.5), line(None, 1, 5, 1, None, 0.5), line(3, None, 6, 1, None, 8.25), line(3, None, 6, 1, None, 8.25),
        *[line(4, n % 1500, n % 11, n % 7, None, float(n)) for n in range(3000)],
    ]
    names = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_shipdate string, l_extendedprice double, l_quantity double, l_discount double, l_tax double, l_returnflag string, l_linestatus string"
    lines = spark.createDataFrame(rows, names).withColumn("l_shipdate", F.col("l_shipdate").cast("timestamp_ntz"))
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    sources = source_tables(spark, str(tmp_path))
    key = lambda r: tuple((v is None, v or 0) for v in r)
    narrow = sorted(sources["item_prices"]().collect(), key=key)
    cleaned = sorted(sources["order_items"]().select("product_id", "price").collect(), key=key)
    assert len(narrow) == 1505 and narrow == cleaned
    assert sorted(sources["item_prices"]().collect(), key=key) == cleaned  # now from the cleaned lines

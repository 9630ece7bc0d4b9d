"""Star schema and reports on the tiny data set: known numbers."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from mercato.plans import basics, insights, marts, reports, segments, windows
from tests.conftest import rows


def test_facts(tiny):
    assert tiny.fact_orders.count() == 3
    total = tiny.fact_order_items.agg(F.sum("total_item_value").cast("double")).first()[0]
    assert total == 495.0
    o1 = tiny.fact_orders.filter("order_id = 'o1'").first()
    assert (o1.purchase_date_key, o1.delivery_days, o1.delivery_vs_estimate_days) == (20180105, 5, 2)
    assert tiny.fact_reviews.filter("review_id = 'r1'").first().answer_latency_days == 1


def test_date_spine(tiny):
    spine = tiny.dim_dates
    assert tuple(spine.agg(F.min("date"), F.max("date"), F.count("*")).first()) == (
        date(2018, 1, 5),
        date(2018, 2, 11),
        38,
    )
    sunday = spine.filter("date = '2018-01-07'").first()
    assert (sunday.day_of_week, sunday.day_name, sunday.is_weekend, sunday.week_of_year) == (
        0,
        "Sunday",
        True,
        1,
    )


def test_categories_are_translated(tiny):
    assert rows(tiny.dim_products, "product_category_english") == [("electronics",), ("furniture",)]


def test_kpis(tiny):
    kpis = reports.api_kpis(tiny).first()
    assert (kpis.total_orders, kpis.total_revenue, kpis.unique_customers) == (3, 495.0, 3)
    assert kpis.avg_review_score == 4.0 and kpis.avg_order_value == 165.0
    assert kpis.on_time_delivery_rate == 0.6667
    assert basics.on_time_rate(tiny).first().on_time_pct == 100.0


def test_monthly_revenue_is_delivered_only(tiny):
    assert rows(reports.api_monthly_revenue(tiny), "period", "revenue") == [
        ("2018-01", 165.0),
        ("2018-02", 110.0),
    ]
    assert rows(reports.ui_monthly_revenue(tiny), "period", "revenue")[1] == ("2018-02", 330.0)


def test_customer_search_and_lookup(tiny):
    assert rows(reports.search_customers(tiny, state="mg"), "customer_id") == [("c3",)]
    assert rows(reports.search_customers(tiny, city="SAO PAULO"), "customer_id") == [("c1",)]
    assert rows(reports.customer_by_id(tiny, "c1"), "total_spent") == [(165.0,)]
    assert reports.customer_by_id(tiny, "nope").count() == 0
    assert reports.search_customers(tiny, limit=1, offset=1).first().customer_id == "c1"
    assert rows(reports.ui_customer_search(tiny, "All", 150.0), "customer_id") == [("c1",), ("c3",)]


def test_orders_by_status(tiny):
    assert rows(reports.order_list(tiny, status="shipped"), "order_id") == [("o3",)]
    assert rows(reports.status_breakdown(tiny)) == [("delivered", 2), ("shipped", 1)]
    assert reports.order_by_id(tiny, "ghost").count() == 0


def test_categories_and_dashboard(tiny):
    assert rows(reports.categories(tiny), "category", "revenue") == [
        ("electronics", 250.0),
        ("furniture", 200.0),
    ]
    frames = reports.dashboard(tiny)
    assert set(frames) == {"kpis", "monthly_orders", "top_categories"}
    assert frames["kpis"].first().total_revenue == 495.0


def test_region_rollup_uses_the_built_in_lookup(tiny):
    assert rows(marts.region_rollup(tiny)) == [("Southeast", 3, 495.0)]


def test_wide_fact(tiny):
    wide = {r.order_id: r for r in marts.orders_enriched(tiny).collect()}
    assert wide["o1"].primary_category == "moveis" and wide["o1"].item_count == 2
    assert (wide["o3"].purchase_year, wide["o3"].purchase_month) == (2018, 2)


def test_segments_and_late_deliveries(tiny):
    assert segments.segment_sizes(tiny).agg(F.sum("customers")).first()[0] == 3
    assert rows(insights.late_first_delivery(tiny), "first_delivery_status", "customers") == [
        ("on_time", 2)
    ]


def test_pages_agree_with_whole_results(tiny):
    assert rows(windows.order_gap(tiny, limit=2)) == rows(windows.order_gap(tiny))[:2]


def test_replaced_files_are_seen_after_a_refresh(spark, tmp_path):
    import os
    import shutil

    from mercato.plans.basics import average_order_value
    from mercato.plans.warehouse import open_warehouse
    from tests.conftest import DATA

    folder = tmp_path / "data"
    folder.mkdir()
    for name in os.listdir(DATA):  # contents only: the given folder and files cannot be written to
        shutil.copyfile(os.path.join(DATA, name), folder / name)
    before = average_order_value(open_warehouse(spark, str(folder))).first().aov
    lines = spark.read.parquet(f"{DATA}/lineitem.parquet").where("l_orderkey % 2 = 0")
    lines.write.parquet(str(tmp_path / "half"))
    (folder / "lineitem.parquet").unlink()
    shutil.copytree(tmp_path / "half", folder / "lineitem.parquet")
    assert average_order_value(open_warehouse(spark, str(folder))).first().aov == before
    assert average_order_value(open_warehouse(spark, str(folder), refresh=True)).first().aov != before


def test_marts_are_built_once_side_by_side(spark, monkeypatch):
    """Seven threads ask for marts that are made of each other; each table is written once."""
    from collections import Counter

    from mercato.plans import warehouse
    from mercato.sources import adapter
    from tests.conftest import DATA

    written, write = Counter(), warehouse.materialise

    def counted(frame, name, *more):
        written[name] += 1
        return write(frame, name, *more)

    monkeypatch.setattr(warehouse, "materialise", counted)
    monkeypatch.setattr(adapter, "materialise", counted)
    wh = warehouse.Warehouse(spark, adapter.source_tables(spark, DATA))
    wh.build_marts()
    assert set(warehouse.MARTS) | {"clean-lines", "customers", "dim_products"} <= set(written)
    assert set(written.values()) == {1}
    one_by_one = warehouse.Warehouse(spark, adapter.source_tables(spark, DATA))
    for name in warehouse.MARTS:
        assert rows(getattr(wh, name)) == rows(getattr(one_by_one, name).select(getattr(wh, name).columns))

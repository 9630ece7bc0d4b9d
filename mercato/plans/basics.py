"""Q1-Q12: headline aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from mercato.functions.columns import (
    label_or_unknown,
    mean,
    money,
    percent,
    ratio,
    rounded,
    share_where,
)
from mercato.operators.skew import gathered
from mercato.operators.topn import share_of_total, top
from mercato.plans.registry import query
from mercato.plans.warehouse import Warehouse, orders_in_category


def paid(wh: Warehouse) -> DataFrame:
    """Orders with at least one payment."""
    return wh.sales.filter(F.col("payment_value").isNotNull())


def paid_by_known(wh: Warehouse) -> DataFrame:
    """Paid orders of a known customer."""
    return paid(wh).filter(F.col("customer_unique_id").isNotNull())


def down(name: str) -> Column:
    return F.col(name).desc_nulls_last()


def up(name: str) -> Column:
    return F.col(name).asc_nulls_last()


@query("q01_headline_kpi")
def headline_kpi(wh: Warehouse, status: str = "delivered") -> DataFrame:
    return (
        paid(wh)
        .filter(F.col("order_status") == status)
        .agg(F.count(F.lit(1)).alias("delivered_orders"), money("payment_value").alias("revenue"))
    )


@query("q02_aov")
def average_order_value(wh: Warehouse) -> DataFrame:
    """Revenue over order ids that have a payment."""
    return wh.order_payments.agg(rounded(mean("payment_value")).alias("aov"))


@query("q03_status_summary")
def status_summary(wh: Warehouse) -> DataFrame:
    """``orders`` counts payment rows (an unpaid order counts once), as the question is defined."""
    return (
        wh.sales.groupBy("order_status")
        .agg(
            F.sum(F.greatest(F.coalesce("payment_count", F.lit(0)), F.lit(1))).alias("orders"),
            F.coalesce(money("payment_value"), F.lit(0.0)).alias("revenue"),
        )
        .orderBy(down("orders"), up("order_status"))
    )


@query("q04_state_revenue_top10")
def state_revenue(wh: Warehouse, n: int = 10) -> DataFrame:
    by_state = paid_by_known(wh).groupBy("customer_state").agg(money("payment_value").alias("revenue"))
    return top(by_state, [down("revenue"), up("customer_state")], n)


@query("q05_payment_mix")
def payment_mix(wh: Warehouse) -> DataFrame:
    by_type = wh.fact_payments.groupBy("payment_type").agg(
        F.count(F.lit(1)).alias("payments"), F.sum("payment_value").alias("total")
    )
    return by_type.select(
        "payment_type",
        "payments",
        rounded("total").alias("value"),
        share_of_total("total").alias("pct_value"),
    ).orderBy(down("value"), up("payment_type"))


@query("q06_installments")
def installments(wh: Warehouse) -> DataFrame:
    return (
        wh.fact_payments.filter("payment_installments > 0")
        .groupBy("payment_type")
        .agg(rounded(mean("payment_installments")).alias("avg_installments"))
        .orderBy(down("avg_installments"), up("payment_type"))
    )


@query("q07_category_top10")
def category_revenue(wh: Warehouse, n: int | None = 10) -> DataFrame:
    """Orders are counted by the marks of ``lines`` if that is there, else by one row per order and category."""
    label = label_or_unknown("category").alias("category")
    if wh.has("lines"):
        by_category = wh.lines.groupBy(label).agg(
            money("price").alias("revenue"), orders_in_category().alias("orders")
        )
    else:

        def per_order(items: DataFrame) -> DataFrame:
            return items.groupBy("order_id", "category").agg(F.sum("price").alias("price"))

        items = wh.priced_items().select("order_id", label, "price")
        by_category = (
            gathered(items, "order_id", per_order, wh.hot_orders())
            .groupBy("category")
            .agg(money("price").alias("revenue"), F.count("order_id").alias("orders"))
        )
    return top(by_category, [down("revenue"), up("category")], n)


@query("q08_freight_pct")
def freight_share(wh: Warehouse, n: int = 15) -> DataFrame:
    by_category = wh.priced_items().groupBy(label_or_unknown("category").alias("category")).agg(
        rounded(percent(F.sum("freight_value"), F.sum("price"))).alias("freight_pct")
    )
    return top(by_category, [down("freight_pct"), up("category")], n)


def review_mean() -> Column:
    return ratio(F.sum("review_sum"), F.sum("review_scored"))


def reviewed(wh: Warehouse) -> DataFrame:
    """Reviewed orders of a known customer."""
    return wh.sales.filter("review_count is not null and customer_unique_id is not null")


@query("q09_review_by_state")
def review_by_state(wh: Warehouse) -> DataFrame:
    return (
        reviewed(wh)
        .groupBy("customer_state")
        .agg(rounded(review_mean(), 3).alias("avg_review"))
        .orderBy(down("avg_review"), up("customer_state"))
    )


@query("q10_on_time_rate")
def on_time_rate(wh: Warehouse) -> DataFrame:
    """Among delivered orders whose delay is known."""
    return (
        wh.fact_orders.filter("order_status = 'delivered' and delivery_vs_estimate_days is not null")
        .agg(rounded(share_where(F.col("delivery_vs_estimate_days") >= 0)).alias("on_time_pct"))
    )


@query("q11_delivery_by_state")
def delivery_by_state(wh: Warehouse) -> DataFrame:
    return (
        wh.sales.filter("delivery_days is not null and customer_unique_id is not null")
        .groupBy("customer_state")
        .agg(rounded(mean("delivery_days")).alias("avg_delivery_days"))
        .orderBy(up("avg_delivery_days"), up("customer_state"))
    )


@query("q12_multi_item_rate")
def multi_item_rate(wh: Warehouse) -> DataFrame:
    per_order = wh.fact_order_items.groupBy("order_id").agg(F.count(F.lit(1)).alias("items"))
    return per_order.agg(rounded(share_where(F.col("items") > 1)).alias("multi_item_pct"))

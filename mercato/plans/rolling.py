"""Q67-Q78: ABC, rolling windows, pivots and distributions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from mercato.functions.columns import (
    bands,
    day_of_week,
    mean,
    money,
    percent,
    ratio,
    rounded,
    share_where,
    whole,
)
from mercato.operators.rolling import (
    rolling_distinct,
    rolling_mean,
    rolling_mean_calendar,
    rolling_sum,
)
from mercato.operators.topn import top
from mercato.plans.basics import down, paid, up
from mercato.plans.registry import query
from mercato.plans.spines import first_orders
from mercato.plans.warehouse import Warehouse, orders_at_seller
from mercato.specs import PAYMENT_TYPES


@query("q67_abc_products", n=40)
@query("q67_abc_products_all", n=None)
def abc_products(wh: Warehouse, n: int | None = 40) -> DataFrame:
    frame = wh.product_classes.select(
        "product_id",
        rounded("revenue").alias("revenue"),
        rounded(percent(F.col("running"), F.col("total"))).alias("cum_pct"),
        "abc_class",
    )
    return top(frame, [down("revenue"), up("product_id")], n)


@query("q68_abc_summary")
def abc_summary(wh: Warehouse) -> DataFrame:
    return (
        wh.product_classes
        .groupBy("abc_class")
        .agg(
            F.count(F.lit(1)).alias("products"),
            money("revenue").alias("revenue"),
            rounded(percent(F.sum("revenue"), F.max("total"))).alias("pct_revenue"),
        )
        .orderBy("abc_class")
    )


def daily_revenue(wh: Warehouse) -> DataFrame:
    return (
        paid(wh).groupBy(F.col("order_date").alias("d")).agg(F.sum("payment_value").alias("total"))
    )


@query("q69_rolling_7d", limit=60)
@query("q69_rolling_7d_all")
def rolling_week(wh: Warehouse, rows: int = 7, limit: int | None = None) -> DataFrame:
    """Mean over the last seven rows, that is days with revenue."""
    frame = daily_revenue(wh).select(
        "d",
        rounded("total").alias("revenue"),
        rounded(rolling_mean("total", rows)).alias("rolling_7d_avg"),
    )
    return top(frame, [up("d")], limit)


@query("q69_rolling_7d_calendar")
def rolling_week_calendar(wh: Warehouse, days: int = 7) -> DataFrame:
    """The same over seven calendar days."""
    return (
        daily_revenue(wh)
        .select(
            "d",
            rounded("total").alias("revenue"),
            rounded(rolling_mean_calendar("total", days)).alias("rolling_7d_avg"),
        )
        .orderBy("d")
    )


@query("q70_rolling_30d_active", limit=60)
@query("q70_rolling_30d_active_all")
def rolling_active(wh: Warehouse, rows: int = 30, limit: int | None = None) -> DataFrame:
    """Sum of daily distinct counts over thirty rows: a person counts once per active day."""
    daily = (
        wh.sales.filter("customer_unique_id is not null")
        .groupBy(F.col("order_date").alias("d"))
        .agg(F.count_distinct("customer_unique_id").alias("active"))
    )
    frame = daily.select("d", "active", whole(rolling_sum("active", rows)).alias("active_30d"))
    return top(frame, [up("d")], limit)


@query("q70_rolling_30d_distinct")
def rolling_active_distinct(wh: Warehouse, days: int = 30) -> DataFrame:
    """Each person counts once within the thirty calendar days."""
    visits = wh.sales.filter("customer_unique_id is not null")
    return rolling_distinct(visits, "customer_unique_id", "order_date", days).select(
        "d", whole("active").alias("active"), whole("distinct_active").alias("active_30d")
    ).orderBy("d")


@query("q71_payment_pivot")
def payment_pivot(wh: Warehouse) -> DataFrame:
    """Revenue per year and payment type; payments are summed per order before the join."""
    orders = wh.fact_orders.select("order_id", F.year("order_purchase_timestamp").alias("year"))
    payments = wh.fact_payments.groupBy("order_id", "payment_type").agg(
        F.sum("payment_value").alias("payment_value")
    )
    pivoted = (
        payments.join(orders, "order_id")
        .groupBy(whole("year").alias("yr"))
        .pivot("payment_type", list(PAYMENT_TYPES))
        .agg(F.sum("payment_value"))
    )
    return pivoted.select(
        "yr", *[rounded(F.coalesce(F.col(t), F.lit(0))).alias(t) for t in PAYMENT_TYPES]
    ).orderBy("yr")


@query("q72_delivery_funnel")
def delivery_funnel(wh: Warehouse) -> DataFrame:
    return wh.fact_orders.agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.count("order_approved_at").alias("approved"),
        F.count("order_delivered_carrier_date").alias("shipped"),
        F.count("order_delivered_customer_date").alias("delivered"),
    )


# Basket limits and labels of the original currency.
BASKETS = [(50.0, "1: <50"), (100.0, "2: 50-100"), (200.0, "3: 100-200"), (500.0, "4: 200-500")]
TOP_BASKET = "5: 500+"
SCALED_BASKETS = [
    (50_000.0, "1: <50k"),
    (100_000.0, "2: 50k-100k"),
    (200_000.0, "3: 100k-200k"),
    (500_000.0, "4: 200k-500k"),
]


@query("q73_basket_histogram", edges=SCALED_BASKETS, top_label="5: 500k+")
def basket_histogram(
    wh: Warehouse, edges: list[tuple[float, str]] = BASKETS, top_label: str = TOP_BASKET
) -> DataFrame:
    return (
        wh.order_payments
        .groupBy(bands(F.col("payment_value"), edges, top_label).alias("bucket"))
        .agg(F.count(F.lit(1)).alias("orders"), money("payment_value").alias("revenue"))
        .orderBy("bucket")
    )


@query("q74_margin_proxy")
def margin_proxy(wh: Warehouse, n: int = 20) -> DataFrame:
    price, freight = F.sum("price"), F.sum("freight_value")
    by_category = (
        wh.priced_items().filter("known_product")
        .groupBy("category")
        .agg(
            rounded(price).alias("gross_revenue"),
            rounded(freight).alias("freight_cost"),
            rounded(price - freight).alias("net_after_freight"),
            rounded(percent(price - freight, price)).alias("margin_pct"),
        )
    )
    return top(by_category, [down("net_after_freight"), up("category")], n)


@query("q75_weekend_split")
def weekend_split(wh: Warehouse) -> DataFrame:
    day = day_of_week("order_purchase_timestamp")
    return (
        paid(wh)
        .groupBy(F.when(day.isin(0, 6), "weekend").otherwise("weekday").alias("day_type"))
        .agg(
            F.count(F.lit(1)).alias("orders"),
            money("payment_value").alias("revenue"),
            rounded(ratio(F.sum("payment_value"), F.sum("payment_count"))).alias("avg_payment"),
        )
        .orderBy("day_type")
    )


@query("q76_hour_pattern")
def hour_pattern(wh: Warehouse) -> DataFrame:
    return (
        wh.fact_orders.groupBy(whole(F.hour("order_purchase_timestamp")).alias("hour_of_day"))
        .agg(F.count(F.lit(1)).alias("orders"))
        .orderBy("hour_of_day")
    )


@query("q77_first_review_repeat")
def first_review_repeat(wh: Warehouse) -> DataFrame:
    orders = wh.sales.filter("customer_unique_id is not null").select(
        "customer_unique_id",
        "order_id",
        "order_purchase_timestamp",
        "review_sum",
        "review_scored",
        "review_count",
    )
    first = (
        first_orders(orders, 1)
        .filter("review_count is not null")
        .select(
            "customer_unique_id",
            rounded(ratio(F.col("review_sum"), F.col("review_scored")), 0).alias("first_review_score"),
        )
    )
    return (
        first.join(wh.buyers.select("customer_unique_id", "orders"), "customer_unique_id")
        .groupBy("first_review_score")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            rounded(mean("orders"), 3).alias("avg_total_orders"),
            rounded(share_where(F.col("orders") > 1)).alias("repeat_rate_pct"),
        )
        .orderBy("first_review_score")
    )


@query("q78_seller_scorecard")
def seller_scorecard(wh: Warehouse, n: int = 25, min_orders: int = 5) -> DataFrame:
    """Revenue and delivery weigh an item once per review of its order, as the scorecard defines.

    The weights replace the item-review join, so nothing is multiplied.
    """
    weight = F.greatest(F.coalesce("review_count", F.lit(0)), F.lit(1))
    timed = F.col("delivery_days").isNotNull()
    scored = (
        wh.lines.filter("known_order")
        .groupBy("seller_id")
        .agg(
            orders_at_seller().alias("orders"),
            money(F.col("price") * weight).alias("revenue"),
            rounded(ratio(F.sum("review_sum"), F.sum("review_scored"))).alias("avg_review"),
            rounded(
                ratio(F.sum(F.col("delivery_days") * weight), F.sum(F.when(timed, weight))), 1
            ).alias("avg_delivery_days"),
        )
        .filter(F.col("orders") >= min_orders)
    )
    sellers = wh.dim_sellers.select("seller_id", "seller_state")
    return top(scored.join(sellers, "seller_id"), [down("revenue"), up("seller_id")], n).select(
        "seller_id", "seller_state", "orders", "revenue", "avg_review", "avg_delivery_days"
    )

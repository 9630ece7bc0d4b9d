"""Q28-Q37: multi-step questions, calendars and gap filling."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from mercato.functions.columns import (
    as_timestamp,
    mean,
    money,
    month_index,
    month_start,
    percent,
    ratio,
    rounded,
    whole,
)
from mercato.operators import ordered
from mercato.operators.spine import day_spine, gaps_and_islands, month_spine
from mercato.operators.topn import share_of_total, top, top_n_per_group
from mercato.plans.basics import down, paid, paid_by_known, review_mean, reviewed, up
from mercato.plans.registry import query
from mercato.plans.warehouse import Warehouse
from mercato.plans.windows import monthly_revenue, spenders


@query("q28_high_value_low_review")
def high_value_low_review(wh: Warehouse, share: float = 0.9, worst: float = 2.0) -> DataFrame:
    people = spenders(wh)
    person = F.col("customer_unique_id")
    threshold = ordered.percentile(people, "spent", [share], [person])[0]
    average = ratio(F.col("review_sum"), F.col("review_scored"))
    return (
        people.filter((F.col("spent").cast("double") >= F.lit(threshold)) & (average <= worst))
        .select(
            "customer_unique_id",
            rounded("spent").alias("total_spent"),
            rounded(average).alias("avg_review"),
        )
        .orderBy(down("total_spent"), up("customer_unique_id"))
    )


@query("q29_calendar_spine")
def calendar_spine(wh: Warehouse) -> DataFrame:
    days = day_spine(wh.fact_orders, "order_purchase_timestamp")
    return days.agg(
        F.count(F.lit(1)).alias("days_in_range"),
        F.min("day").alias("first_day"),
        F.max("day").alias("last_day"),
    )


@query("q30_gap_filled_months")
def gap_filled_months(wh: Warehouse) -> DataFrame:
    actual = monthly_revenue(wh, delivered_only=False)
    return (
        month_spine(wh.fact_orders, "order_purchase_timestamp")
        .join(actual, "month", "left")
        .select(
            as_timestamp("month").alias("month"),
            rounded(F.coalesce("total", F.lit(0))).alias("revenue"),
        )
        .orderBy("month")
    )


@query("q31_category_share_total")
def category_share_of_total(wh: Warehouse, n: int = 20) -> DataFrame:
    by_category = (
        wh.priced_items().filter("known_product").groupBy("category").agg(F.sum("price").alias("total"))
    )
    shares = by_category.select(
        "category", rounded("total").alias("revenue"), share_of_total("total").alias("pct_of_total")
    )
    return top(shares, [down("revenue"), up("category")], n)


@query("q32_month_template")
def month_template(wh: Warehouse) -> DataFrame:
    """Months 1-12 as a template, each with the number of orders placed in it."""
    months = wh.spark.range(1, 13).select(F.col("id").alias("month_number"))
    counts = wh.fact_orders.groupBy(
        whole(F.month("order_purchase_timestamp")).alias("month_number")
    ).agg(F.count(F.lit(1)).alias("orders"))
    return (
        months.join(counts, "month_number", "left")
        .select("month_number", F.coalesce("orders", F.lit(0)).alias("orders"))
        .orderBy("month_number")
    )


def first_orders(orders: DataFrame, n: int) -> DataFrame:
    """The first n orders of every person, numbered ``seq``."""
    time_order = [up("order_purchase_timestamp"), up("order_id")]
    return top_n_per_group(orders, ["customer_unique_id"], time_order, n, name="seq")


@query("q33_second_larger_than_first")
def second_larger_than_first(wh: Warehouse) -> DataFrame:
    orders = paid_by_known(wh).select(
        "customer_unique_id", "order_id", "order_purchase_timestamp", "payment_value"
    )
    value = F.col("payment_value")
    return (
        first_orders(orders, 2)
        .groupBy("customer_unique_id")
        .agg(
            F.max(F.when(F.col("seq") == 1, value)).alias("one"),
            F.max(F.when(F.col("seq") == 2, value)).alias("two"),
        )
        .filter("two > one")
        .select(
            "customer_unique_id",
            rounded("one").alias("first_value"),
            rounded("two").alias("second_value"),
        )
        .orderBy(down("second_value"), up("customer_unique_id"))
    )


@query("q34_state_kpi_table")
def state_kpis(wh: Warehouse) -> DataFrame:
    """Payment figures over paid orders, reviews over reviewed orders, both in one pass."""
    is_paid = F.col("payment_value").isNotNull()
    return (
        wh.sales.filter("customer_unique_id is not null")
        .groupBy(F.col("customer_state").alias("state"))
        .agg(
            F.count_if(is_paid).alias("orders"),
            money("payment_value").alias("revenue"),
            rounded(mean("payment_value")).alias("aov"),
            rounded(review_mean()).alias("avg_review"),
        )
        .filter("orders > 0")
        .orderBy(down("revenue"), up("state"))
    )


@query("q35_one_time_vs_repeat")
def one_time_vs_repeat(wh: Warehouse) -> DataFrame:
    segment = F.when(F.col("paid_orders") == 1, "one_time").otherwise("repeat")
    by_segment = (
        spenders(wh)
        .groupBy(segment.alias("segment"))
        .agg(F.count(F.lit(1)).alias("customers"), F.sum("spent").alias("total"))
    )
    return by_segment.select(
        "segment",
        "customers",
        rounded("total").alias("revenue"),
        share_of_total("total").alias("pct_revenue"),
    )


def active_months(wh: Warehouse) -> DataFrame:
    return wh.fact_orders.select(month_start("order_purchase_timestamp").alias("month")).distinct()


@query("q36_active_month_streak")
def active_month_streak(wh: Warehouse) -> DataFrame:
    """First, last and number of active months."""
    return active_months(wh).agg(
        as_timestamp(F.min("month")).alias("streak_start"),
        as_timestamp(F.max("month")).alias("streak_end"),
        F.count("month").alias("months"),
    )


@query("gaps_and_islands")
def state_activity_streaks(wh: Warehouse) -> DataFrame:
    """Runs of consecutive months with orders, per state."""
    months = (
        wh.sales.filter("customer_unique_id is not null")
        .select(F.col("customer_state").alias("state"), F.col("order_month").alias("month"))
        .distinct()
    )
    return (
        gaps_and_islands(months, ["state"], month_index("month"))
        .groupBy("state", "island")
        .agg(
            as_timestamp(F.min("month")).alias("streak_start"),
            as_timestamp(F.max("month")).alias("streak_end"),
            F.count(F.lit(1)).alias("months"),
        )
        .drop("island")
        .orderBy("state", "streak_start")
    )


@query("q37_basket_composition")
def basket_composition(wh: Warehouse) -> DataFrame:
    per_order = wh.items_per_order()
    return per_order.agg(
        rounded(mean("item_count")).alias("avg_items"),
        rounded(mean("distinct_products")).alias("avg_distinct_products"),
        rounded(mean("items_value")).alias("avg_items_value"),
    )

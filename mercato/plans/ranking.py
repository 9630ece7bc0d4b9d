"""Q38-Q47: leaderboards and greatest-n-per-group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from mercato.functions.columns import mean, percent, rounded, whole
from mercato.operators import ordered
from mercato.operators.topn import top, top_n_per_group
from mercato.plans.basics import down, paid, reviewed, review_mean, up
from mercato.plans.registry import query
from mercato.plans.warehouse import Warehouse, orders_in_category
from mercato.plans.windows import category_months, spenders
from mercato.session import materialise


@query("q38_top_ltv")
def top_lifetime_value(wh: Warehouse, n: int = 10) -> DataFrame:
    values = spenders(wh).select(
        "customer_unique_id", F.col("paid_orders").alias("orders"), rounded("spent").alias("ltv")
    )
    return top(values, [down("ltv"), up("customer_unique_id")], n)


@query("q39_top_seller_per_state")
def top_seller_per_state(wh: Warehouse) -> DataFrame:
    revenue = wh.fact_order_items.groupBy("seller_id").agg(F.sum("price").alias("total"))
    placed = revenue.join(
        wh.dim_sellers.select("seller_id", F.col("seller_state").alias("state")), "seller_id"
    )
    return (
        top_n_per_group(placed, ["state"], [down("total"), up("seller_id")], 1)
        .select("state", "seller_id", rounded("total").alias("revenue"))
        .orderBy(down("revenue"), up("state"))
    )


@query("q40_bottom_categories")
def bottom_categories(wh: Warehouse, n: int = 10, min_orders: int = 5) -> DataFrame:
    by_category = (
        wh.lines.filter("known_product")
        .groupBy("category")
        .agg(orders_in_category().alias("orders"), F.sum("price").alias("total"))
        .filter(F.col("orders") >= min_orders)
        .select("category", "orders", rounded("total").alias("revenue"))
    )
    return top(by_category, [up("revenue"), up("category")], n)


@query("q41_top5_orders_per_month")
def top_orders_per_month(wh: Warehouse, n: int = 5) -> DataFrame:
    orders = paid(wh).select(F.col("order_month").alias("month"), "order_id", "payment_value")
    return (
        top_n_per_group(orders, ["month"], [down("payment_value"), up("order_id")], n)
        .select(
            F.col("month").cast("timestamp_ntz").alias("month"),
            "order_id",
            rounded("payment_value").alias("order_value"),
            whole("rn").alias("rn"),
        )
        .orderBy("month", "rn")
    )


@query("q42_pareto_80")
def pareto_categories(wh: Warehouse, share: float = 0.8) -> DataFrame:
    """Categories whose running total stays within the share; the one that crosses it is out."""
    everything = Window.partitionBy(F.lit(1))
    running = F.sum("total").over(everything.orderBy(F.desc("total"))).cast("double")
    whole_total = F.sum("total").over(everything).cast("double")
    return (
        wh.lines.filter("known_product")
        .groupBy("category")
        .agg(F.sum("price").alias("total"))
        .select("category", "total", running.alias("running"), whole_total.alias("whole_total"))
        .filter(F.col("running") <= F.lit(share) * F.col("whole_total"))
        .select(
            "category",
            rounded("total").alias("revenue"),
            rounded(percent(F.col("running"), F.col("whole_total"))).alias("cumulative_pct"),
        )
        .orderBy(down("revenue"), up("category"))
    )


@query("q43_state_review_rank")
def state_review_rank(wh: Warehouse) -> DataFrame:
    by_state = (
        reviewed(wh)
        .groupBy(F.col("customer_state").alias("state"))
        .agg(review_mean().alias("average"))
    )
    place = F.rank().over(Window.partitionBy(F.lit(1)).orderBy(F.desc("average")))
    return by_state.select(
        "state", rounded("average", 3).alias("avg_review"), whole(place).alias("review_rank")
    ).orderBy("review_rank", up("state"))


@query("q44_priciest_product")
def priciest_product(wh: Warehouse, n: int = 20) -> DataFrame:
    prices = (
        wh.lines.filter("known_product")
        .groupBy("category", "product_id")
        .agg(mean("price").alias("average"))
    )
    best = top_n_per_group(prices, ["category"], [down("average"), up("product_id")], 1).select(
        "category", "product_id", rounded("average").alias("avg_price")
    )
    return top(best, [down("avg_price"), up("category")], n)


def payment_types_by_order(wh: Warehouse) -> DataFrame:
    """One row per order and payment type: the join below cannot be skewed by one order."""
    return wh.fact_payments.groupBy("order_id", "payment_type").agg(
        F.sum("payment_value").alias("payment_value")
    )


@query("q45_top3_payment_types")
def top_payment_types(wh: Warehouse, n: int = 3) -> DataFrame:
    orders = wh.sales.filter("customer_unique_id is not null").select(
        "order_id", F.col("customer_state").alias("state")
    )
    by_state = (
        payment_types_by_order(wh)
        .join(orders, "order_id")
        .groupBy("state", "payment_type")
        .agg(F.sum("payment_value").alias("total"))
    )
    return (
        top_n_per_group(by_state, ["state"], [down("total")], n, ties="dense")
        .select("state", "payment_type", rounded("total").alias("value"))
        .orderBy(up("state"), down("value"), up("payment_type"))
    )


@query("q46_seller_deciles")
def seller_deciles(wh: Warehouse, tiles: int = 10) -> DataFrame:
    revenue = materialise(
        wh.fact_order_items.groupBy("seller_id").agg(F.sum("price").alias("total")), "sellers"
    )
    by_revenue = [-F.col("total"), F.col("seller_id")]
    return (
        ordered.ntiles(revenue, {"decile": (tiles, by_revenue)})
        .groupBy("decile")
        .agg(F.count(F.lit(1)).alias("sellers"), rounded(F.sum("total")).alias("revenue"))
        .orderBy("decile")
    )


@query("q47_category_growth")
def category_growth(wh: Warehouse, n: int = 15) -> DataFrame:
    """Revenue of the last active month against the first one."""
    growth = (
        category_months(wh)
        .groupBy("category")
        .agg(F.min_by("total", "month").alias("one"), F.max_by("total", "month").alias("last"))
        .filter("one > 0")
        .select(
            "category",
            rounded("one").alias("first_rev"),
            rounded("last").alias("last_rev"),
            rounded(percent(F.col("last") - F.col("one"), F.col("one")), 1).alias("growth_pct"),
        )
    )
    return top(growth, [down("growth_pct"), up("category")], n)

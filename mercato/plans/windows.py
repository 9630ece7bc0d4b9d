"""Q13-Q27: running totals, ranks, neighbours and distributions.

Windows run over months, states, categories or an already limited frame. Where the rows are
orders or customers, a globally ordered operator or a prefix argument takes their place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, WindowSpec, functions as F

from mercato.functions.columns import (
    as_timestamp,
    elapsed_seconds,
    mean,
    percent,
    ratio,
    rounded,
    whole,
)
from mercato.operators import ordered
from mercato.operators.skew import salted_join
from mercato.operators.topn import share_of_total, top, top_n_per_group
from mercato.plans.basics import down, paid, paid_by_known, up
from mercato.plans.registry import query
from mercato.plans.warehouse import Warehouse


def monthly_revenue(wh: Warehouse, delivered_only: bool) -> DataFrame:
    """Revenue per purchase month: as many rows as the data has months."""
    orders = paid(wh)
    if delivered_only:
        orders = orders.filter("order_status = 'delivered'")
    return orders.groupBy(F.col("order_month").alias("month")).agg(
        F.sum("payment_value").alias("total")
    )


def category_months(wh: Warehouse) -> DataFrame:
    """Revenue per category (NULL kept as its own group) and month, known products only."""
    return (
        wh.lines.filter("known_product and known_order")
        .groupBy(F.col("order_month").alias("month"), "category")
        .agg(F.sum("price").alias("total"))
    )


def spenders(wh: Warehouse) -> DataFrame:
    """Persons with at least one payment."""
    return wh.buyers.filter("spent is not null")


def by_month() -> WindowSpec:
    """One row per month reaches this window, so its single task holds a calendar."""
    return Window.partitionBy(F.lit(1)).orderBy(up("month"))


@query("q13_cumulative_revenue")
def cumulative_revenue(wh: Warehouse) -> DataFrame:
    return (
        monthly_revenue(wh, delivered_only=True)
        .select(
            as_timestamp("month").alias("month"),
            rounded("total").alias("revenue"),
            rounded(F.sum("total").over(by_month())).alias("cumulative_revenue"),
        )
        .orderBy("month")
    )


@query("q14_mom_growth")
def month_over_month(wh: Warehouse) -> DataFrame:
    before = F.lag("total").over(by_month())
    change = F.col("total") - before
    return (
        monthly_revenue(wh, delivered_only=True)
        .select(
            as_timestamp("month").alias("month"),
            rounded("total").alias("revenue"),
            rounded(change).alias("mom_change"),
            rounded(percent(change, before)).alias("mom_pct"),
        )
        .orderBy("month")
    )


@query("q15_moving_avg_3m")
def moving_average(wh: Warehouse, months: int = 3) -> DataFrame:
    frame = by_month().rowsBetween(1 - months, 0)
    average = ratio(F.sum("total").over(frame), F.count("total").over(frame))
    return (
        monthly_revenue(wh, delivered_only=False)
        .select(
            as_timestamp("month").alias("month"),
            rounded("total").alias("revenue"),
            rounded(average).alias("moving_avg_3m"),
        )
        .orderBy("month")
    )


@query("q16_rank_customers")
def rank_customers(wh: Warehouse, n: int = 20) -> DataFrame:
    """The ranks of the first n rows depend only on rows before them, so ranking follows the limit."""
    leaders = top(
        spenders(wh).select("customer_unique_id", "spent"), [down("spent"), up("customer_unique_id")], n
    )
    by_spend = Window.partitionBy(F.lit(1)).orderBy(F.desc("spent"))
    total_order = Window.partitionBy(F.lit(1)).orderBy(F.desc("spent"), "customer_unique_id")
    return leaders.select(
        "customer_unique_id",
        rounded("spent").alias("total_spent"),
        whole(F.row_number().over(total_order)).alias("row_num"),
        whole(F.rank().over(by_spend)).alias("rnk"),
        whole(F.dense_rank().over(by_spend)).alias("dense_rnk"),
    ).orderBy("row_num")


@query("q16_rank_customers_all")
def rank_all_customers(wh: Warehouse) -> DataFrame:
    """All five rank functions for every customer, without a single-task window."""
    frame = spenders(wh).select("customer_unique_id", "spent")
    ranked = ordered.ranks(frame, -F.col("spent"), [F.col("customer_unique_id")])
    return ranked.select(
        "customer_unique_id",
        rounded("spent").alias("total_spent"),
        whole("row_number").alias("row_num"),
        whole("rank").alias("rnk"),
        whole("dense_rank").alias("dense_rnk"),
        rounded("percent_rank", 6).alias("pct_rank"),
        rounded("cume_dist", 6).alias("cume_dist"),
    )


def product_revenue(wh: Warehouse) -> DataFrame:
    """Revenue per product; a product has one category."""
    return (
        wh.lines.filter("known_product")
        .groupBy("product_id", "category")
        .agg(F.sum("price").alias("total"))
    )


@query("q17_top3_products_per_category")
def top_products_per_category(wh: Warehouse, n: int = 3) -> DataFrame:
    best = top_n_per_group(
        product_revenue(wh), ["category"], [down("total"), up("product_id")], n
    )
    return best.select(
        "category", "product_id", rounded("total").alias("revenue"), whole("rn").alias("rn")
    ).orderBy(up("category"), "rn")


@query("q18_state_percent_rank")
def state_percent_rank(wh: Warehouse) -> DataFrame:
    by_state = paid_by_known(wh).groupBy("customer_state").agg(F.sum("payment_value").alias("total"))
    by_revenue = Window.partitionBy(F.lit(1)).orderBy("total")
    return by_state.select(
        "customer_state",
        rounded("total").alias("revenue"),
        rounded(F.percent_rank().over(by_revenue), 3).alias("pct_rank"),
    ).orderBy(down("revenue"), up("customer_state"))


@query("q19_spend_quartiles")
def spend_quartiles(wh: Warehouse, tiles: int = 4) -> DataFrame:
    by_spend = [F.col("spent"), F.col("customer_unique_id")]
    return (
        ordered.ntiles(spenders(wh), {"quartile": (tiles, by_spend)})
        .groupBy("quartile")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            rounded(F.min("spent")).alias("min_spent"),
            rounded(F.max("spent")).alias("max_spent"),
            rounded(mean("spent")).alias("avg_spent"),
        )
        .orderBy("quartile")
    )


@query("q20_first_last_order", limit=20)
@query("q20_first_last_order_all")
def first_last_order(wh: Warehouse, limit: int | None = None) -> DataFrame:
    """``limit`` gives the first page of the report in customer order."""
    dates = wh.buyers.select(
        "customer_unique_id",
        F.col("first_purchase").alias("first_order"),
        F.col("last_purchase").alias("last_order"),
    )
    return top(dates, [up("customer_unique_id")], limit)


@query("q21_category_share_of_month")
def category_share_of_month(wh: Warehouse) -> DataFrame:
    return (
        category_months(wh)
        .select(
            as_timestamp("month").alias("month"),
            "category",
            rounded("total").alias("revenue"),
            share_of_total("total", within=["month"]).alias("pct_of_month"),
        )
        .orderBy("month", down("revenue"), up("category"))
    )


@query("q22_order_gap", limit=30)
@query("q22_order_gap_all")
def order_gap(wh: Warehouse, limit: int | None = None) -> DataFrame:
    """Seconds since the previous order of the same person.

    The first page in (person, time) order holds every predecessor it needs, so the window
    follows the limit. Without a limit the lag spans range buckets, and a person with very
    many orders is split over several of them.
    """
    orders = wh.sales.filter("customer_unique_id is not null").select(
        "customer_unique_id", "order_id", "order_purchase_timestamp"
    )
    time_order = [up("order_purchase_timestamp"), up("order_id")]
    if limit is None:
        with_previous = ordered.lag_within(
            orders,
            "customer_unique_id",
            [F.col("order_purchase_timestamp"), F.col("order_id")],
            "order_purchase_timestamp",
            "previous",
        )
    else:
        person = Window.partitionBy("customer_unique_id").orderBy(*time_order)
        with_previous = top(orders, [up("customer_unique_id"), *time_order], limit).withColumn(
            "previous", F.lag("order_purchase_timestamp").over(person)
        )
    return with_previous.select(
        "customer_unique_id",
        "order_id",
        "order_purchase_timestamp",
        elapsed_seconds("previous", "order_purchase_timestamp").alias("gap_seconds"),
    )


@query("q23_cume_dist_orders")
def order_value_distribution(wh: Warehouse, n: int = 25) -> DataFrame:
    """Only larger orders precede a row of the top n, so its CUME_DIST is 1 - (rank - 1) / N."""
    orders = wh.order_payments.select("order_id", "payment_value")
    leaders = top(orders, [down("payment_value"), up("order_id")], n)
    by_value = Window.partitionBy(F.lit(1)).orderBy(F.desc("payment_value"))
    total = F.broadcast(orders.agg(F.count(F.lit(1)).alias("total")))
    return (
        leaders.withColumn("larger", F.rank().over(by_value) - 1)
        .crossJoin(total)
        .select(
            "order_id",
            rounded("payment_value").alias("order_value"),
            rounded(ratio(F.col("total") - F.col("larger"), F.col("total")), 4).alias("cume_dist"),
        )
        .orderBy(down("order_value"), "order_id")
    )


@query("q24_best_product_per_state")
def best_product_per_state(wh: Warehouse) -> DataFrame:
    """Ties for the first place are all kept."""
    sold = (
        wh.lines.filter("customer_unique_id is not null")
        .groupBy(F.col("customer_state").alias("state"), "product_id")
        .agg(F.sum("price").alias("total"))
    )
    return (
        top_n_per_group(sold, ["state"], [down("total")], 1, ties="ties")
        .select("state", "product_id", rounded("total").alias("revenue"))
        .orderBy(down("revenue"), up("state"), up("product_id"))
    )


@query("q25_running_peak", limit=50)
@query("q25_running_peak_all")
def running_peak(wh: Warehouse, limit: int | None = None) -> DataFrame:
    peak = F.max("total").over(Window.partitionBy("category").orderBy(up("month")))
    frame = category_months(wh).select(
        "category",
        as_timestamp("month").alias("month"),
        rounded("total").alias("revenue"),
        rounded(peak).alias("running_peak"),
    )
    return top(frame, [up("category"), up("month")], limit)


@query("q26_diff_from_customer_avg", limit=30)
@query("q26_diff_from_customer_avg_all")
def difference_from_average(wh: Warehouse, limit: int | None = None) -> DataFrame:
    """The customer mean comes from the person mart, not from a window over a person's orders."""
    orders = paid_by_known(wh).select("customer_unique_id", "order_id", "payment_value")
    page = top(orders, [up("customer_unique_id"), up("order_id")], limit) if limit is not None else orders
    means = wh.buyers.select(
        "customer_unique_id", ratio(F.col("spent"), F.col("paid_orders")).alias("average")
    )
    joined = salted_join(page, means, "customer_unique_id", ["order_id"]).select(
        "customer_unique_id",
        "order_id",
        rounded("payment_value").alias("order_value"),
        rounded(F.col("payment_value").cast("double") - F.col("average")).alias("diff_from_avg"),
    )
    return joined.orderBy("customer_unique_id", "order_id")


@query("q27_category_leaderboard", limit=50)
@query("q27_category_leaderboard_all")
def category_leaderboard(wh: Warehouse, limit: int | None = None) -> DataFrame:
    place = F.dense_rank().over(Window.partitionBy("month").orderBy(F.desc("total")))
    frame = category_months(wh).select(
        as_timestamp("month").alias("month"),
        "category",
        rounded("total").alias("revenue"),
        whole(place).alias("rank_in_month"),
    )
    return top(frame, [up("month"), up("rank_in_month"), up("category")], limit)

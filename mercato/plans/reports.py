"""Serving-layer questions: dashboard figures, searches, measures and profiles."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from mercato.functions.columns import (
    all_of,
    as_timestamp,
    bands,
    elapsed_days,
    label_or_unknown,
    mean,
    money,
    percent,
    ratio,
    rounded,
    share_where,
    whole,
)
from mercato.operators.paging import Order
from mercato.operators.topn import top, top_by_metric
from mercato.plans.basics import category_revenue, down, paid, paid_by_known, review_mean, up
from mercato.plans.registry import query
from mercato.plans.warehouse import Warehouse, orders_in_category
from mercato.specs import CATALOG


def month_label(column: str = "order_month") -> Column:
    return F.date_format(F.to_date(column), "yyyy-MM")


# ---- API ------------------------------------------------------------------------------------


@query("api_kpis")
def api_kpis(wh: Warehouse) -> DataFrame:
    """Unpaid orders count as zero; the on-time share is over all orders."""
    value = F.coalesce("payment_value", F.lit(0))
    on_time = F.count_if(F.col("delivery_vs_estimate_days") >= 0)
    rows = F.count(F.lit(1))
    reviews = F.broadcast(
        wh.fact_reviews.agg(rounded(mean("review_score"), 3).alias("avg_review_score"))
    )
    return (
        wh.sales.agg(
            rows.alias("total_orders"),
            rounded(F.sum(value)).alias("total_revenue"),
            rounded(ratio(F.sum(value), rows)).alias("avg_order_value"),
            F.count_distinct("customer_id").alias("unique_customers"),
            rounded(ratio(on_time, rows), 4).alias("on_time_delivery_rate"),
        )
        .crossJoin(reviews)
    )


def revenue_by_month(orders: DataFrame) -> DataFrame:
    return (
        orders.groupBy(month_label().alias("period"))
        .agg(money("payment_value").alias("revenue"), F.count(F.lit(1)).alias("orders"))
        .orderBy("period")
    )


@query("api_monthly_revenue")
def api_monthly_revenue(wh: Warehouse) -> DataFrame:
    return revenue_by_month(paid(wh).filter("order_status = 'delivered'"))


def revenue_by_state(wh: Warehouse) -> DataFrame:
    return (
        paid_by_known(wh)
        .groupBy(F.col("customer_state").alias("state"))
        .agg(money("payment_value").alias("revenue"), F.count(F.lit(1)).alias("orders"))
    )


@query("api_revenue_by_state")
def api_revenue_by_state(wh: Warehouse, n: int = 10) -> DataFrame:
    return top(revenue_by_state(wh), [down("revenue"), up("state")], n)


def customer_summary(wh: Warehouse) -> DataFrame:
    """Every customer with orders and spend; customers without orders stay, with zero."""
    totals = wh.customer_totals
    kept = [c for c in totals.columns if c != "spent"]
    return totals.select(*kept, rounded("spent").alias("total_spent"))


# Pages that end beyond this row are read from a stored list instead of sorting all rows before them.
DEEP = 10_000


def paged(
    wh: Warehouse, name: str, frame: DataFrame, order: Sequence[Order], limit: int | None, offset: int, deep: int = DEEP
) -> DataFrame:
    """One page of a sorted list; ``name`` tells this list and its filters from others."""
    if limit is None or offset + limit <= deep:
        return top(frame, [o.sort() for o in order], limit, offset)
    return wh.pages(name, lambda: frame, order).page(offset, limit)


SPEND_ORDER = (Order("total_spent", descending=True), Order("customer_id"))
TIME_ORDER = (Order("purchase_timestamp", descending=True), Order("order_id"))


def search_customers(
    wh: Warehouse,
    state: str | None = None,
    city: str | None = None,
    limit: int | None = 20,
    offset: int = 0,
    min_spent: float | None = None,
    deep: int = DEEP,
) -> DataFrame:
    """Optional filters are combined with AND; the page is sorted by spend."""
    predicates = []
    if state:
        predicates.append(F.col("customer_state") == state.upper())
    if city:
        predicates.append(F.lower("customer_city") == city.lower())
    if min_spent is not None:
        predicates.append(F.col("total_spent") >= min_spent)
    found = customer_summary(wh).filter(all_of(predicates))
    name = f"customers:{state and state.upper()}:{city and city.lower()}:{min_spent}"
    return paged(wh, name, found, SPEND_ORDER, limit, offset, deep)


@query("api_customer_search", state="nation_3", city="Machinery", limit=20, offset=5)
def api_customer_search(wh: Warehouse, **filters: object) -> DataFrame:
    return search_customers(wh, **filters)


@query("dynamic_filters")
def filtered_customers(wh: Warehouse) -> DataFrame:
    """The search without paging: all rows that pass two optional filters."""
    return search_customers(wh, state="nation_3", min_spent=200_000.0, limit=None)


@query("api_customer_by_id", customer_id=7)
def customer_by_id(wh: Warehouse, customer_id: object) -> DataFrame:
    return customer_summary(wh).filter(F.col("customer_id") == F.lit(customer_id))


def order_summary(wh: Warehouse) -> DataFrame:
    return wh.sales.select(
        "order_id",
        "customer_id",
        "order_status",
        F.col("order_purchase_timestamp").cast("string").alias("purchase_timestamp"),
        rounded("payment_value").alias("payment_value"),
        "delivery_days",
    )


def listed_orders(wh: Warehouse, status: str | None) -> DataFrame:
    predicates = [F.col("order_status") == status] if status else []
    return order_summary(wh).filter(all_of(predicates))


@query("api_order_list", status="shipped", limit=20, offset=10)
@query("api_order_list_deep", status="delivered", limit=30, offset=400, deep=0)
def order_list(
    wh: Warehouse, status: str | None = None, limit: int | None = 20, offset: int = 0, deep: int = DEEP
) -> DataFrame:
    """Newest first."""
    return paged(wh, f"orders:{status}", listed_orders(wh, status), TIME_ORDER, limit, offset, deep)


@query("api_order_list_next", offset=400, limit=30)
def orders_after(wh: Warehouse, offset: int, limit: int) -> DataFrame:
    """The page after the one at ``offset``, found by its last row instead of a number of rows."""
    pages = wh.pages("orders:None", lambda: listed_orders(wh, None), TIME_ORDER)
    last = pages.page(offset + limit - 1, 1).first()
    return pages.after([last[o.column] for o in TIME_ORDER], limit)


@query("api_customer_search_deep", state=None, limit=25, offset=60, deep=0)
def customer_search_deep(wh: Warehouse, **filters: object) -> DataFrame:
    return search_customers(wh, **filters)


@query("api_status_breakdown")
def status_breakdown(wh: Warehouse) -> DataFrame:
    return (
        wh.fact_orders.groupBy("order_status")
        .agg(F.count(F.lit(1)).alias("orders"))
        .orderBy(down("orders"), "order_status")
    )


@query("api_order_by_id", order_id=42)
def order_by_id(wh: Warehouse, order_id: object) -> DataFrame:
    return order_summary(wh).filter(F.col("order_id") == F.lit(order_id))


@query("api_top_products")
def top_products(wh: Warehouse, n: int = 10) -> DataFrame:
    sold = wh.lines.groupBy("product_id", "category").agg(
        F.count_distinct("order_id").alias("orders"), money("price").alias("revenue")
    )
    return top(sold, [down("revenue"), up("product_id")], n)


@query("api_categories")
def categories(wh: Warehouse, n: int = 15) -> DataFrame:
    by_category = wh.lines.groupBy(label_or_unknown("category").alias("category")).agg(
        orders_in_category().alias("orders"),
        money("price").alias("revenue"),
        rounded(mean("price")).alias("avg_item_price"),
    )
    return top(by_category, [down("revenue"), up("category")], n)


def dashboard(wh: Warehouse) -> dict[str, DataFrame]:
    """The three frames of the dashboard."""
    return {
        "kpis": wh.sales.agg(
            F.count(F.lit(1)).alias("total_orders"),
            F.count_distinct("customer_id").alias("unique_customers"),
        ).crossJoin(F.broadcast(wh.order_payments.agg(money("payment_value").alias("total_revenue")))),
        "monthly_orders": orders_by_month(wh, "period"),
        "top_categories": category_revenue(wh, 5).select("category", "revenue"),
    }


@query("api_dashboard")
def dashboard_rows(wh: Warehouse) -> DataFrame:
    """The dashboard as one long table: section, label, value."""
    frames = dashboard(wh)
    kpis = frames["kpis"].select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(c).alias("label"), F.col(c).cast("double").alias("value"))
                    for c in frames["kpis"].columns
                ]
            )
        ).alias("e")
    )
    return (
        kpis.select(F.lit("kpis").alias("section"), "e.label", "e.value")
        .unionByName(
            frames["monthly_orders"].select(
                F.lit("monthly_orders").alias("section"),
                F.col("period").alias("label"),
                F.col("orders").cast("double").alias("value"),
            )
        )
        .unionByName(
            frames["top_categories"].select(
                F.lit("top_categories").alias("section"),
                F.col("category").alias("label"),
                F.col("revenue").alias("value"),
            )
        )
    )


# ---- dashboard pages ----------------------------------------------------------------------------


@query("ui_kpis")
def ui_kpis(wh: Warehouse) -> DataFrame:
    """All payments, also those of unknown orders; the average order value is over all orders."""
    rows = F.count(F.lit(1))
    reviews = F.broadcast(wh.fact_reviews.agg(rounded(mean("review_score"), 3).alias("avg_review")))
    totals = wh.sales.agg(
        rows.alias("total_orders"), F.count_distinct("customer_id").alias("unique_customers")
    )
    revenue = F.broadcast(wh.order_payments.agg(F.sum("payment_value").alias("paid")))
    return (
        totals.crossJoin(revenue)
        .crossJoin(reviews)
        .select(
            "total_orders",
            "unique_customers",
            rounded("paid").alias("total_revenue"),
            rounded(ratio(F.col("paid"), F.col("total_orders"))).alias("avg_order_value"),
            "avg_review",
        )
    )


@query("ui_monthly_revenue")
def ui_monthly_revenue(wh: Warehouse) -> DataFrame:
    """All statuses."""
    return revenue_by_month(paid(wh))


@query("ui_revenue_by_state")
def ui_revenue_by_state(wh: Warehouse) -> DataFrame:
    return revenue_by_state(wh).orderBy(down("revenue"), up("state"))


@query("ui_category_revenue")
def ui_category_revenue(wh: Warehouse) -> DataFrame:
    return category_revenue(wh, None)


@query("ui_states")
def ui_states(wh: Warehouse) -> DataFrame:
    return wh.dim_customers.select("customer_state").distinct().dropna().orderBy("customer_state")


@query("ui_aov")
def ui_average_order_value(wh: Warehouse) -> DataFrame:
    """Not rounded."""
    return wh.order_payments.agg(mean("payment_value").alias("aov"))


@query("ui_customer_search", state="NATION_7", min_spent=150_000.0)
def ui_customer_search(
    wh: Warehouse, state: str | None = None, min_spent: float = 0.0, n: int = 500
) -> DataFrame:
    state = None if state == "All" else state
    return search_customers(wh, state=state, min_spent=min_spent, limit=n).drop("customer_unique_id")


@query("ui_top_n_by_metric", metric="orders", n=15)
def top_categories_by(wh: Warehouse, metric: str = "revenue", n: int = 15) -> DataFrame:
    return top_by_metric(category_revenue(wh, None), metric, n, "category")


# ---- extracts and profiles -------------------------------------------------------------------------


def orders_by_month(wh: Warehouse, name: str) -> DataFrame:
    return (
        wh.fact_orders.groupBy(month_label("order_purchase_timestamp").alias(name))
        .agg(F.count(F.lit(1)).alias("orders"))
        .orderBy(name)
    )


@query("extract_monthly_orders")
def monthly_orders_extract(wh: Warehouse) -> DataFrame:
    return orders_by_month(wh, "month")


def profile(frame: DataFrame, name: str) -> DataFrame:
    """Rows, columns and NULL cells of a table in one pass."""
    nulls = reduce(lambda a, b: a + b, [F.count_if(F.col(f"`{c}`").isNull()) for c in frame.columns])
    return frame.agg(F.count(F.lit(1)).alias("row_count"), nulls.alias("null_cells")).select(
        F.lit(name).alias("table_name"),
        "row_count",
        F.lit(len(frame.columns)).cast("bigint").alias("col_count"),
        "null_cells",
    )


@query("eda_profile")
def profile_sources(wh: Warehouse) -> DataFrame:
    """The nine processed tables."""
    return reduce(DataFrame.unionByName, [profile(wh.source(name), name) for name in CATALOG])


@query("star_profile")
def profile_star(wh: Warehouse) -> DataFrame:
    """The star facts and dimensions."""
    return reduce(
        DataFrame.unionByName, [profile(frame, name) for name, frame in wh.star_tables().items()]
    )


@query("eda_status_counts")
def status_counts(wh: Warehouse) -> DataFrame:
    return status_breakdown(wh).withColumnRenamed("orders", "count")


@query("eda_monthly_delivered")
def monthly_delivered(wh: Warehouse) -> DataFrame:
    return (
        paid(wh)
        .filter("order_status = 'delivered'")
        .groupBy(month_label().alias("month"))
        .agg(money("payment_value").alias("payment_value"))
        .orderBy("month")
    )


def deliveries(wh: Warehouse) -> DataFrame:
    """Delivered orders with whole elapsed days and the on-time flag by timestamp."""
    return wh.sales.filter("order_delivered_customer_date is not null").select(
        "order_id",
        elapsed_days("order_purchase_timestamp", "order_delivered_customer_date").alias("days"),
        F.expr("order_delivered_customer_date <= order_estimated_delivery_date").alias("on_time"),
        "review_sum",
        "review_scored",
    )


@query("eda_delivery_stats")
def delivery_statistics(wh: Warehouse) -> DataFrame:
    """Count, mean, spread and quartiles; the day counts have as many values as days, so few."""
    quarter = F.percentile("days", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    n, total = F.count("days"), F.sum("days")
    squares = F.sum(F.col("days") * F.col("days"))
    variance = (
        squares.cast("double") - total.cast("double") * total.cast("double") / n.cast("double")
    ) / (n.cast("double") - 1)
    return (
        deliveries(wh)
        .agg(
            n.alias("count"),
            rounded(mean("days"), 4).alias("mean"),
            rounded(F.sqrt(variance), 4).alias("std"),
            F.min("days").alias("min"),
            quarter.alias("q"),
            F.max("days").alias("max"),
            rounded(share_where(F.col("on_time")), 1).alias("on_time_pct"),
        )
        .select(
            "count",
            "mean",
            "std",
            "min",
            F.col("q")[0].alias("p25"),
            F.col("q")[1].alias("p50"),
            F.col("q")[2].alias("p75"),
            "max",
            "on_time_pct",
        )
    )


@query("eda_delivery_histogram")
def delivery_histogram(wh: Warehouse, bins: int = 40) -> DataFrame:
    """Equal-width bins between the smallest and the largest value; the last bin is closed."""
    days = deliveries(wh).select("days")
    edges = F.broadcast(
        days.agg(F.min("days").alias("low"), F.max("days").alias("high"))
    )
    value, low, high = (F.col(c).cast("double") for c in ("days", "low", "high"))
    position = F.floor((value - low) * F.lit(float(bins)) / (high - low))
    return (
        days.crossJoin(edges)
        .groupBy(whole(F.least(position, F.lit(bins - 1))).alias("bin"))
        .agg(F.count(F.lit(1)).alias("orders"))
        .orderBy("bin")
    )


@query("eda_review_by_outcome")
def review_by_outcome(wh: Warehouse) -> DataFrame:
    return (
        deliveries(wh)
        .filter("review_scored is not null")
        .groupBy(F.when(F.col("on_time"), "on_time").otherwise("late").alias("outcome"))
        .agg(rounded(review_mean(), 4).alias("mean"), F.sum("review_scored").alias("count"))
        .orderBy("outcome")
    )


# ---- measures and pivots ------------------------------------------------------------------------------


def measures() -> dict[str, object]:
    """Named measures over the sales mart; use them with any grouping."""
    rows = F.count(F.lit(1))
    value = F.col("payment_value")
    return {
        "total_revenue": money("payment_value"),
        "total_orders": rows,
        "avg_order_value": rounded(ratio(F.sum(value), rows)),
        "delivered_revenue": rounded(F.sum(F.when(F.col("order_status") == "delivered", value))),
        "on_time_pct": rounded(percent(F.count_if(F.col("delivery_vs_estimate_days") >= 0), rows)),
        "avg_review": rounded(review_mean(), 3),
    }


@query("bi_measures")
def monthly_measures(wh: Warehouse) -> DataFrame:
    """The measures per month, with the change against the previous calendar month.

    The previous month is looked up by date, so after a month without orders it is NULL.
    """
    monthly = wh.sales.groupBy("order_month").agg(
        *[c.alias(n) for n, c in measures().items()], F.sum("payment_value").alias("exact")
    )
    previous = monthly.select(
        F.add_months("order_month", 1).alias("order_month"), F.col("exact").alias("previous")
    )
    change = percent(F.col("exact") - F.col("previous"), F.col("previous"))
    return (
        monthly.join(previous, "order_month", "left")
        .select(
            as_timestamp("order_month").alias("order_month"),
            *measures(),
            rounded(change).alias("revenue_mom_pct"),
        )
        .orderBy("order_month")
    )


@query("bi_repeat_customers")
def repeat_customers(wh: Warehouse) -> DataFrame:
    return wh.buyers.agg(
        F.count(F.lit(1)).alias("customers"),
        F.count_if(F.col("orders") > 1).alias("repeat_customers"),
        rounded(share_where(F.col("orders") > 1)).alias("repeat_customer_pct"),
    )


@query("bi_pivot_monthly")
def pivot_monthly(wh: Warehouse) -> DataFrame:
    return monthly_delivered(wh)


@query("bi_pivot_category")
def pivot_category(wh: Warehouse) -> DataFrame:
    """By the untranslated category; orders are counted per item."""
    names = wh.dim_products.select("product_id", "product_category_name")
    per_product = wh.fact_order_items.groupBy("product_id").agg(
        F.sum("price").alias("price"), F.count("order_id").alias("n")
    )
    return (
        per_product.join(names, "product_id")
        .groupBy("product_category_name")
        .agg(money("price").alias("price"), F.sum("n").alias("order_count"))
    )


@query("bi_pivot_state")
def pivot_state(wh: Warehouse) -> DataFrame:
    return (
        paid_by_known(wh).groupBy("customer_state").agg(money("payment_value").alias("payment_value"))
    )


@query("bi_pivot_payment")
def pivot_payment(wh: Warehouse) -> DataFrame:
    return wh.fact_payments.groupBy("payment_type").agg(
        money("payment_value").alias("payment_value"),
        rounded(mean("payment_installments"), 4).alias("avg_installments"),
    )


@query("bi_pivots", tiers=[(100_000.0, "Low"), (300_000.0, "Mid"), (1_000_000.0, "High")])
def flags_and_tiers(
    wh: Warehouse,
    tiers: list[tuple[float, str]] = [(100.0, "Low"), (300.0, "Mid"), (1000.0, "High")],
) -> DataFrame:
    """Per month and spend tier of the order: orders, on-time flags and value."""
    tier = bands(F.col("payment_value"), tiers, "VIP")
    return (
        paid(wh)
        .groupBy(month_label().alias("month"), tier.alias("tier"))
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.count_if(F.col("delivery_vs_estimate_days") >= 0).alias("on_time_orders"),
            money("payment_value").alias("revenue"),
        )
        .orderBy("month", "tier")
    )

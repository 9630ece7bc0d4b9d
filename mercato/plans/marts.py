"""Star tables, staging and business marts as queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from mercato.functions.columns import as_timestamp, mean, money, ratio, real, rounded, whole
from mercato.operators.clean import augment_date_parts, normalise_place
from mercato.operators.months import Measure, MonthlyState
from mercato.operators.skew import salted_join
from mercato.plans.basics import paid
from mercato.plans.registry import query
from mercato.plans.warehouse import Warehouse, orders_in_category
from mercato.session import scratch_path


@query("dim_customers")
def dim_customers(wh: Warehouse) -> DataFrame:
    return normalise_place(wh.dim_customers, "customer_city", "customer_state")


@query("dim_sellers")
def dim_sellers(wh: Warehouse) -> DataFrame:
    return normalise_place(wh.dim_sellers, "seller_city", "seller_state")


@query("dim_products")
def dim_products(wh: Warehouse) -> DataFrame:
    return wh.dim_products


@query("dim_geography")
def dim_geography(wh: Warehouse) -> DataFrame:
    return wh.dim_geography


@query("dim_dates")
def dim_dates(wh: Warehouse) -> DataFrame:
    return wh.dim_dates


@query("fact_orders")
def fact_orders(wh: Warehouse) -> DataFrame:
    return wh.fact_orders.withColumn("purchase_date_key", whole("purchase_date_key"))


@query("fact_order_items")
def fact_order_items(wh: Warehouse) -> DataFrame:
    return wh.fact_order_items.select(
        "order_id",
        whole("order_item_id").alias("order_item_id"),
        "product_id",
        "seller_id",
        "shipping_limit_date",
        real("price").alias("price"),
        real("freight_value").alias("freight_value"),
        real("total_item_value").alias("total_item_value"),
    )


@query("fact_payments")
def fact_payments(wh: Warehouse) -> DataFrame:
    return wh.fact_payments.select(
        "order_id",
        whole("payment_sequential").alias("payment_sequential"),
        "payment_type",
        whole("payment_installments").alias("payment_installments"),
        real("payment_value").alias("payment_value"),
    )


@query("fact_reviews")
def fact_reviews(wh: Warehouse) -> DataFrame:
    return wh.fact_reviews.withColumn("review_score", whole("review_score"))


@query("int_order_items_agg")
def order_items_aggregate(wh: Warehouse) -> DataFrame:
    return wh.items_per_order().select(
        "order_id",
        "item_count",
        "distinct_products",
        real("items_value").alias("items_value"),
        rounded("freight_value", 4).alias("freight_value"),
    )


@query("int_order_payments")
def order_payments_aggregate(wh: Warehouse) -> DataFrame:
    return wh.payments_per_order().select(
        "order_id",
        real("payment_value").alias("payment_value"),
        whole("max_installments").alias("max_installments"),
        "payment_count",
    )


@query("int_order_reviews")
def order_reviews_aggregate(wh: Warehouse) -> DataFrame:
    return wh.reviews_per_order().select(
        "order_id",
        ratio(F.col("review_sum"), F.col("review_scored")).alias("review_score"),
        "answer_latency_days",
    )


@query("mart_fact_orders_wide")
def orders_wide(wh: Warehouse) -> DataFrame:
    return wh.sales.select(
        "order_id",
        "customer_id",
        "order_status",
        "order_purchase_timestamp",
        "delivery_days",
        "delivery_vs_estimate_days",
        "item_count",
        "distinct_products",
        real("items_value").alias("items_value"),
        rounded("freight_value", 4).alias("freight_value"),
        real("payment_value").alias("payment_value"),
        whole("max_installments").alias("max_installments"),
        ratio(F.col("review_sum"), F.col("review_scored")).alias("review_score"),
    )


def primary_categories(wh: Warehouse) -> DataFrame:
    """Category of an order's first item that has one (by item number, so reruns agree).

    The category of the smallest item number is found by map-side aggregation, with no list
    of an order's items.
    """
    names = wh.dim_products.select("product_id", "product_category_name")
    labelled = salted_join(
        wh.fact_order_items.select("order_id", "order_item_id", "product_id"),
        names.filter("product_category_name is not null"),
        "product_id",
        ["order_id", "order_item_id"],
    )
    return labelled.groupBy("order_id").agg(
        F.min_by("product_category_name", "order_item_id").alias("primary_category")
    )


@query("fact_orders_enriched")
def orders_enriched(wh: Warehouse) -> DataFrame:
    enriched = wh.sales.select(
        "order_id",
        "customer_id",
        "order_status",
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
        "distinct_products",
        "item_count",
        rounded("items_value").alias("items_value"),
        rounded("freight_value").alias("freight_value"),
        rounded("payment_value").alias("payment_value"),
        whole("max_installments").alias("max_installments"),
        "delivery_days",
    ).join(primary_categories(wh), "order_id", "left")
    return augment_date_parts(enriched).withColumns(
        {"purchase_year": whole("purchase_year"), "purchase_month": whole("purchase_month")}
    )


def delivered_by_month(wh: Warehouse) -> DataFrame:
    return wh.sales.filter("order_status = 'delivered'").groupBy(
        as_timestamp("order_month").alias("order_month")
    )


@query("mart_monthly_revenue")
def monthly_revenue_mart(wh: Warehouse) -> DataFrame:
    return delivered_by_month(wh).agg(
        F.count(F.lit(1)).alias("orders"),
        money("payment_value").alias("revenue"),
        rounded(mean("payment_value")).alias("avg_order_value"),
    )


@query("mart_revenue_by_state")
def revenue_by_state_mart(wh: Warehouse) -> DataFrame:
    return (
        wh.sales.filter("customer_unique_id is not null")
        .groupBy("customer_state")
        .agg(F.count(F.lit(1)).alias("orders"), money("payment_value").alias("revenue"))
    )


@query("mart_category_performance")
def category_performance_mart(wh: Warehouse) -> DataFrame:
    return wh.lines.groupBy("category").agg(
        orders_in_category().alias("orders"),
        money("price").alias("revenue"),
        rounded(mean("price")).alias("avg_item_price"),
        money("freight_value").alias("freight"),
    )


@query("mart_customer_rfm")
def customer_rfm_mart(wh: Warehouse) -> DataFrame:
    """Every person counts here; without a payment ``monetary`` is NULL and ranks last."""
    return wh.rfm_everyone.withColumn("monetary", rounded("monetary"))


# What ``buyers`` holds, in a form that months can be added to.
BUYER_MEASURES = (
    Measure("orders", "count", "true"),
    Measure("paid_orders", "count", "payment_value is not null"),
    Measure("spent", "sum", "payment_value"),
    Measure("first_purchase", "min", "order_purchase_timestamp"),
    Measure("last_purchase", "max", "order_purchase_timestamp"),
    Measure("last_paid_purchase", "max", "if(payment_value is not null, order_purchase_timestamp, null)"),
    Measure("review_sum", "sum", "review_sum"),
    Measure("review_scored", "sum", "review_scored"),
)


def buyer_state(wh: Warehouse, path: str) -> MonthlyState:
    """The figures of ``buyers`` as partial states per month of purchase."""
    return MonthlyState(wh.spark, path, "order_month", ["customer_unique_id"], BUYER_MEASURES)


@query("mart_buyers_by_month")
def merged_buyers(wh: Warehouse) -> DataFrame:
    """``buyers`` from monthly states: all months but the last at first, then the last one alone."""
    state = buyer_state(wh, scratch_path(wh.spark, "buyer-state"))
    known = wh.sales.filter(F.col("customer_unique_id").isNotNull())
    last = F.broadcast(known.agg(F.max("order_month").alias("_last")))
    marked = known.crossJoin(last)
    newest = F.coalesce(F.col("order_month") == F.col("_last"), F.lit(False))
    state.put(marked.filter(~newest))
    state.put(marked.filter(newest))
    return state.merged().select(
        "customer_unique_id",
        whole("orders").alias("orders"),
        whole("paid_orders").alias("paid_orders"),
        rounded("spent").alias("spent"),
        as_timestamp("first_purchase").alias("first_purchase"),
        as_timestamp("last_purchase").alias("last_purchase"),
        whole("review_sum").alias("review_sum"),
    )


@query("vw_order_facts")
def order_facts_view(wh: Warehouse) -> DataFrame:
    return wh.sales.filter("customer_unique_id is not null").select(
        "order_id",
        "customer_id",
        "customer_unique_id",
        "customer_state",
        "order_status",
        "order_purchase_timestamp",
        "order_month",
        "delivery_days",
        "delivery_vs_estimate_days",
        real("payment_value").alias("payment_value"),
        ratio(F.col("review_sum"), F.col("review_scored")).alias("review_score"),
    )


@query("vw_monthly_revenue")
def monthly_revenue_view(wh: Warehouse) -> DataFrame:
    return (
        wh.sales.filter("order_status = 'delivered' and customer_unique_id is not null")
        .groupBy("order_month")
        .agg(F.count(F.lit(1)).alias("orders"), money("payment_value").alias("revenue"))
    )


@query("vw_product_performance")
def product_performance_view(wh: Warehouse) -> DataFrame:
    """Items of unknown products make one row without product and category."""
    product = F.when(F.col("known_product"), F.col("product_id"))
    return wh.lines.groupBy(product.alias("product_id"), "category").agg(
        F.count_distinct("order_id").alias("orders"),
        money("price").alias("revenue"),
        rounded(mean("price")).alias("avg_price"),
    )


@query("star_row_counts")
def star_row_counts(wh: Warehouse) -> DataFrame:
    counts = [
        frame.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, frame in wh.star_tables().items()
    ]
    return reduce(DataFrame.unionByName, counts)


@query("seed_csv")
def region_rollup(wh: Warehouse) -> DataFrame:
    """Paid revenue per region through the state lookup."""
    by_state = paid(wh).groupBy("customer_state").agg(
        F.count(F.lit(1)).alias("n"), F.sum("payment_value").alias("total")
    )
    return (
        by_state.join(wh.state_regions, "customer_state")
        .groupBy("region")
        .agg(F.sum("n").alias("orders"), money("total").alias("revenue"))
        .orderBy("region")
    )

"""Star schema: five dimensions, four facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from mercato.functions.columns import day_of_week, mean, whole
from mercato.operators.skew import salted_join


def _exact(df: DataFrame, column: str) -> Column:
    """Money as decimal; double sources carry two decimals."""
    is_double = isinstance(df.schema[column].dataType, T.DoubleType)
    return F.col(column).cast("decimal(12,2)") if is_double else F.col(column)


def _present(df: DataFrame, names: tuple[str, ...]) -> list[str]:
    return [n for n in names if n in df.columns]


def dim_customers(customers: DataFrame) -> DataFrame:
    return customers.select(
        "customer_id",
        "customer_unique_id",
        "customer_zip_code_prefix",
        "customer_city",
        "customer_state",
    )


def dim_sellers(sellers: DataFrame) -> DataFrame:
    return sellers.select("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state")


def dim_products(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Products with the English category; an untranslated category keeps its own name.

    Spark broadcasts the translation when its measured size allows it. Otherwise a category
    with very many products, or none at all, is spread by product.
    """
    measures = (
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
        "product_photos_qty",
    )
    named = salted_join(products, translation, "product_category_name", ["product_id"], "left")
    return named.select(
        "product_id",
        "product_category_name",
        F.coalesce("product_category_name_english", "product_category_name").alias(
            "product_category_english"
        ),
        *_present(products, measures),
    )


def dim_geography(geolocation: DataFrame) -> DataFrame:
    """One row per zip prefix; MIN picks city and state so that reruns agree."""
    return geolocation.groupBy(F.col("geolocation_zip_code_prefix").alias("zip_code_prefix")).agg(
        mean("geolocation_lat").alias("latitude"),
        mean("geolocation_lng").alias("longitude"),
        F.min("geolocation_city").alias("city"),
        F.min("geolocation_state").alias("state"),
    )


def date_key(column: Column | str) -> Column:
    """YYYYMMDD as a number, from the calendar fields (no session time zone involved)."""
    return F.year(column) * 10000 + F.month(column) * 100 + F.dayofmonth(column)


def dim_dates(orders: DataFrame) -> DataFrame:
    """Every day from the first to the last purchase."""
    bounds = orders.agg(
        F.min("order_purchase_timestamp").cast("date").alias("first"),
        F.max("order_purchase_timestamp").cast("date").alias("last"),
    )
    day = F.col("date")
    return bounds.select(
        F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("date")
    ).select(
        date_key(day).alias("date_key"),
        "date",
        whole(F.year(day)).alias("year"),
        whole(F.quarter(day)).alias("quarter"),
        whole(F.month(day)).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        whole(F.dayofmonth(day)).alias("day"),
        whole(day_of_week(day)).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        whole(F.weekofyear(day)).alias("week_of_year"),
        day_of_week(day).isin(0, 6).alias("is_weekend"),
    )


def fact_orders(orders: DataFrame) -> DataFrame:
    """``delivery_vs_estimate_days`` is estimate minus delivery: negative means late."""
    return orders.select(
        "order_id",
        "customer_id",
        "order_status",
        "order_purchase_timestamp",
        date_key("order_purchase_timestamp").alias("purchase_date_key"),
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
        whole(F.datediff("order_delivered_customer_date", "order_purchase_timestamp")).alias(
            "delivery_days"
        ),
        whole(F.datediff("order_estimated_delivery_date", "order_delivered_customer_date")).alias(
            "delivery_vs_estimate_days"
        ),
    )


def fact_order_items(order_items: DataFrame) -> DataFrame:
    price, freight = _exact(order_items, "price"), _exact(order_items, "freight_value")
    return order_items.select(
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        "shipping_limit_date",
        price.alias("price"),
        freight.alias("freight_value"),
        (price + freight).alias("total_item_value"),
    )


def fact_payments(order_payments: DataFrame) -> DataFrame:
    return order_payments.select(
        "order_id",
        "payment_sequential",
        "payment_type",
        F.col("payment_installments").cast("int").alias("payment_installments"),
        _exact(order_payments, "payment_value").alias("payment_value"),
    )


def fact_reviews(order_reviews: DataFrame) -> DataFrame:
    return order_reviews.select(
        "review_id",
        "order_id",
        F.col("review_score").cast("int").alias("review_score"),
        "review_creation_date",
        "review_answer_timestamp",
        whole(F.datediff("review_answer_timestamp", "review_creation_date")).alias(
            "answer_latency_days"
        ),
    )

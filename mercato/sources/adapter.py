"""Shapes the generic order/lineitem/event test tables into the nine source tables."""

from __future__ import annotations

from collections.abc import Callable
from threading import Lock

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from mercato.operators.clean import distinct_on
from mercato.operators.skew import gathered, salted_join
from mercato.session import materialise


LINE_KEY = ["l_orderkey", "l_linenumber"]
# Of the lines with one key the first by all columns, in this order, is kept; it is also the first by any of the leading ones.
PRICE_COLUMNS = [*LINE_KEY, "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"]
LINE_COLUMNS = [*PRICE_COLUMNS, "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


def _plus(unit: str, amount: Column, ts: Column) -> Column:
    return F.timestamp_add(unit, amount.cast("int"), ts)


class SourceTables:
    """The nine source tables over one folder of Parquet files, each built when first asked for."""

    def __init__(self, spark: SparkSession, base_dir: str) -> None:
        self._spark = spark
        self._dir = base_dir.rstrip("/")
        self._kept: dict[str, DataFrame] = {}
        self._building = {"clean-lines": Lock(), "customers": Lock()}

    def raw(self, table: str) -> DataFrame:
        if table not in self._kept:
            self._kept[table] = self._spark.read.parquet(f"{self._dir}/{table}.parquet")
        return self._kept[table]

    def _stored(self, label: str, build: Callable[[], DataFrame]) -> DataFrame:
        """Written once, by whichever thread asks first."""
        with self._building[label]:
            if label not in self._kept:
                self._kept[label] = materialise(build(), label)
            return self._kept[label]

    def _clean_lines(self) -> DataFrame:
        """Line items with one row per (order, line); both items and payments come from it."""

        def build() -> DataFrame:
            lines = self.raw("lineitem").select(*LINE_COLUMNS)
            return distinct_on(lines, LINE_KEY)

        return self._stored("clean-lines", build)

    def customers(self) -> DataFrame:
        """One customer row per order; the person is customer and order priority together."""
        return self._stored("customers", self._join_customers)

    def _join_customers(self) -> DataFrame:
        customer = self.raw("customer").select(
            F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_mktsegment"
        )
        nation = self.raw("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
        orders = self.raw("orders").select("o_orderkey", "o_custkey", "o_orderpriority")
        placed = salted_join(orders, customer.join(nation, "c_nationkey"), "o_custkey", ["o_orderkey"])
        return placed.select(
            F.col("o_orderkey").alias("customer_id"),
            (
                F.col("o_custkey") * 10 + F.substring("o_orderpriority", 1, 1).cast("bigint")
            ).alias("customer_unique_id"),
            F.col("c_nationkey").alias("customer_zip_code_prefix"),
            F.lower(F.trim("c_mktsegment")).alias("customer_city"),
            F.col("n_name").alias("customer_state"),
        )

    def sellers(self) -> DataFrame:
        nation = self.raw("nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
        return (
            self.raw("supplier")
            .join(nation, "s_nationkey")
            .select(
                F.col("s_suppkey").alias("seller_id"),
                F.col("s_nationkey").alias("seller_zip_code_prefix"),
                F.lower(F.trim("s_name")).alias("seller_city"),
                F.col("n_name").alias("seller_state"),
            )
        )

    def products(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("product_id"),
            F.nullif(F.col("p_brand"), F.lit("Brand#25")).alias("product_category_name"),
            F.col("p_size").cast("double").alias("product_weight_g"),
        )

    def product_category_translation(self) -> DataFrame:
        number = F.substring("p_brand", 7, 100)
        return (
            self.raw("part")
            .select("p_brand")
            .distinct()
            .filter(number.cast("int") <= 20)
            .select(
                F.col("p_brand").alias("product_category_name"),
                F.concat(F.lit("category_"), number).alias("product_category_name_english"),
            )
        )

    def geolocation(self) -> DataFrame:
        nation = self.raw("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
        return (
            self.raw("customer")
            .join(nation, "c_nationkey")
            .select(
                F.col("c_nationkey").alias("geolocation_zip_code_prefix"),
                F.col("c_acctbal").cast("decimal(12,2)").alias("geolocation_lat"),
                F.col("c_acctbal").cast("decimal(12,2)").alias("geolocation_lng"),
                F.lower(F.trim("c_mktsegment")).alias("geolocation_city"),
                F.col("n_name").alias("geolocation_state"),
            )
        )

    def state_regions(self) -> DataFrame:
        region = self.raw("region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
        return (
            self.raw("nation")
            .join(region, "n_regionkey")
            .select(F.col("n_name").alias("customer_state"), F.col("r_name").alias("region"))
        )

    def orders(self) -> DataFrame:
        order = F.col("order_id")
        status = F.col("order_status")
        bought = F.col("order_purchase_timestamp")
        base = self.raw("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_orderkey").alias("customer_id"),
            F.when(F.col("o_orderstatus") == "F", "delivered")
            .when(F.col("o_orderstatus") == "P", "shipped")
            .otherwise("created")
            .alias("order_status"),
            _plus("SECOND", (F.col("o_orderkey") * 7919) % 86400, F.col("o_orderdate")).alias(
                "order_purchase_timestamp"
            ),
        )
        return base.select(
            "order_id",
            "customer_id",
            "order_status",
            "order_purchase_timestamp",
            F.when(order % 97 != 0, _plus("HOUR", order % 48, bought)).alias("order_approved_at"),
            F.when(status.isin("delivered", "shipped"), _plus("HOUR", 48 + order % 48, bought)).alias(
                "order_delivered_carrier_date"
            ),
            F.when(status == "delivered", _plus("HOUR", 72 + (order * 31) % 600, bought)).alias(
                "order_delivered_customer_date"
            ),
            _plus("DAY", 18 + order % 11, bought.cast("date").cast("timestamp_ntz")).alias(
                "order_estimated_delivery_date"
            ),
        )

    def _items_from(self, lines: DataFrame) -> DataFrame:
        price = F.col("l_extendedprice").cast("decimal(12,2)")
        return lines.select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("order_item_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("seller_id"),
            F.col("l_shipdate").alias("shipping_limit_date"),
            price.alias("price"),
            (price * F.col("l_tax").cast("decimal(4,2)")).cast("decimal(18,4)").alias("freight_value"),
        )

    def order_items(self) -> DataFrame:
        return self._items_from(self._clean_lines())

    def order_items_uncleaned(self) -> DataFrame:
        return self._items_from(self.raw("lineitem"))

    def item_prices(self) -> DataFrame:
        """Product and price of the order items, from the cleaned lines if they are there.

        Else from narrow lines, brought together by order and sorted once, of which nothing is stored.
        """
        if "clean-lines" in self._kept:
            lines = self._clean_lines()
        else:
            narrow = self.raw("lineitem").select(*PRICE_COLUMNS)
            lines = gathered(narrow, "l_orderkey", lambda rows: distinct_on(rows, LINE_KEY))
        price = F.col("l_extendedprice").cast("decimal(12,2)")
        return lines.select(F.col("l_partkey").alias("product_id"), price.alias("price"))

    def order_payments(self) -> DataFrame:
        return self._clean_lines().select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("payment_sequential"),
            F.when(F.col("l_returnflag") == "A", "credit_card")
            .when(F.col("l_returnflag") == "N", "boleto")
            .when(F.col("l_linestatus") == "F", "voucher")
            .otherwise("debit_card")
            .alias("payment_type"),
            (F.col("l_quantity").cast("int") % 13).alias("payment_installments"),
            F.col("l_extendedprice").cast("decimal(12,2)").alias("payment_value"),
        )

    def order_reviews(self) -> DataFrame:
        event = F.col("event_id")
        return self.raw("events").select(
            event.alias("review_id"),
            F.when(event % 10 == 9, event - 1).otherwise(event).alias("order_id"),
            (1 + F.floor("value").cast("int") % 5).cast("int").alias("review_score"),
            F.col("ts").alias("review_creation_date"),
            _plus("HOUR", event % 240, F.col("ts")).alias("review_answer_timestamp"),
        )


# Table order follows the catalog; state_regions is the extra lookup, and what follows it serves single queries.
def source_tables(spark: SparkSession, base_dir: str) -> dict[str, object]:
    """Name to builder of every source table."""
    tables = SourceTables(spark, base_dir)
    return {
        "customers": tables.customers,
        "sellers": tables.sellers,
        "products": tables.products,
        "product_category_translation": tables.product_category_translation,
        "geolocation": tables.geolocation,
        "orders": tables.orders,
        "order_items": tables.order_items,
        "order_payments": tables.order_payments,
        "order_reviews": tables.order_reviews,
        "state_regions": tables.state_regions,
        "raw": tables.raw,
        "order_items_uncleaned": tables.order_items_uncleaned,
        "item_prices": tables.item_prices,
    }

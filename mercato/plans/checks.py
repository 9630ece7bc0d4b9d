"""Quality reports over the warehouse sources."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from mercato.operators import quality
from mercato.plans.marts import customer_rfm_mart, monthly_revenue_mart
from mercato.plans.registry import query
from mercato.plans.warehouse import Warehouse
from mercato.specs import CATALOG, ORDER_STATUSES, spec_of


def _tables(wh: Warehouse, **replaced: str) -> dict:
    """Source tables by catalog name; a replacement names another source builder."""
    return {
        name: (lambda n=replaced.get(name, name): wh.source(n)) for name in CATALOG
    }


@query("validation_report")
def validation_report(wh: Warehouse) -> DataFrame:
    """All checks of the catalog on the cleaned tables."""
    return quality.validate(wh.spark, _tables(wh), list(CATALOG.values()))


@query("validation_report_uncleaned")
def validation_report_uncleaned(wh: Warehouse) -> DataFrame:
    """The item checks on rows before cleaning: their keys repeat."""
    tables = _tables(wh, order_items="order_items_uncleaned")
    return quality.validate(wh.spark, tables, [spec_of("order_items")])


@query("quality_gate")
def failed_checks(wh: Warehouse) -> DataFrame:
    """What stops the gate on rows before cleaning."""
    return quality.failures(validation_report_uncleaned(wh))


@query("validation_summary")
def validation_summary(wh: Warehouse) -> DataFrame:
    return quality.summary(validation_report(wh))


def _one(wh: Warehouse, table: str, rules: dict) -> DataFrame:
    return quality.check_columns(wh.source(table), table, rules)


@query("check_not_null")
def check_not_null(wh: Warehouse) -> DataFrame:
    return _one(wh, "orders", quality.not_null_rules(spec_of("orders").named()))


@query("check_pk_unique")
def check_pk_unique(wh: Warehouse) -> DataFrame:
    """Before and after cleaning."""
    keys = spec_of("order_items").named(in_key=True)
    return quality.check_pk_unique(
        wh.source("order_items_uncleaned"), "order_items_uncleaned", keys
    ).unionByName(quality.check_pk_unique(wh.source("order_items"), "order_items", keys))


@query("check_fk")
def check_fk(wh: Warehouse) -> DataFrame:
    """Items and reviews point at orders; orders do not all appear among payments."""
    orders = wh.source("orders")
    return reduce(
        DataFrame.unionByName,
        [
            quality.check_fk(wh.source(t), t, "order_id", orders, "orders.order_id")
            for t in ("order_items", "order_reviews")
        ]
        + [
            quality.check_fk(
                orders, "orders", "order_id", wh.source("order_payments"), "order_payments.order_id"
            )
        ],
    )


@query("check_timestamp_type")
def check_timestamp_type(wh: Warehouse) -> DataFrame:
    """Declared timestamp columns of every table, next to the table's row count."""
    parts = []
    for name in ("orders", "order_items", "order_reviews"):
        frame, spec = wh.source(name), spec_of(name)
        rows = quality.timestamp_types(frame, name, spec.named(type="timestamp"))
        counted = frame.agg(F.count(F.lit(1)).alias("row_count"))
        results = F.array(
            *[F.struct(F.lit(r[1]).alias("check_name"), F.lit(r[2]).alias("passed")) for r in rows]
        )
        parts.append(
            counted.select("row_count", F.explode(results).alias("e")).select(
                F.lit(name).alias("table_name"), "e.check_name", "e.passed", "row_count"
            )
        )
    return reduce(DataFrame.unionByName, parts)


@query("check_non_negative")
def check_non_negative(wh: Warehouse) -> DataFrame:
    items = quality.non_negative_rules(["price", "freight_value"])
    payments = quality.non_negative_rules(["payment_value"])
    return _one(wh, "order_items", items).unionByName(_one(wh, "order_payments", payments))


@query("check_between")
def check_between(wh: Warehouse) -> DataFrame:
    """Scores within 1-5 pass; the narrower 2-4 shows a counted failure."""
    wide = quality.between_rules({"review_score": (1, 5)})
    narrow = {f"{k}:2-4": v for k, v in quality.between_rules({"review_score": (2, 4)}).items()}
    return _one(wh, "order_reviews", wide | narrow)


@query("check_accepted_values")
def check_accepted_values(wh: Warehouse) -> DataFrame:
    statuses = _one(wh, "orders", quality.accepted_rules({f.name: f.values for f in spec_of("orders") if f.values}))
    scores = quality.check_columns(
        customer_rfm_mart(wh),
        "mart_customer_rfm",
        quality.accepted_rules({"r_score": (1, 2, 3, 4, 5)}),
    )
    return statuses.unionByName(scores)


@query("check_singular")
def check_singular(wh: Warehouse) -> DataFrame:
    return quality.check_singular(
        monthly_revenue_mart(wh), "mart_monthly_revenue", "positive_revenue", F.col("revenue") < 0
    )


@query("mart_checks")
def mart_checks(wh: Warehouse) -> DataFrame:
    """What the star and the marts promise: keys, references, accepted values."""
    rfm = customer_rfm_mart(wh)
    keyed = {
        "dim_customers": (wh.dim_customers, ["customer_id"], ["customer_id", "customer_unique_id"]),
        "dim_products": (wh.dim_products, ["product_id"], ["product_id"]),
        "dim_sellers": (wh.dim_sellers, ["seller_id"], ["seller_id"]),
        "fact_orders": (wh.fact_orders, ["order_id"], ["order_id", "customer_id"]),
        "mart_monthly_revenue": (monthly_revenue_mart(wh), ["order_month"], ["order_month"]),
        "mart_customer_rfm": (rfm, ["customer_unique_id"], ["customer_unique_id"]),
    }
    extra = {
        "fact_orders": quality.accepted_rules({"order_status": ORDER_STATUSES}),
        "mart_monthly_revenue": {"positive_revenue": F.col("revenue") < 0},
        "mart_customer_rfm": quality.accepted_rules({"r_score": (1, 2, 3, 4, 5)}),
    }
    references = {"fact_orders": {"customer_id": "dim_customers.customer_id"}}
    subjects = [
        quality.Subject(name, frame, quality.not_null_rules(required) | extra.get(name, {}), key, references.get(name, {}))
        for name, (frame, key, required) in keyed.items()
    ]
    return quality.check_all(wh.spark, subjects)


@query("suite_from_spec")
def suite_with_contract(wh: Warehouse) -> DataFrame:
    """Reviews and orders with their value contracts, generated from the spec."""
    specs = [spec_of("orders"), spec_of("order_reviews")]
    return quality.validate(wh.spark, _tables(wh), specs, contract=True)

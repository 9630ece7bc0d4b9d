"""Q79-Q87 and the figures derived from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from mercato.functions.columns import (
    as_timestamp,
    label_or_unknown,
    mean,
    money,
    percent,
    ratio,
    rounded,
    share_where,
    whole,
)
from mercato.operators.cohort import cohort_matrix, month_offset
from mercato.operators.rfm import WIN_BACK_SEGMENTS
from mercato.plans.basics import down, up
from mercato.plans.registry import query
from mercato.plans.segments import segmented
from mercato.plans.spines import first_orders
from mercato.plans.warehouse import Warehouse


@query("q79_late_first_delivery")
@query("ui_delivery_retention")
def late_first_delivery(wh: Warehouse) -> DataFrame:
    """Repeat rate and value by how the first delivered order arrived; unknown delay is on time."""
    delivered = wh.sales.filter(
        "order_delivered_customer_date is not null and customer_unique_id is not null"
    ).select(
        "customer_unique_id", "order_id", "order_purchase_timestamp", "delivery_vs_estimate_days"
    )
    late = F.col("delivery_vs_estimate_days") < 0
    first = first_orders(delivered, 1).select(
        "customer_unique_id", F.when(late, "late").otherwise("on_time").alias("first_delivery_status")
    )
    people = wh.buyers.filter("spent is not null").select(
        "customer_unique_id", "paid_orders", "spent"
    )
    return (
        first.join(people, "customer_unique_id")
        .groupBy("first_delivery_status")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            rounded(share_where(F.col("paid_orders") > 1)).alias("repeat_rate_pct"),
            rounded(mean("spent")).alias("avg_ltv"),
        )
        .orderBy("first_delivery_status")
    )


@query("q80_late_by_state")
@query("ui_late_delivery_by_state")
def late_by_state(wh: Warehouse, min_orders: int = 30) -> DataFrame:
    late = F.col("delivery_vs_estimate_days") < 0
    return (
        wh.sales.filter(
            "order_delivered_customer_date is not null and customer_unique_id is not null"
        )
        .groupBy("customer_state")
        .agg(
            F.count(F.lit(1)).alias("delivered_orders"),
            F.count_if(late).alias("late_orders"),
            rounded(share_where(late)).alias("late_pct"),
        )
        .filter(F.col("delivered_orders") >= min_orders)
        .orderBy(down("late_pct"), up("customer_state"))
    )


def freight_burden(lines: DataFrame, groups: list, min_items: int) -> DataFrame:
    price, freight = mean("price"), mean("freight_value")
    return (
        lines.groupBy(*groups)
        .agg(
            F.count(F.lit(1)).alias("items"),
            rounded(price).alias("avg_price"),
            rounded(freight).alias("avg_freight"),
            rounded(percent(freight, price)).alias("freight_pct_of_price"),
        )
        .filter(F.col("items") >= min_items)
    )


@query("q81_freight_cell")
@query("ui_freight_by_category_region")
def freight_by_category_and_state(wh: Warehouse, min_items: int = 20) -> DataFrame:
    placed = wh.lines.filter("customer_unique_id is not null")
    groups = [label_or_unknown("category").alias("category"), "customer_state"]
    return freight_burden(placed, groups, min_items).orderBy(
        down("freight_pct_of_price"), "category", "customer_state"
    )


@query("q82_freight_category")
@query("ui_freight_by_category")
def freight_by_category(wh: Warehouse, min_items: int = 20) -> DataFrame:
    groups = [label_or_unknown("category").alias("category")]
    return freight_burden(wh.priced_items(), groups, min_items).orderBy(
        down("freight_pct_of_price"), "category"
    )


@query("q83_winback_list")
@query("ui_rfm_winback_list")
def winback_list(wh: Warehouse, segments: tuple[str, ...] = WIN_BACK_SEGMENTS) -> DataFrame:
    return (
        segmented(wh)
        .filter(F.col("segment").isin(*segments))
        .select(
            "customer_unique_id",
            "segment",
            "recency_days",
            "frequency",
            rounded("monetary").alias("monetary"),
        )
        .orderBy(down("monetary"), up("customer_unique_id"))
    )


@query("q84_winback_sizing")
def winback_sizing(wh: Warehouse, segments: tuple[str, ...] = WIN_BACK_SEGMENTS) -> DataFrame:
    return (
        segmented(wh)
        .filter(F.col("segment").isin(*segments))
        .groupBy("segment")
        .agg(F.count(F.lit(1)).alias("customers"), money("monetary").alias("total_revenue"))
        .orderBy(down("total_revenue"), "segment")
    )


@query("q85_cohort_revenue_matrix")
def cohort_revenue_matrix(wh: Warehouse) -> DataFrame:
    paid_months = wh.buyer_months.filter("revenue is not null")
    matrix = cohort_matrix(paid_months, {"revenue": money("revenue")}, "months_since_first_order")
    return matrix.withColumn("cohort_month", as_timestamp("cohort_month")).orderBy(
        "cohort_month", "months_since_first_order"
    )


@query("q86_payback_curve")
@query("ui_payback_curve")
def payback_curve(wh: Warehouse) -> DataFrame:
    people = F.broadcast(wh.buyers.agg(F.count(F.lit(1)).alias("people")))
    by_offset = Window.partitionBy(F.lit(1)).orderBy(
        F.asc_nulls_last("months_since_first_order")
    )
    return (
        wh.buyer_months.filter("revenue is not null")
        .groupBy(month_offset().alias("months_since_first_order"))
        .agg(F.sum("revenue").alias("total"))
        .crossJoin(people)
        .select(
            "months_since_first_order",
            rounded("total").alias("total_revenue"),
            rounded(ratio(F.col("total"), F.col("people"))).alias("revenue_per_customer"),
            rounded(ratio(F.sum("total").over(by_offset), F.col("people"))).alias(
                "cumulative_revenue_per_customer"
            ),
        )
        .orderBy("months_since_first_order")
    )


@query("q87_geo_opportunity")
@query("ui_geo_opportunity")
def geo_opportunity(wh: Warehouse, min_customers: int = 30) -> DataFrame:
    """The delivery mean weighs an order once per payment, as the question is defined."""
    return (
        wh.sales.filter(
            "delivery_days is not null and payment_value is not null"
            " and customer_unique_id is not null"
        )
        .groupBy("customer_state")
        .agg(
            F.count_distinct("customer_unique_id").alias("customers"),
            F.sum("payment_value").alias("total"),
            F.sum(F.col("delivery_days") * F.col("payment_count")).alias("days"),
            F.sum("payment_count").alias("payments"),
        )
        .filter(F.col("customers") >= min_customers)
        .select(
            "customer_state",
            "customers",
            rounded(ratio(F.col("total"), F.col("customers"))).alias("revenue_per_customer"),
            rounded(ratio(F.col("days"), F.col("payments")), 1).alias("avg_delivery_days"),
        )
        .orderBy(down("revenue_per_customer"), "customer_state")
    )


# ---- figures the insight page derives ----------------------------------------------------------


@query("insight_month0_share")
def month0_share(wh: Warehouse, through_month: int = 12) -> DataFrame:
    """Share of the cumulative revenue per customer that the first month brings."""
    curve = payback_curve(wh).filter(F.col("months_since_first_order") <= through_month)
    value, offset = F.col("cumulative_revenue_per_customer"), F.col("months_since_first_order")
    return curve.agg(
        F.max(offset).alias("through_month"),
        F.max(F.when(offset == 0, value)).alias("month0"),
        F.max_by(value, offset).alias("final"),
    ).select(
        "through_month",
        rounded(percent(F.col("month0"), F.col("final")), 1).alias("pct_in_month0"),
    )


@query("insight_revenue_at_risk")
def revenue_at_risk(wh: Warehouse) -> DataFrame:
    """Late first buyers times the gap in repeat rate times the average order value."""
    status = F.col("first_delivery_status")

    def of(kind: str, column: str):
        return F.max(F.when(status == kind, F.col(column)))

    split = late_first_delivery(wh).agg(
        of("late", "customers").alias("late_customers"),
        (of("on_time", "repeat_rate_pct") - of("late", "repeat_rate_pct")).alias("gap"),
    )
    payments = wh.sales.agg(
        F.sum("payment_value").cast("double").alias("revenue"),
        F.count("payment_value").alias("paid_orders"),
    )
    at_risk = (
        F.col("late_customers").cast("double")
        * F.col("gap")
        / F.lit(100.0)
        * ratio(F.col("revenue"), F.col("paid_orders"))
    )
    return split.crossJoin(F.broadcast(payments)).select(
        "late_customers",
        rounded("gap").alias("repeat_gap_pp"),
        rounded(at_risk).alias("revenue_at_risk"),
        rounded(percent(at_risk, F.col("revenue")), 3).alias("revenue_at_risk_pct"),
    )


@query("insight_freight_flags", threshold=4.0)
def freight_flags(wh: Warehouse, threshold: float = 40.0) -> DataFrame:
    """Categories above the threshold, and whether freight exceeds the price."""
    share = F.col("freight_pct_of_price")
    return (
        freight_by_category(wh)
        .filter(share > threshold)
        .select("category", "freight_pct_of_price", (share > 100).alias("margin_negative"))
    )


@query("insight_winback_totals")
def winback_totals(wh: Warehouse, segments: tuple[str, ...] = WIN_BACK_SEGMENTS) -> DataFrame:
    return winback_list(wh, segments).agg(
        F.count(F.lit(1)).alias("customers"),
        rounded(F.sum(F.col("monetary").cast("decimal(28,2)"))).alias("revenue"),
    )


@query("insight_opportunity_quadrant")
def opportunity_quadrant(wh: Warehouse) -> DataFrame:
    """States above the median in both revenue per customer and delivery days."""
    states = geo_opportunity(wh)
    medians = F.broadcast(
        states.agg(
            F.median("revenue_per_customer").alias("mid_revenue"),
            F.median("avg_delivery_days").alias("mid_days"),
        )
    )
    return (
        states.crossJoin(medians)
        .filter("revenue_per_customer > mid_revenue and avg_delivery_days > mid_days")
        .select("customer_state", "customers", "revenue_per_customer", "avg_delivery_days")
        .orderBy(down("revenue_per_customer"), "customer_state")
    )

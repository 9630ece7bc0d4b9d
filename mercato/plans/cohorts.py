"""Q48-Q57: cohorts, retention and repeat behaviour."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from mercato.functions.columns import (
    as_timestamp,
    mean,
    money,
    percent,
    rounded,
    share_where,
    whole,
)
from mercato.operators.cohort import cohort_matrix, month_offset
from mercato.plans.registry import query
from mercato.plans.spines import first_orders
from mercato.plans.warehouse import Warehouse


@query("q48_cohort_sizes")
def cohort_sizes(wh: Warehouse) -> DataFrame:
    return (
        wh.buyer_months.filter("order_month <=> cohort_month")
        .groupBy(as_timestamp("cohort_month").alias("cohort_month"))
        .agg(F.count(F.lit(1)).alias("new_customers"))
        .orderBy("cohort_month")
    )


@query("q49_cohort_retention_matrix")
def retention_matrix(wh: Warehouse) -> DataFrame:
    matrix = cohort_matrix(
        wh.buyer_months, {"active_customers": F.count(F.lit(1))}, "month_offset"
    )
    return matrix.withColumn("cohort_month", as_timestamp("cohort_month")).orderBy(
        "cohort_month", "month_offset"
    )


@query("q50_m1_retention")
def month_one_retention(wh: Warehouse) -> DataFrame:
    started, returned = F.count_if(month_offset() == 0), F.count_if(month_offset() == 1)
    return (
        wh.buyer_months.groupBy(as_timestamp("cohort_month").alias("cohort_month"))
        .agg(
            started.alias("cohort_size"),
            returned.alias("retained_m1"),
            rounded(percent(returned, started)).alias("m1_retention_pct"),
        )
        .orderBy("cohort_month")
    )


@query("q51_repeat_rate")
def repeat_rate(wh: Warehouse) -> DataFrame:
    return wh.buyers.agg(rounded(share_where(F.col("orders") > 1)).alias("repeat_rate_pct"))


@query("q52_days_to_second")
def days_to_second_order(wh: Warehouse) -> DataFrame:
    orders = wh.sales.filter("customer_unique_id is not null").select(
        "customer_unique_id", "order_id", "order_purchase_timestamp"
    )
    bought = F.col("order_purchase_timestamp")
    gaps = (
        first_orders(orders, 2)
        .groupBy("customer_unique_id")
        .agg(
            F.max(F.when(F.col("seq") == 1, bought)).alias("one"),
            F.max(F.when(F.col("seq") == 2, bought)).alias("two"),
        )
        .filter("two is not null")
        .select(whole(F.datediff("two", "one")).alias("days"))
    )
    return gaps.agg(
        rounded(mean("days"), 1).alias("avg_days_to_second"),
        F.min("days").alias("min_days"),
        F.max("days").alias("max_days"),
    )


@query("q53_monthly_active")
def monthly_active(wh: Warehouse) -> DataFrame:
    return (
        wh.buyer_months.groupBy(as_timestamp("order_month").alias("month"))
        .agg(F.count(F.lit(1)).alias("active_customers"))
        .orderBy("month")
    )


@query("q54_new_vs_returning")
def new_vs_returning(wh: Warehouse) -> DataFrame:
    revenue, none = F.col("revenue"), F.lit(0)
    return (
        wh.buyer_months.filter("revenue is not null")
        .groupBy(as_timestamp("order_month").alias("month"))
        .agg(
            money(F.when(F.expr("order_month = cohort_month"), revenue).otherwise(none)).alias(
                "new_revenue"
            ),
            money(F.when(F.expr("order_month > cohort_month"), revenue).otherwise(none)).alias(
                "returning_revenue"
            ),
        )
        .orderBy("month")
    )


@query("q55_churn_180d")
def churn(wh: Warehouse, days: int = 180) -> DataFrame:
    latest = F.broadcast(wh.latest_purchase())
    gone = F.count_if(F.datediff("latest", "last_purchase") > days)
    return (
        wh.buyers.crossJoin(latest)
        .agg(
            gone.alias("churned"),
            F.count(F.lit(1)).alias("total"),
            rounded(percent(gone, F.count(F.lit(1)))).alias("churn_pct"),
        )
    )


@query("q56_cohort_revenue")
def cohort_revenue(wh: Warehouse) -> DataFrame:
    return (
        wh.buyers.filter("spent is not null")
        .groupBy(as_timestamp(F.trunc("first_purchase", "MM")).alias("cohort_month"))
        .agg(
            F.count(F.lit(1)).alias("customers"),
            money("spent").alias("cohort_revenue"),
            rounded(mean("spent")).alias("avg_ltv"),
        )
        .orderBy("cohort_month")
    )


@query("q57_orders_first_90d")
def orders_in_first_days(wh: Warehouse, days: int = 90) -> DataFrame:
    """Counted on person-days, so the window per person is as long as the calendar at most."""
    daily = (
        wh.sales.filter("customer_unique_id is not null")
        .groupBy("customer_unique_id", "order_date")
        .agg(F.count(F.lit(1)).alias("orders"))
    )
    first_day = F.min("order_date").over(Window.partitionBy("customer_unique_id"))
    early = F.when(F.datediff("order_date", "first_day") <= days, F.col("orders")).otherwise(0)
    return (
        daily.withColumn("first_day", first_day)
        .agg(
            F.sum(early).alias("early"),
            F.count_if(F.col("order_date").eqNullSafe(F.col("first_day"))).alias("people"),
        )
        .select(
            rounded(F.try_divide(F.col("early").cast("double"), F.col("people").cast("double")), 3)
            .alias("avg_orders_first_90d")
        )
    )

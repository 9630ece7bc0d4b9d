"""Temporary views, so that any SQL over the star schema runs unchanged."""

from __future__ import annotations

from pyspark.sql import DataFrame

from mercato.plans import marts
from mercato.plans.registry import query
from mercato.plans.warehouse import Warehouse
from mercato.sources.readers import register_views


def register_star(wh: Warehouse, prefix: str = "") -> list[str]:
    """Register dimensions, facts and the three reusable views; returns their names.

    Give each warehouse of a session its own ``prefix``: temporary views share one name space.
    """
    frames = wh.star_tables() | {
        "vw_order_facts": marts.order_facts_view(wh),
        "vw_monthly_revenue": marts.monthly_revenue_view(wh),
        "vw_product_performance": marts.product_performance_view(wh),
    }
    named = {prefix + name: frame for name, frame in frames.items()}
    register_views(named)
    return list(named)


@query("star_views_sql")
def revenue_by_weekday_and_state(wh: Warehouse) -> DataFrame:
    """Plain SQL over the registered views."""
    register_star(wh)
    return wh.spark.sql(
        """
        select d.day_name, v.customer_state, count(*) as orders,
               cast(sum(cast(v.payment_value as decimal(22, 2))) as double) as revenue
        from vw_order_facts v
        join fact_orders o using (order_id)
        join dim_dates d on d.date_key = o.purchase_date_key
        group by all
        """
    )

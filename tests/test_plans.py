"""Physical plans: pruning, pushdown, limits before shuffles, no rows gathered in one task."""

from __future__ import annotations

import re

import pytest

from mercato.plans.registry import load_all

QUERIES = load_all()


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(wh):
    plan = plan_of(QUERIES["read_parquet"](wh).where("l_quantity >= 45"))
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThanOrEqual(l_quantity,45.0)]" in plan
    assert re.search(r"ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double>", plan)


def test_mart_queries_read_only_their_columns(wh):
    plan = plan_of(QUERIES["q04_state_revenue_top10"](wh))
    schema = re.search(r"ReadSchema: struct<(.*?)>", plan).group(1)
    columns = {c.split(":")[0] for c in schema.split(",") if ":" in c}
    assert columns == {"customer_unique_id", "customer_state", "payment_value"}
    assert "TakeOrderedAndProject" in plan and "Join" not in plan


@pytest.mark.parametrize(
    "name",
    [
        "q17_top3_products_per_category",
        "q24_best_product_per_state",
        "q33_second_larger_than_first",
        "q41_top5_orders_per_month",
        "q52_days_to_second",
        "q77_first_review_repeat",
        "q79_late_first_delivery",
        "dedupe",
        "distinct_on",
    ],
)
def test_ranked_groups_are_limited_before_the_shuffle(wh, name):
    plan = plan_of(QUERIES[name](wh))
    assert re.search(r"Exchange hashpartitioning[^\n]*\n[^\n]*WindowGroupLimit", plan), plan


@pytest.mark.parametrize(
    "name",
    ["q16_rank_customers_all", "q19_spend_quartiles", "q22_order_gap_all", "q59_rfm_scores_all", "q60_rfm_segments"],
)
def test_no_customer_or_order_window_in_a_single_task(wh, name):
    """A single partition may only hold bucket totals or one-row aggregates."""
    plan = plan_of(QUERIES[name](wh))
    for block in re.split(r"Exchange SinglePartition", plan)[1:]:
        following = block.split("\n")[1]
        assert "Aggregate" in following or "_bucket" in following, following


def test_no_python_in_any_plan(wh):
    for name in ("q49_cohort_retention_matrix", "q65_cross_sell_affinity", "holt_forecast", "q68_abc_summary"):
        plan = plan_of(QUERIES[name](wh))
        assert "Python" not in plan and "Pandas" not in plan
        assert "CartesianProduct" not in plan


def test_forecast_reads_its_series_once(wh):
    plan = plan_of(QUERIES["holt_forecast"](wh))
    assert plan.count("FileScan") == 1

"""Acquisition cohorts on a person-month table.

Input has one row per person and active month with ``cohort_month`` (the person's first
month), so counting persons is counting rows: no distinct count is needed anywhere.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from mercato.functions.columns import months_between_starts


def month_offset() -> Column:
    return months_between_starts("cohort_month", "order_month")


def cohort_matrix(months: DataFrame, measures: Mapping[str, Column], offset: str) -> DataFrame:
    """Aggregates per cohort month and number of months since it."""
    return months.groupBy("cohort_month", month_offset().alias(offset)).agg(
        *[column.alias(name) for name, column in measures.items()]
    )

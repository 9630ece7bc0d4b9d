"""Calendars: dense day and month spines, runs of consecutive periods."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from mercato.functions.columns import month_start


def _spine(df: DataFrame, first: Column, last: Column, step: str, name: str) -> DataFrame:
    bounds = df.agg(first.alias("first"), last.alias("last"))
    return bounds.select(F.explode(F.sequence("first", "last", F.expr(f"interval {step}"))).alias(name))


def day_spine(df: DataFrame, timestamp: str) -> DataFrame:
    """Every day between the smallest and the largest timestamp."""
    return _spine(
        df, F.to_date(F.min(timestamp)), F.to_date(F.max(timestamp)), "1 day", "day"
    )


def month_spine(df: DataFrame, timestamp: str) -> DataFrame:
    """The first day of every month between the smallest and the largest timestamp."""
    return _spine(
        df, month_start(F.min(timestamp)), month_start(F.max(timestamp)), "1 month", "month"
    )


def gaps_and_islands(df: DataFrame, groups: Sequence[str], period: Column) -> DataFrame:
    """Number runs of consecutive periods: within a run, period minus row number is constant.

    ``df`` holds one row per group and period, so a group is as long as the calendar at most.
    """
    window = Window.partitionBy(*(groups or [F.lit(1)])).orderBy(period)
    return df.withColumn("island", period - F.row_number().over(window))

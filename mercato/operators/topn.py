"""Leaderboards: top n overall, top n per group, shares of a total."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from mercato.functions.columns import percent, rounded

_RANKS = {"none": F.row_number, "ties": F.rank, "dense": F.dense_rank}


def top_n_per_group(
    df: DataFrame,
    groups: Sequence[str],
    order: Sequence[Column],
    n: int,
    ties: str = "none",
    name: str = "rn",
) -> DataFrame:
    """First n rows of every group. ``ties``: ``none`` (row number), ``ties`` (rank), ``dense``.

    The rank filter becomes a per-task limit before the shuffle, so a very large group sends
    at most n rows (and their ties) from each task.
    """
    window = Window.partitionBy(*groups).orderBy(*order)
    return df.withColumn(name, _RANKS[ties]().over(window)).filter(F.col(name) <= n)


def top(df: DataFrame, order: Sequence[Column], n: int | None, offset: int = 0) -> DataFrame:
    """Sorted rows, optionally one page of them."""
    ordered = df.orderBy(*order)
    if offset:
        ordered = ordered.offset(offset)
    return ordered if n is None else ordered.limit(n)


def top_by_metric(df: DataFrame, metric: str, n: int, label: str) -> DataFrame:
    return top(df, [F.col(metric).desc_nulls_last(), F.col(label).asc_nulls_last()], n)


def share_of_total(value: str, digits: int = 2, within: Sequence[str] = ()) -> Column:
    """Percentage of the (partition) total, for frames already aggregated to a few rows."""
    total = F.sum(value).over(Window.partitionBy(*within) if within else Window.partitionBy(F.lit(1)))
    return rounded(percent(F.col(value), total), digits)

"""Rolling figures over a daily table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from mercato.functions.columns import ratio

def _by_day() -> WindowSpec:
    """One row per day reaches this window, so its single task holds a calendar."""
    return Window.partitionBy(F.lit(1)).orderBy(F.asc_nulls_last("d"))


def rolling_mean(value: str, rows: int) -> Column:
    """Mean of this and the previous rows (days that have data)."""
    frame = _by_day().rowsBetween(1 - rows, 0)
    return ratio(F.sum(value).over(frame), F.count(value).over(frame))


def rolling_sum(value: str, rows: int) -> Column:
    return F.sum(value).over(_by_day().rowsBetween(1 - rows, 0))


def rolling_mean_calendar(value: str, days: int) -> Column:
    """Mean over the days of the last ``days`` calendar days that have data."""
    frame = Window.partitionBy(F.lit(1)).orderBy(F.datediff("d", F.lit("1970-01-01"))).rangeBetween(
        1 - days, 0
    )
    return ratio(F.sum(value).over(frame), F.count(value).over(frame))


def rolling_distinct(visits: DataFrame, who: str, day: str, days: int) -> DataFrame:
    """Distinct ``who`` within the last ``days`` calendar days, for every day with visits.

    A visit counts its visitor from that day until the day before the visitor's next visit, for
    ``days`` days at most. Each visit is therefore one +1 and one -1 on the calendar, and the
    figure is a running sum: no row is repeated per day of the window. The lead runs over
    the distinct days of one visitor.
    """
    seen = visits.select(who, F.col(day).alias("d")).where("d is not null").distinct()
    following = F.lead("d").over(Window.partitionBy(who).orderBy("d"))
    end = F.date_add("d", days)
    spans = seen.withColumn("next", following).select(
        "d", F.least(end, F.coalesce(F.col("next"), end)).alias("until")
    )
    changes = spans.select(
        F.explode(
            F.array(
                F.struct(F.col("d"), F.lit(1).alias("change"), F.lit(1).alias("visits")),
                F.struct(F.col("until").alias("d"), F.lit(-1).alias("change"), F.lit(0).alias("visits")),
            )
        ).alias("e")
    ).select("e.*")
    daily = changes.groupBy("d").agg(F.sum("change").alias("change"), F.sum("visits").alias("active"))
    return (
        daily.withColumn("distinct_active", F.sum("change").over(_by_day()))
        .filter("active > 0")
        .select("d", "active", "distinct_active")
    )

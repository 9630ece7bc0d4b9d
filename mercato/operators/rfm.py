"""Recency, frequency, monetary scoring and named segments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from mercato.operators import ordered


def rfm_metrics(
    buyers: DataFrame, latest: DataFrame, keep_unpaid: bool = False
) -> DataFrame:
    """One row per person: ``recency_days``, ``frequency``, ``monetary`` (exact).

    By default only persons with a payment count, measured on their paid orders. With
    ``keep_unpaid`` every order counts and ``monetary`` may be NULL.
    """
    people = buyers if keep_unpaid else buyers.filter("spent is not null")
    last = "last_purchase" if keep_unpaid else "last_paid_purchase"
    count = "orders" if keep_unpaid else "paid_orders"
    return people.crossJoin(F.broadcast(latest)).select(
        "customer_unique_id",
        F.datediff("latest", last).cast("bigint").alias("recency_days"),
        F.col(count).alias("frequency"),
        F.col("spent").alias("monetary"),
    )


def rfm_scores(metrics: DataFrame, tiles: int = 5) -> DataFrame:
    """Add ``r_score`` (recent is high), ``f_score`` and ``m_score``; ties go by person id."""
    person = F.col("customer_unique_id")
    tiled = ordered.ntiles(
        metrics,
        {
            "_r": (tiles, [F.col("recency_days"), person]),
            "f_score": (tiles, [F.col("frequency"), person]),
            "m_score": (tiles, [F.col("monetary"), person]),
        },
    )
    return tiled.withColumn("r_score", F.lit(tiles + 1) - F.col("_r")).drop("_r")


# Segment, recency scores from and to, least frequency score, least monetary score.
# The first segment that fits is taken; whoever fits none is hibernating.
SEGMENTS = (
    ("Champions", 4, 5, 4, 4),
    ("Loyal", 4, 5, 3, 1),
    ("New / Promising", 4, 5, 1, 1),
    ("Needs Attention", 3, 3, 1, 1),
    ("At Risk", 1, 2, 4, 1),
    ("Cannot Lose Them", 1, 2, 1, 4),
)
OTHERWISE = "Hibernating"
WIN_BACK_SEGMENTS = ("At Risk", "Cannot Lose Them")


def rfm_segment(segments: Sequence[tuple[str, int, int, int, int]] = SEGMENTS) -> Column:
    """Segment name of a scored person."""
    names = [
        F.when(
            F.col("r_score").between(low, high)
            & (F.col("f_score") >= frequency)
            & (F.col("m_score") >= monetary),
            F.lit(name),
        )
        for name, low, high, frequency, monetary in segments
    ]
    return F.coalesce(*names, F.lit(OTHERWISE))

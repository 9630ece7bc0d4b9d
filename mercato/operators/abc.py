"""ABC classes by cumulative share of a measure."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from mercato.operators import ordered


def abc_classes(
    df: DataFrame, item: str, value: str, a_share: float = 0.80, b_share: float = 0.95
) -> DataFrame:
    """Add ``running`` (cumulative value, largest first, equal values together), ``total``, ``abc_class``.

    ``df`` holds one row per item and should be materialised.
    """
    total = F.broadcast(df.agg(F.sum(value).alias("total")))
    with_running = ordered.tied(df, -F.col(value), [F.col(item)], {"running": F.col(value)})
    running = F.col("running_through").cast("double")
    whole = F.col("total").cast("double")
    return (
        with_running.crossJoin(total)
        .withColumn(
            "abc_class",
            F.when(running <= F.lit(a_share) * whole, "A")
            .when(running <= F.lit(b_share) * whole, "B")
            .otherwise("C"),
        )
        .withColumnRenamed("running_through", "running")
        .select(*df.columns, "running", "total", "abc_class")
    )

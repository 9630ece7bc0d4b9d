"""Forecasts for many monthly series at once.

A series is one key with one row per month. It is as long as the calendar, so the window and
the array of one series stay small however many rows the months summarise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from mercato.functions.columns import ratio, rounded


def trim_incomplete_tail(
    df: DataFrame, key: str, month: str, value: str, floor: float = 0.3, keep: int = 4
) -> DataFrame:
    """Drop trailing months that fall below ``floor`` times the mean of the three before them.

    Months are dropped from the end while that holds and more than ``keep`` remain. So the
    series ends at the last month for which it does not hold.
    """
    in_order = Window.partitionBy(key).orderBy(month)
    before = in_order.rowsBetween(-3, -1)
    number = F.row_number().over(in_order)
    earlier = ratio(F.sum(value).over(before), F.count(value).over(before))
    collapsed = (number > keep) & (earlier > 0) & (F.col(value).cast("double") < F.lit(floor) * earlier)
    marked = df.withColumns({"_n": number, "_collapsed": F.coalesce(collapsed, F.lit(False))})
    last = F.max(F.when(~F.col("_collapsed"), F.col("_n"))).over(Window.partitionBy(key))
    return (
        marked.withColumn("_last", last).filter("_n <= _last").drop("_n", "_collapsed", "_last")
    )


def _series(df: DataFrame, key: str, month: str, value: str) -> DataFrame:
    """One row per series: months and values as arrays in time order."""
    points = F.sort_array(F.collect_list(F.struct(F.col(month).alias("m"), F.col(value).cast("double").alias("v"))))
    return df.groupBy(key).agg(points.alias("_p")).select(
        key, F.col("_p.m").alias("_months"), F.col("_p.v").alias("_values")
    )


def _future_months(horizon: int) -> Column:
    """Position 0..h-1 and month label of the forecast steps."""
    last = F.element_at("_months", -1)
    return F.posexplode(
        F.transform(
            F.sequence(F.lit(1), F.lit(horizon)), lambda i: F.date_format(F.add_months(last, i), "yyyy-MM")
        )
    ).alias("_step", "period")


def moving_average_forecast(
    df: DataFrame, key: str, month: str, value: str, horizon: int = 3, width: int = 3
) -> DataFrame:
    """Mean of the last months, repeated over the horizon and never negative."""
    series = _series(df, key, month, value)
    n = F.least(F.lit(width), F.size("_values"))
    total = F.aggregate(F.slice("_values", -n, n), F.lit(0.0), lambda acc, v: acc + v)
    level = F.greatest(total / n.cast("double"), F.lit(0.0))
    return series.select(key, level.alias("_level"), _future_months(horizon)).select(
        key, "period", rounded("_level").alias("forecast_revenue")
    )


def _neighbours() -> Column:
    """The eight directions from a point."""
    steps = (-1.0, 0.0, 1.0)
    return F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x in steps for y in steps if x or y])


def holt_forecast(
    df: DataFrame,
    key: str,
    month: str,
    value: str,
    horizon: int = 3,
    grid: tuple[float, ...] = (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9),
    min_points: int = 6,
    first_step: float = 0.05,
    tolerance: float = 1e-3,
    rounds: int = 24,
    bounds: tuple[float, float] = (0.01, 0.99),
) -> DataFrame:
    """Additive-trend smoothing per series, with weights searched for the smallest squared error.

    The search is coarse to fine: the best pair of ``grid``, then in each round the best of its
    eight neighbours, ``first_step`` away to begin with; where none is better the step is
    halved, until it is below ``tolerance`` or ``rounds`` are over. So the error is never above that of the grid. Everything is folded over the series' array in one expression: the one shuffle is the
    one that gathers the series. Series shorter than ``min_points`` get the moving
    average and no weights. The result is never negative.
    """
    series = _series(df, key, month, value)
    first, second = F.element_at("_values", 1), F.element_at("_values", 2)
    rest = F.slice("_values", F.lit(2), F.size("_values") - 1)
    low, high = F.lit(bounds[0]), F.lit(bounds[1])

    def fold(a: Column, b: Column) -> Column:
        def step(state: Column, v: Column) -> Column:
            expected = state["level"] + state["trend"]
            level = a * v + (F.lit(1.0) - a) * expected
            trend = b * (level - state["level"]) + (F.lit(1.0) - b) * state["trend"]
            error = v - expected
            return F.struct(level.alias("level"), trend.alias("trend"), (state["sse"] + error * error).alias("sse"))

        start = F.struct(first.alias("level"), (second - first).alias("trend"), F.lit(0.0).alias("sse"))
        return F.aggregate(rest, start, step)

    def tried(a: Column, b: Column) -> Column:
        return F.struct(fold(a, b)["sse"].alias("sse"), a.alias("a"), b.alias("b"))

    pairs = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in grid for b in grid])
    coarse = F.array_min(F.transform(pairs, lambda p: tried(p["a"], p["b"])))

    def refine(state: Column, _: Column) -> Column:
        def near(o: Column) -> Column:
            moved = lambda at, by: F.least(F.greatest(at + by * state["h"], low), high)
            return tried(moved(state["a"], o["x"]), moved(state["b"], o["y"]))

        best = F.array_min(F.transform(_neighbours(), near))
        told = F.array(best)  # bound once: the folds behind it are the costly part
        moved = F.transform(
            told,
            lambda m: F.when(m["sse"] < state["sse"], F.struct(m["sse"].alias("sse"), m["a"].alias("a"), m["b"].alias("b"), state["h"].alias("h"))).otherwise(
                F.struct(state["sse"].alias("sse"), state["a"].alias("a"), state["b"].alias("b"), (state["h"] / 2).alias("h"))
            ),
        )
        return F.when(state["h"] < tolerance, state).otherwise(F.element_at(moved, 1))

    long = F.size("_values") >= min_points
    begun = series.withColumn("_coarse", F.when(long, coarse))
    start = F.struct(F.col("_coarse.sse").alias("sse"), F.col("_coarse.a").alias("a"), F.col("_coarse.b").alias("b"), F.lit(first_step).alias("h"))
    found = begun.withColumn("_w", F.when(long, F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, refine)))
    n = F.least(F.lit(3), F.size("_values"))
    mean = F.aggregate(F.slice("_values", -n, n), F.lit(0.0), lambda acc, v: acc + v) / n.cast("double")
    flat = F.struct(mean.alias("level"), F.lit(0.0).alias("trend"), F.lit(0.0).alias("sse"))
    fitted = found.withColumn("_fit", F.when(long, fold(F.col("_w.a"), F.col("_w.b"))).otherwise(flat))
    steps = fitted.select(key, F.col("_w.a").alias("alpha"), F.col("_w.b").alias("beta"), "_fit", "_months").select("*", _future_months(horizon))
    told = F.col("_fit.level") + (F.col("_step") + 1).cast("double") * F.col("_fit.trend")
    return steps.select(key, "period", rounded(F.greatest(told, F.lit(0.0))).alias("forecast_revenue"), "alpha", "beta")

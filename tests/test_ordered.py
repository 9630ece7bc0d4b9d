"""Globally ordered operators against plain windows, with ties, NULLs and large groups."""

from __future__ import annotations

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import Window as W, functions as F

from mercato.operators import ordered
from mercato.operators.abc import abc_classes
from mercato.session import materialise


@pytest.fixture(scope="module")
def values(spark):
    """Two thousand rows; one value holds a third of them, some are NULL."""
    df = spark.range(0, 2000, 1, 5).select(
        "id",
        F.when(F.col("id") % 3 == 0, F.lit(50))
        .when(F.col("id") % 97 == 0, F.lit(None))
        .otherwise((F.col("id") * 7919) % 211)
        .cast("int")
        .alias("v"),
        (F.col("id") % 2).alias("g"),
    )
    return materialise(df, "values")


@pytest.mark.parametrize("buckets", [1, 7])
@pytest.mark.parametrize("tiles", [3, 5, 10])
def test_ntile(values, buckets, tiles):
    order = [F.col("v"), F.col("id")]
    mine = ordered.ntiles(values, {"t": (tiles, order)}, buckets)
    plain = F.ntile(tiles).over(W.orderBy(F.col("v").asc_nulls_last(), "id"))
    assert mine.withColumn("p", plain).filter("t <> p").count() == 0
    assert mine.count() == 2000


def test_ntile_with_fewer_rows_than_tiles(spark):
    df = materialise(spark.createDataFrame([(3,), (1,)], "v int"), "few")
    assert sorted(map(tuple, ordered.ntiles(df, {"t": (5, [F.col("v")])}, 4).collect())) == [(1, 1), (3, 2)]


@pytest.mark.parametrize("buckets", [1, 6])
def test_row_numbers_descending(values, buckets):
    mine = ordered.row_numbers(values, [-F.col("v"), F.col("id")], "rn", buckets)
    plain = F.row_number().over(W.orderBy(F.col("v").desc_nulls_last(), "id"))
    assert mine.withColumn("p", plain).filter("rn <> p").count() == 0


@pytest.mark.parametrize("buckets", [1, 6])
def test_ranks(values, buckets):
    known = values.filter("v is not null")
    mine = ordered.ranks(known, F.col("v"), [F.col("id")], buckets)
    by_value, total = W.orderBy("v"), W.orderBy("v", "id")
    checked = mine.select(
        (F.col("row_number") == F.row_number().over(total)).alias("a"),
        (F.col("rank") == F.rank().over(by_value)).alias("b"),
        (F.col("dense_rank") == F.dense_rank().over(by_value)).alias("c"),
        (F.col("percent_rank") == F.percent_rank().over(by_value)).alias("d"),
        (F.col("cume_dist") == F.cume_dist().over(by_value)).alias("e"),
    )
    assert checked.filter("a and b and c and d and e").count() == known.count()


@pytest.mark.parametrize("buckets", [1, 6])
def test_running_sum_shares_ties(values, buckets):
    known = values.filter("v is not null")
    mine = ordered.tied(known, F.col("v"), [F.col("id")], {"s": F.col("id")}, buckets)
    plain = F.sum("id").over(W.orderBy("v"))
    assert mine.withColumn("p", plain).filter("s_through <> p").count() == 0
    assert mine.count() == known.count()


@pytest.mark.parametrize("buckets", [1, 9])
def test_lag_within_a_large_group(values, buckets):
    """Each group is spread over several buckets; the first row of a group has no predecessor."""
    mine = ordered.lag_within(values.drop("v"), "g", [F.col("id")], "id", "prev", buckets)
    plain = F.lag("id").over(W.partitionBy("g").orderBy("id"))
    assert mine.withColumn("p", plain).filter("not (prev <=> p)").count() == 0
    assert mine.filter("prev is null").count() == 2


def test_percentile(values):
    shares = [0.0, 0.1, 0.5, 0.9, 1.0]
    mine = ordered.percentile(values, "v", shares, [F.col("id")], 5)
    exact = values.select(F.percentile(F.col("v").cast("double"), F.array(*map(F.lit, shares)))).first()[0]
    assert mine == pytest.approx(exact, rel=1e-12)


def test_percentile_of_nothing(spark):
    assert ordered.percentile(spark.createDataFrame([], "v double"), "v", [0.5]) == [None]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 6), min_size=1, max_size=40), st.integers(2, 6))
def test_ntile_property(spark, numbers, tiles):
    frame = materialise(spark.createDataFrame(pd.DataFrame({"v": numbers, "id": range(len(numbers))})), "p")
    mine = ordered.ntiles(frame, {"t": (tiles, [F.col("v"), F.col("id")])}, 3)
    plain = F.ntile(tiles).over(W.orderBy("v", "id"))
    assert mine.withColumn("p", plain).filter("t <> p").count() == 0


def test_abc_classes(spark):
    df = materialise(
        spark.createDataFrame([("a", 70), ("b", 10), ("c", 10), ("d", 6), ("e", 4)], "item string, v int"),
        "abc",
    )
    classes = {r.item: (r.running, r.abc_class) for r in abc_classes(df, "item", "v").collect()}
    # Equal values share one running total.
    assert classes == {"a": (70, "A"), "b": (90, "B"), "c": (90, "B"), "d": (96, "C"), "e": (100, "C")}


def test_a_value_with_a_third_of_the_rows_fills_several_buckets(values):
    placed = ordered.place(values, [F.col("v"), F.col("id")], ["v"], 9)
    sizes = [r["count"] for r in placed.groupBy("_bucket").count().collect()]
    assert len(sizes) == 9 and max(sizes) < 2000 / 9 * 2
    assert placed.filter("v = 50").select("_bucket").distinct().count() >= 3


def test_small_buckets_keep_their_tasks(spark):
    placed = ordered.place(spark.range(8000), [F.col("id")], ["id"], buckets=8)
    assert ordered._together(placed).rdd.getNumPartitions() == 8

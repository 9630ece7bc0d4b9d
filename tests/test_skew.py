"""Salted joins: same rows as the plain join, spread over many tasks."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from mercato.operators.skew import gathered, hot_keys, salted_join
from mercato.plans.warehouse import orders_at_seller, orders_in_category
from tests.conftest import rows


@pytest.fixture(scope="module")
def sides(spark):
    """A third of the left rows hold key 0, some hold NULL, some have no partner."""
    left = spark.range(0, 30_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(0))
        .when(F.col("id") % 101 == 0, F.lit(None))
        .otherwise(F.col("id") % 2000)
        .alias("k"),
        "id",
    )
    right = spark.range(0, 1500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    return left, right


def test_the_hot_key_is_found(sides):
    assert 0 in hot_keys(sides[0], "k", fraction=0.1)
    assert len(hot_keys(sides[0], "k", share=0.2, fraction=0.1)) == 1


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("hot", [None, [], [0], [None], [0, None], [0, 17, 1999]])
def test_result_equals_the_plain_join(sides, how, hot):
    left, right = sides
    mine = salted_join(left, right, "k", ["id"], how, hot=hot).select("k", "id", "w")
    plain = left.join(right, "k", how).select("k", "id", "w")
    assert mine.count() == plain.count()
    assert mine.exceptAll(plain).isEmpty() and plain.exceptAll(mine).isEmpty()


def test_hot_rows_are_spread(spark, sides):
    left, right = sides
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        salted = salted_join(left, right, "k", ["id"], hot=[0])
        largest = salted.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        plain = left.join(right, "k").groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", 10 << 20)
        spark.conf.set("spark.sql.adaptive.enabled", True)
    assert plain > 10_000 and largest < plain / 2


def test_other_join_kinds_are_refused(sides):
    with pytest.raises(ValueError):
        salted_join(*sides, "k", ["id"], "full")


def test_adaptive_execution_splits_what_is_not_salted(spark, sides):
    """With thresholds lowered to this size, the skew-join rule splits the hot partition."""
    left, right = sides
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": -1,
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": 2000,
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": 1.5,
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": 2000,
    }
    for key, value in settings.items():
        spark.conf.set(key, str(value))
    try:
        joined = left.join(right, "k").groupBy("w").count()
        joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert "skew=true" in plan


def test_tiny_rows_helper(spark):
    assert rows(spark.createDataFrame([(2,), (1,)], "a int")) == [(1,), (2,)]


def test_no_hot_key_in_an_empty_or_tiny_table(spark):
    assert hot_keys(spark.createDataFrame([], "k int"), "k") == []
    assert hot_keys(spark.createDataFrame([(1,), (2,)], "k int"), "k", fraction=1.0) == []
    assert hot_keys(spark.createDataFrame([(1,), (1,)], "k int"), "k", fraction=1.0) == [1]
    assert hot_keys(spark.createDataFrame([(None,), (None,), (3,)], "k int"), "k", fraction=1.0) == [None]


def _totals(df):
    return df.groupBy("k").agg(F.count("*").alias("n"), F.count_distinct(F.col("id") % 7).alias("d"), F.sum("id").alias("s"))


@pytest.mark.parametrize("hot", [[], [0], [None], [0, None], None])
def test_gathered_totals_are_the_plain_ones(sides, hot):
    assert rows(gathered(sides[0], "k", _totals, hot)) == rows(_totals(sides[0]))


def test_a_distinct_count_of_gathered_rows_takes_one_shuffle(sides):
    def shuffles(df):
        return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")

    assert shuffles(_totals(sides[0])) == 2
    assert shuffles(gathered(sides[0], "k", _totals, [])) == 1


def test_marked_orders_are_counted_like_distinct_ones(spark):
    """Marks of the lines of order 9, which is hot, are missing; ``unknown`` is a name and a label."""
    lines = spark.createDataFrame(
        [
            (1, "a", "s", True, True, True),
            (1, "a", "t", True, False, True),
            (1, None, "s", False, True, False),
            (1, None, "s", True, False, False),
            (1, "unknown", "s", True, True, False),
            (2, "a", "s", True, True, True),
            (None, "a", "s", True, False, False),
            (9, "a", "s", True, None, None),
            (9, "a", "s", True, None, None),
            (9, None, None, True, None, None),
        ],
        "order_id int, category string, seller_id string, known_product boolean, new_in_category boolean, new_at_seller boolean",
    )
    distinct = F.count_distinct("order_id").alias("n")
    label = F.coalesce("category", F.lit("unknown"))
    for frame, group, counted in (
        (lines, F.col("category"), orders_in_category()),
        (lines, label, orders_in_category()),
        (lines.filter("known_product"), F.col("category"), orders_in_category()),
        (lines, F.col("seller_id"), orders_at_seller()),
    ):
        found = frame.groupBy(group.alias("g")).agg(counted.alias("n"))
        assert rows(found) == rows(frame.groupBy(group.alias("g")).agg(distinct))


def test_one_line_is_marked_per_order_and_category_or_seller(wh):
    for mark, column in (("new_in_category", "category"), ("new_at_seller", "seller_id")):
        lines = wh.lines.filter(F.col(mark).isNotNull()).groupBy("order_id", column)
        assert lines.agg(F.count_if(mark).alias("n")).filter("n != 1").count() == 0

"""Leaderboards, calendars, rolling figures, affinity, forecasts and changes against brute force."""

from __future__ import annotations

import itertools
import random
from collections import Counter, defaultdict
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from mercato.functions.columns import (
    bands,
    cents_to_units,
    elapsed_days,
    months_between_starts,
    rounded,
)
from mercato.operators.affinity import pair_counts
from mercato.operators.changes import UnknownKeysError, cancel_orders, change_audit
from mercato.operators.forecast import (
    holt_forecast,
    moving_average_forecast,
    trim_incomplete_tail,
)
from mercato.operators.rolling import rolling_distinct
from mercato.operators.spine import gaps_and_islands, month_spine
from mercato.operators.topn import top_n_per_group
from tests.conftest import rows


def test_rounding_is_half_away_from_zero_on_the_binary_value(spark):
    df = spark.createDataFrame([(2.5,), (-2.5,), (0.125,), (-0.125,), (1.005,)], "x double")
    got = [(r.a, r.b) for r in df.select(rounded("x", 0).alias("a"), rounded("x").alias("b")).collect()]
    assert got == [(3.0, 2.5), (-3.0, -2.5), (0.0, 0.13), (-0.0, -0.13), (1.0, 1.0)]
    assert df.limit(1).select(cents_to_units(F.lit(12345)).alias("u")).first().u == 123.45


def test_calendar_arithmetic(spark):
    df = spark.createDataFrame(
        [(datetime(2020, 1, 31, 23), datetime(2020, 2, 1, 1)), (datetime(2020, 1, 1, 12), datetime(2020, 1, 3, 11))],
        "a timestamp_ntz, b timestamp_ntz",
    )
    assert rows(df.select(months_between_starts("a", "b"), F.datediff("b", "a"), elapsed_days("a", "b"))) == [
        (0, 2, 1),
        (1, 1, 0),
    ]


def test_calendar_arithmetic_ignores_the_session_zone(spark):
    """Half past two does not exist on that night in New York; plain clock values do not care."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame(
            [(datetime(2021, 3, 14, 2, 30), datetime(2021, 3, 15, 2, 30))], "a timestamp_ntz, b timestamp_ntz"
        )
        assert df.select(elapsed_days("a", "b").alias("d")).first().d == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_bands(spark):
    df = spark.createDataFrame([(5,), (10,), (99,)], "v int")
    tier = bands(F.col("v"), [(10.0, "low"), (50.0, "mid")], "top")
    assert [r.t for r in df.select(tier.alias("t")).collect()] == ["low", "mid", "top"]


def test_top_n_ties(spark):
    df = spark.createDataFrame([("a", 3), ("a", 3), ("a", 2), ("a", 1), (None, 1)], "g string, v int")
    by_value = [F.desc("v")]
    assert top_n_per_group(df, ["g"], by_value, 1).count() == 2
    assert top_n_per_group(df, ["g"], by_value, 1, "ties").count() == 3
    assert top_n_per_group(df, ["g"], by_value, 2, "dense").count() == 4


def test_month_spine_and_islands(spark):
    df = spark.createDataFrame([(datetime(2020, 1, 31),), (datetime(2020, 4, 2),)], "t timestamp_ntz")
    assert [r.month.month for r in month_spine(df, "t").collect()] == [1, 2, 3, 4]
    periods = spark.createDataFrame([("x", 1), ("x", 2), ("x", 5), ("y", 2)], "g string, p int")
    islands = gaps_and_islands(periods, ["g"], F.col("p")).groupBy("g", "island").count()
    assert rows(islands, "g", "count") == [("x", 1), ("x", 2), ("y", 1)]


def test_rolling_distinct(spark):
    start = date(2020, 1, 1)
    visits = [(i * i % 7, start + timedelta(days=(i * 13) % 40)) for i in range(60)]
    got = rolling_distinct(spark.createDataFrame(visits, "who int, day date"), "who", "day", 5)
    expected = [
        (
            day,
            len({w for w, d in visits if d == day}),
            len({w for w, d in visits if day - timedelta(days=5) < d <= day}),
        )
        for day in sorted({d for _, d in visits})
    ]
    assert sorted(map(tuple, got.collect())) == expected


def test_pair_counts(spark):
    bought = [(i % 9, "abcde"[(i * i + i // 9) % 5]) for i in range(80)]
    got = pair_counts(spark.createDataFrame(bought, "who int, label string"), "who", "label", "n")
    sets = defaultdict(set)
    for who, label in bought:
        sets[who].add(label)
    expected = Counter(p for s in sets.values() for p in itertools.combinations(sorted(s), 2))
    assert {(r.label_a, r.label_b): r.n for r in got.collect()} == expected


def _series(spark, **series):
    data = [
        (key, date(2020 + i // 12, i % 12 + 1, 1), float(v))
        for key, values in series.items()
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(data, "k string, m date, v double")


def _trim(values):
    while len(values) > 4:
        before = sum(values[-4:-1]) / 3
        if before > 0 and values[-1] < 0.3 * before:
            values = values[:-1]
        else:
            break
    return values


SERIES = {
    "two_weak": [10, 11, 12, 13, 14, 3, 1],
    "fine": [10, 11, 12, 13, 14],
    "all_weak": [100, 1, 1, 1, 0.1, 0.01],
    "inner_dip": [10, 10, 10, 10, 1, 10],
    "short": [9, 0],
    "zeros": [0, 0, 0, 0, 0, 0],
}


def test_trim_incomplete_tail(spark):
    got = trim_incomplete_tail(_series(spark, **SERIES), "k", "m", "v")
    kept = {r.k: r["count"] for r in got.groupBy("k").count().collect()}
    assert kept == {k: len(_trim(v)) for k, v in SERIES.items()}


def test_moving_average_forecast(spark):
    got = moving_average_forecast(_series(spark, a=[1, 2, 3, 7], b=[5], c=[-9, -9, -9]), "k", "m", "v", 2)
    assert rows(got) == [
        ("a", "2020-05", 4.0),
        ("a", "2020-06", 4.0),
        ("b", "2020-02", 5.0),
        ("b", "2020-03", 5.0),
        ("c", "2020-04", 0.0),
        ("c", "2020-05", 0.0),
    ]


def _holt_fold(values, a, b):
    level, trend, sse = values[0], values[1] - values[0], 0.0
    for v in values[1:]:
        expected = level + trend
        new = a * v + (1 - a) * expected
        trend = b * (new - level) + (1 - b) * trend
        level, sse = new, sse + (v - expected) ** 2
    return sse, level, trend


def _holt(values, horizon):
    """The same search, written as loops."""
    best = min((_holt_fold(values, i / 10, j / 10)[0], i / 10, j / 10) for i in range(1, 10) for j in range(1, 10))
    h = 0.05
    for _ in range(24):
        if h < 1e-3:
            break
        near = [(min(max(best[1] + x * h, 0.01), 0.99), min(max(best[2] + y * h, 0.01), 0.99)) for x in (-1, 0, 1) for y in (-1, 0, 1) if x or y]
        found = min((_holt_fold(values, a, b)[0], a, b) for a, b in near)
        if found[0] < best[0]:
            best = found
        else:
            h /= 2
    _, level, trend = _holt_fold(values, *best[1:])
    return [max(level + h * trend, 0.0) for h in range(1, horizon + 1)], best


def test_holt_forecast(spark):
    rng = random.Random(8)
    series = {
        "up": [10.0, 12, 13, 15, 16, 19, 20, 23],
        "down": [50.0, 30, 20, 10, 5, 2, 1],
        "flat": [4.0] * 9,
        "noise": [rng.uniform(0, 100) for _ in range(60)],
        "steps": [float(10 * (i // 7)) for i in range(40)],
        "short": [1.0, 2, 3],
        "one": [6.0],
    }
    frame = holt_forecast(_series(spark, **series), "k", "m", "v", 4)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan
    got, weights = defaultdict(dict), {}
    for r in frame.collect():
        got[r.k][r.period] = r.forecast_revenue
        weights[r.k] = (r.alpha, r.beta)
    for key in ("up", "down", "flat", "noise", "steps"):
        told, (sse, a, b) = _holt(series[key], 4)
        assert [got[key][p] for p in sorted(got[key])] == pytest.approx(told, abs=0.006)
        assert weights[key] == pytest.approx((a, b), abs=1e-9)
        grid = min(_holt_fold(series[key], i / 10, j / 10)[0] for i in range(1, 10) for j in range(1, 10))
        assert sse <= grid
    assert set(got["short"].values()) == {2.0} and set(got["one"].values()) == {6.0}
    assert weights["short"] == weights["one"] == (None, None)
    assert min(got["down"].values()) >= 0



def test_change_audit(spark):
    old = spark.createDataFrame([(1, 5), (2, None), (3, 4), (4, 1)], "id int, score int")
    new = spark.createDataFrame([(1, 5), (2, 3), (3, None), (9, 1)], "id int, score int")
    audit = change_audit(old, new, "id", "score", datetime(2020, 1, 1))
    assert rows(audit, "id", "old_value", "new_value") == [(2, None, 3), (3, 4, None)]
    again = change_audit(old, new, "id", "score", datetime(2020, 1, 1))
    assert rows(audit) == rows(again)


def test_cancel_orders(spark, tiny):
    ids = spark.createDataFrame([("o1",), ("o1",)], "order_id string")
    updated = cancel_orders(tiny.fact_orders, ids)
    assert rows(updated, "order_id", "order_status") == [
        ("o1", "canceled"),
        ("o2", "delivered"),
        ("o3", "shipped"),
    ]
    ghost = spark.createDataFrame([("ghost",)], "order_id string")
    with pytest.raises(UnknownKeysError, match="ghost"):
        cancel_orders(tiny.fact_orders, ghost)

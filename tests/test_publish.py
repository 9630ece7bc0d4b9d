"""Versioned tables, marts that grow by months, ranged audits and the load plan."""

from __future__ import annotations

import os
from datetime import date, datetime

import duckdb
import pytest
from pyspark.sql import functions as F

from mercato.operators.changes import RangedSnapshot, change_audit, change_audit_ranged
from mercato.operators.months import Measure, MonthlyState
from mercato.plans.marts import buyer_state
from mercato.sources import publish as publishing
from mercato.sources.publish import PublishError, current_version, publish, read_published
from mercato.sources.sinks import LoadStep, load_plan, swap_statements, unmatched
from mercato.specs import CATALOG, Field, table
from tests.conftest import rows
from tests.test_paging import rows_read


def numbers(spark, n):
    return spark.range(n).withColumnRenamed("id", "v")


def test_a_new_version_replaces_the_old_one(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(PublishError, match="nothing is published"):
        read_published(spark, path)
    first = publish(numbers(spark, 3), path)
    early = read_published(spark, path)
    second = publish(numbers(spark, 5), path)
    assert current_version(spark, path) == second != first
    assert read_published(spark, path).count() == 5
    assert early.count() == 3  # a reader that began with the old version finishes with it
    third = publish(numbers(spark, 0), path)
    assert read_published(spark, path).count() == 0
    assert sorted(os.listdir(f"{path}/versions")) == [second, third]
    assert [f for f in os.listdir(path) if f.startswith("_current") and not f.endswith(".crc")] == ["_current"]


def test_nothing_changes_when_a_run_is_lost_before_the_switch(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    old = publish(numbers(spark, 3), path)

    def lost(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(publishing, "_switch", lost)
        with pytest.raises(KeyboardInterrupt):
            publish(numbers(spark, 9), path)
    assert current_version(spark, path) == old and read_published(spark, path).count() == 3
    publish(numbers(spark, 4), path)
    publish(numbers(spark, 6), path, keep=1)
    assert read_published(spark, path).count() == 6
    assert len(os.listdir(f"{path}/versions")) == 1  # what the lost run left is gone


def test_a_broken_write_leaves_the_old_version(spark, tmp_path):
    path = str(tmp_path / "t")
    publish(numbers(spark, 3), path)
    bad = numbers(spark, 10).withColumn("w", F.expr("if(v = 7, raise_error('lost'), v)"))
    with pytest.raises(Exception, match="lost"):
        publish(bad, path)
    assert read_published(spark, path).count() == 3


def test_a_version_that_fails_its_check_is_not_seen(spark, tmp_path):
    path = str(tmp_path / "t")
    publish(numbers(spark, 3), path, check=lambda made: made.count() == 3)
    with pytest.raises(PublishError, match="did not pass"):
        publish(numbers(spark, 2), path, check=lambda made: made.count() == 3)
    assert read_published(spark, path).count() == 3


def test_rows_that_get_lost_are_noticed(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    publish(numbers(spark, 3), path)
    verify = publishing._verify
    monkeypatch.setattr(publishing, "_verify", lambda s, folder, n, check: verify(s, folder, n + 1, check))
    with pytest.raises(PublishError, match="4 rows were written, 3 are there"):
        publish(numbers(spark, 3), path)


# ---- monthly states -------------------------------------------------------------------------------

MEASURES = [
    Measure("n", "count", "true"),
    Measure("big", "count", "v > 5"),
    Measure("total", "sum", "v"),
    Measure("least", "min", "v"),
    Measure("most", "max", "v"),
]


def files_of(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def sales_of(spark, months):
    data = [(m, f"p{(m or date(2000, 1, 1)).month * i % 7}", None if i % 5 == 0 else i) for m in months for i in range(40)]
    return spark.createDataFrame(data, "month date, person string, v int")


def whole_figures(frame, *by):
    return rows(frame.groupBy(*by).agg(F.count("*").alias("n"), F.count_if(F.col("v") > 5).alias("big"), F.sum("v").alias("total"), F.min("v").alias("least"), F.max("v").alias("most")))


def test_a_new_month_rewrites_only_its_partition(spark, tmp_path):
    months = [date(2020, m, 1) for m in range(1, 7)] + [None]
    every = sales_of(spark, months)
    state = MonthlyState(spark, str(tmp_path / "s"), "month", ["person"], MEASURES)
    state.put(every.filter("month is null or month < date'2020-06-01'"))
    before = files_of(state.path)
    state.put(every.filter("month = date'2020-06-01'"))
    added = files_of(state.path) - before
    assert before <= files_of(state.path) and added and all("month=2020-06-01" in f for f in added)
    assert rows(state.merged()) == whole_figures(every, "person")
    assert rows(state.merged("month")) == whole_figures(every, "month")
    late = every.filter("month >= date'2020-04-01'")
    recent = state.merged(since=date(2020, 4, 1))
    assert rows(recent) == whole_figures(late, "person")
    assert "PartitionFilters: [isnotnull(month" in recent._jdf.queryExecution().executedPlan().toString()


def test_a_month_given_again_is_replaced(spark, tmp_path):
    every = sales_of(spark, [date(2020, 1, 1), date(2020, 2, 1)])
    state = MonthlyState(spark, str(tmp_path / "s"), "month", ["person"], MEASURES)
    state.put(every)
    mended = every.filter("month = date'2020-02-01'").withColumn("v", F.col("v") * 2)
    state.put(mended)
    assert rows(state.merged()) == whole_figures(every.filter("month = date'2020-01-01'").unionByName(mended), "person")
    other = MonthlyState(spark, state.path, "month", ["person"], MEASURES)  # another session's view of it
    assert rows(other.merged()) == rows(state.merged())


def test_figures_that_cannot_be_merged_are_refused():
    with pytest.raises(ValueError, match="cannot be merged"):
        Measure("m", "median", "v")


def test_buyers_from_months_equal_the_mart(wh, tmp_path):
    state = buyer_state(wh, str(tmp_path / "buyers"))
    state.put(wh.sales.filter("customer_unique_id is not null"))
    columns = wh.buyers.columns
    assert rows(state.merged().select(columns)) == rows(wh.buyers)


# ---- audits by ranges -------------------------------------------------------------------------------


def test_one_changed_row_reads_one_range(spark, tmp_path):
    old = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") % 9).cast("int").alias("a"), F.lit("x").alias("b"))
    new = old.withColumn("a", F.when(F.col("k") == 4321, 77).otherwise(F.col("a"))).repartition(3)
    x, y = (RangedSnapshot.store(df, str(tmp_path / n), "k", 64) for n, df in (("x", old), ("y", new)))
    assert len(x.differing(y, "a")) == 1 and x.differing(y, "b") == []
    audit = change_audit_ranged(x, y, "a", datetime(2020, 1, 1))
    assert rows(audit, "k", "old_value", "new_value") == [(4321, 1, 77)]
    inside = old.filter(F.pmod(F.xxhash64("k"), F.lit(64)) == x.differing(y, "a")[0]).count()
    assert rows_read(x.within(x.differing(y, "a"))) == inside < 200
    plan = audit._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(_range") >= 2
    assert change_audit_ranged(x, y, "b").collect() == []


def test_ranged_audit_equals_the_plain_one(spark, tmp_path):
    data = [(i, None if i % 11 == 0 else i % 5) for i in range(400)]
    old = spark.createDataFrame(data + [(None, 3), (900, 1)], "k int, a int")
    changed = [(k, None if k % 50 == 3 else 0 if a is None and k % 2 else a) for k, a in data]
    new = spark.createDataFrame(changed + [(None, 4), (901, 2)], "k int, a int")
    x, y = (RangedSnapshot.store(df, str(tmp_path / n), "k", 16) for n, df in (("x", old), ("y", new)))
    stamp = datetime(2020, 1, 1)
    assert rows(change_audit_ranged(x, y, "a", stamp)) == rows(change_audit(old, new, "k", "a", stamp)) != []


def test_checksums_do_not_depend_on_the_order_of_rows(spark, tmp_path):
    df = spark.range(300).select(F.col("id").alias("k"), (F.col("id") % 7).alias("a"))
    twice = [RangedSnapshot.store(f, str(tmp_path / n), "k", 8) for n, f in (("x", df), ("y", df.orderBy(F.desc("a")).repartition(5)))]
    assert twice[0].differing(twice[1], "a") == []
    doubled = RangedSnapshot.store(df.union(df).union(df), str(tmp_path / "z"), "k", 8)
    assert len(twice[0].differing(doubled, "a")) == 8  # repeated rows do not cancel out


# ---- loads ------------------------------------------------------------------------------------------


def test_load_plan_puts_parents_first():
    steps = load_plan(list(reversed(CATALOG.values())), {n: [f.name for f in t] for n, t in CATALOG.items()}, "shop")
    order = [s.table for s in steps]
    assert len(order) == 9
    for name, t in CATALOG.items():
        for f in t:
            if f.refers_to:
                assert order.index(f"shop.{f.refers_to.split('.')[0]}") < order.index(f"shop.{name}")
    statements = swap_statements(steps)
    assert statements[:9] == [f"DELETE FROM {t}" for t in reversed(order)]
    assert statements[9].startswith(f"INSERT INTO {order[0]} (")
    circle = [table("a", Field("x", refers_to="b.x")), table("b", Field("x", refers_to="a.x"))]
    with pytest.raises(ValueError, match="circle"):
        load_plan(circle, {"a": ["x"], "b": ["x"]})


def test_load_statements_can_be_repeated_and_leave_other_tables():
    """The statements alone, in the memory of this process."""
    specs = [table("child", Field("id"), Field("p", refers_to="parent.id")), table("parent", Field("id"))]
    steps = load_plan(specs, {"child": ["id", "p"], "parent": ["id"]})
    db = duckdb.connect()
    db.execute("create table parent(id int); create table child(id int, p int); create table other as select 1 as id")
    db.execute("insert into parent values (9); insert into child values (9, 9)")
    for _ in range(2):
        db.execute("create or replace table load_parent as select unnest([1, 2]) as id")
        db.execute("create or replace table load_child as select 2 as p, 5 as id")
        db.begin()
        for text in swap_statements(steps):
            db.execute(text)
        db.commit()
        assert db.sql("from parent order by id").fetchall() == [(1,), (2,)]
        assert db.sql("from child").fetchall() == [(5, 2)] and db.sql("from other").fetchall() == [(1,)]
    assert isinstance(steps[0], LoadStep) and steps[0].table == "parent"


def test_reconciliation():
    assert unmatched({"a": 3, "b": 0}, {"a": 3, "b": 0}) == {}
    assert unmatched({"a": 3, "b": 1}, {"a": 2}) == {"a": (3, 2), "b": (1, None)}

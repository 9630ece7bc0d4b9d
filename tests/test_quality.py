"""Checks, fault injection and the gate."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from mercato.operators import quality
from mercato.plans.run import build_warehouse, store_enriched_orders
from mercato.specs import CATALOG, spec_of
from tests.conftest import RAW, rows, write_csv


def tables_of(spark, ingested, **replaced):
    out, _ = ingested
    frames = {t: spark.read.parquet(f"{out}/{t}.parquet") for t in CATALOG} | replaced
    return {name: (lambda f=frame: f) for name, frame in frames.items() if frame is not None}


def failed(report):
    return {(r.table_name, r.check_name): r.violations for r in report.filter("not passed").collect()}


def test_clean_data_passes_all_41_checks(spark, ingested):
    report = quality.validate(spark, tables_of(spark, ingested), list(CATALOG.values()))
    assert failed(report) == {}
    assert tuple(quality.summary(report).first()) == (41, 41, 0)
    quality.quality_gate(report)


def test_orphan_item_fails_its_reference_and_the_gate(spark, ingested):
    items = tables_of(spark, ingested)["order_items"]()
    ghost = items.limit(1).withColumns({"order_id": F.lit("GHOST"), "order_item_id": F.lit(99)})
    tables = tables_of(spark, ingested, order_items=items.unionByName(ghost))
    report = quality.validate(spark, tables, [spec_of("order_items")])
    assert failed(report) == {("order_items", "fk[order_id->orders.order_id]"): 1}
    with pytest.raises(quality.QualityError, match="order_items.fk"):
        quality.quality_gate(report)


def test_missing_parent_and_missing_key_column_fail(spark, ingested):
    tables = tables_of(spark, ingested, sellers=None)
    report = quality.validate(spark, tables, [spec_of("order_items")])
    assert set(failed(report)) == {("order_items", "fk[seller_id->sellers.seller_id]")}
    no_key = tables["orders"]().drop("order_id")
    check = quality.check_pk_unique(no_key, "orders", ["order_id"]).first()
    assert check.check_name == "pk_present[order_id]" and not check.passed


def test_faults_are_counted(spark):
    df = spark.createDataFrame(
        [("a", -1.0, 6, "lost"), ("a", 2.0, 3, "delivered"), (None, None, 0, None), (None, 1.0, 5, "delivered")],
        "order_id string, price double, review_score int, order_status string",
    )
    rules = (
        quality.not_null_rules(["order_id", "price"])
        | quality.non_negative_rules(["price"])
        | quality.between_rules({"review_score": (1, 5)})
        | quality.accepted_rules({"order_status": ("delivered",)})
    )
    counted = {r.check_name: r.violations for r in quality.check_columns(df, "t", rules).collect()}
    assert counted == {
        "not_null[order_id]": 2,
        "not_null[price]": 1,
        "non_negative[price]": 1,
        "between[review_score]": 2,
        "accepted_values[order_status]": 1,
    }
    # NULL keys equal each other.
    assert quality.check_pk_unique(df, "t", ["order_id"]).first().violations == 2


def test_timestamp_type_and_singular(spark, ingested):
    orders = tables_of(spark, ingested)["orders"]()
    broken = orders.withColumn("order_approved_at", F.col("order_approved_at").cast("string"))
    results = {r[1]: r[2] for r in quality.timestamp_types(broken, "orders", spec_of("orders").named(type="timestamp"))}
    assert [c for c, ok in results.items() if not ok] == ["timestamp_type[order_approved_at]"]
    bad = quality.check_singular(orders, "orders", "none_shipped", F.col("order_status") == "shipped")
    assert rows(bad, "passed", "violations") == [(False, 1)]


def test_suite_holds_the_contract():
    suite = quality.suite(spec_of("order_reviews"), contract=True)
    assert suite["between"] == {"review_score": (1, 5)}
    assert suite["unique"] == ["review_id"] and suite["not_null"] == ["review_id", "order_id"]
    assert quality.suite(spec_of("order_reviews"))["between"] == {}


def test_pipeline_checks_before_it_builds(spark, raw_dir, tmp_path):
    wh, reports = build_warehouse(spark, raw_dir, str(tmp_path / "good"))
    assert len(reports) == 9 and wh.sales.count() == 3
    path = store_enriched_orders(wh, str(tmp_path / "enriched"))
    assert spark.read.parquet(path).filter("purchase_month = 2").count() == 2

    bad = tmp_path / "bad"
    bad.mkdir()
    for table, content in RAW.items():
        extra = [("o9", "1", "p1", "s1", "2018-01-08", "-1.0", "0")] if table == "order_items" else []
        write_csv(bad, table, [*content, *extra])
    with pytest.raises(quality.QualityError) as failure:
        build_warehouse(spark, str(bad), str(tmp_path / "worse"))
    assert "non_negative[price]: 1" in str(failure.value)
    assert "fk[order_id->orders.order_id]: 1" in str(failure.value)


def test_one_scan_per_table(spark, wh):
    """Nine tables make nine scans of files at most, whatever the number of their checks."""
    from mercato.plans.checks import validation_report

    def scans(frame):
        return frame._jdf.queryExecution().executedPlan().toString().count("FileScan")

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        single = sum(scans(wh.source(t)) for t in CATALOG)
        report = validation_report(wh)
        plan = report._jdf.queryExecution().executedPlan().toString()
        assert 9 <= plan.count("FileScan") <= single
        own = sum(wh.source(t)._jdf.queryExecution().executedPlan().toString().count("Exchange") for t in CATALOG)
        # One for all keys, one for their totals, and what meets the names of the checks.
        assert plan.count("Exchange") <= own + 5
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_all_checks_equal_the_single_ones(spark):
    """Random tables with NULLs, repeated and composite keys, and orphans."""
    import random

    random.seed(4)
    pick = lambda n: random.choice([None, *range(n)])
    parent = spark.createDataFrame([(pick(9), pick(3), random.choice([-1.0, 2.0, None])) for _ in range(40)], "a int, b int, v double")
    child = spark.createDataFrame([(pick(14), f"{pick(2)}") for _ in range(60)], "a long, c string")
    rules = quality.not_null_rules(["a", "b"]) | quality.non_negative_rules(["v"])
    subjects = [
        quality.Subject("child", child, {}, ["a", "c"], {"a": "parent.a", "c": "other.c"}),
        quality.Subject("parent", parent, rules, ["a", "b"], {"a": "child.a", "b": "absent.b"}),
        quality.Subject("keyless", parent, {}, ["zz"], {}),
    ]
    other = child.limit(3)
    got = {(r.table_name, r.check_name): (r.passed, r.violations) for r in quality.check_all(spark, subjects, {"other": lambda: other}).collect()}
    single = [
        quality.check_columns(parent, "parent", rules),
        quality.check_pk_unique(parent, "parent", ["a", "b"]),
        quality.check_pk_unique(child, "child", ["a", "c"]),
        quality.check_pk_unique(parent, "keyless", ["zz"]),
        quality.check_fk(child, "child", "a", parent, "parent.a"),
        quality.check_fk(child, "child", "c", other, "other.c"),
        quality.check_fk(parent, "parent", "a", child, "child.a"),
        quality.check_fk(parent, "parent", "b", None, "absent.b"),
    ]
    want = {(r.table_name, r.check_name): (r.passed, r.violations) for part in single for r in part.collect()}
    assert got == want and any(not p for p, _ in got.values()) and any(p for p, _ in got.values())


def test_no_subjects(spark):
    assert quality.check_all(spark, []).collect() == []

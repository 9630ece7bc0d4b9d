"""Pages against slices of the sorted list, point lookups, and what both read."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from mercato.operators.paging import Order, Pages
from mercato.plans.reports import customer_by_id, order_by_id, order_list, search_customers
from mercato.plans.pipelines import customer_rfm, AS_OF
from mercato.session import materialise
from tests.test_plans import plan_of


def rows_read(frame) -> int:
    """Rows that the scans of a collected frame gave out."""
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


@pytest.fixture(scope="module")
def ranked(spark):
    random.seed(2)
    rows = [(i, random.choice([None, *range(40)]), random.choice(["a", "é", "z", None])) for i in range(3000)]
    order = [Order("score", descending=True), Order("name"), Order("id")]

    def key(r):
        return (r[1] is None, -(r[1] or 0), r[2] is None, r[2] or "", r[0])

    frame = spark.createDataFrame(rows, "id int, score int, name string").repartition(5)
    return Pages(frame, order, 7), sorted(rows, key=key)


@pytest.mark.parametrize("offset,n", [(0, 10), (0, 3000), (5, 0), (428, 3), (1234, 500), (2990, 50), (3000, 5), (9999, 5)])
def test_page_equals_a_slice(ranked, offset, n):
    pages, rows = ranked
    assert [tuple(r) for r in pages.page(offset, n).collect()] == rows[offset : offset + n]


@pytest.mark.parametrize("place", [0, 1, 427, 428, 429, 1500, 2700, 2998, 2999])
@pytest.mark.parametrize("n", [1, 40, 700])
def test_next_page_by_the_last_row(ranked, place, n):
    pages, rows = ranked
    i, score, name = rows[place]
    assert [tuple(r) for r in pages.after([score, name, i], n).collect()] == rows[place + 1 : place + 1 + n]


def test_next_page_of_a_row_that_is_gone(ranked):
    pages, rows = ranked
    want = [r for r in rows if r[1] is None or r[1] < 20][:15]
    assert [tuple(r) for r in pages.after([20, None, 10**6], 15).collect()] == want


def test_no_rows(spark):
    pages = Pages(spark.createDataFrame([], "a int"), [Order("a")])
    assert pages.page(0, 5).collect() == pages.after([3], 5).collect() == [] and pages.total == 0


def test_a_deep_page_reads_two_buckets_at_most(spark):
    """Offset of a million: whole buckets are pruned as partitions, and pages of files by row number."""
    pages = Pages(spark.range(1_200_000).select((F.col("id") * 7919 % 1_200_007).alias("v")), [Order("v")], 24)
    page = pages.page(1_000_000, 100)
    read = set(re.findall(r"_bucket=(\d+)", " ".join(page.inputFiles())))
    plan = plan_of(page)
    assert "PartitionFilters: [isnotnull(_bucket" in plan and "TakeOrderedAndProject" in plan
    assert [r.v for r in page.collect()] == sorted(i * 7919 % 1_200_007 for i in range(1_200_000))[1_000_000:1_000_100]
    selected = [b for b in pages.buckets if b.before < 1_000_100 and b.before + b.rows > 1_000_000]
    assert len(selected) <= 2 and len(read) >= len(selected)
    assert rows_read(pages.page(1_000_000, 100)) <= sum(b.rows for b in selected)
    last = page.collect()[-1].v
    assert rows_read(pages.after([last], 100)) <= 2 * max(b.rows for b in pages.buckets)


def test_deep_and_shallow_pages_agree(wh):
    for offset in (0, 37, 900):
        shallow = order_list(wh, "delivered", 25, offset).collect()
        assert order_list(wh, "delivered", 25, offset, deep=0).collect() == shallow
    assert search_customers(wh, limit=9, offset=31, deep=0).collect() == search_customers(wh, limit=9, offset=31).collect()


def test_a_lookup_reads_under_a_hundredth(spark):
    """Shuffled ids over eight files: a Bloom filter skips files, page bounds skip the rest."""
    n = 800_000
    frame = spark.range(n).select((F.col("id") * 104_729 % 999_983).alias("k"), F.col("id").alias("v")).repartition(8)
    stored = materialise(frame, "lookup-test", lookup="k")
    found = stored.filter(F.col("k") == 104_729 * 12_345 % 999_983)
    assert [r.v for r in found.collect()] == [12_345]
    assert rows_read(found) < n / 100
    none = stored.filter(F.col("k") == 999_990)
    assert none.collect() == [] and rows_read(none) == 0


def test_point_queries_push_their_key(wh):
    assert "EqualTo(order_id,42)" in plan_of(order_by_id(wh, 42))
    assert "EqualTo(customer_unique_id,7)" in plan_of(customer_rfm(wh, AS_OF, 7))
    plan = plan_of(customer_by_id(wh, 7))
    assert "EqualTo(customer_id,7)" in plan and "Exchange" not in plan and "Join" not in plan

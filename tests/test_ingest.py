"""Reading, cleaning, deduplication, row accounting and sinks."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F, types as T

from mercato.operators.clean import (
    clean_strings,
    coerce_numeric,
    coerce_timestamps,
    dedupe,
    distinct_on,
)
from mercato.plans.ingest import ingest_table
from mercato.plans.pipelines import export_raw
from mercato.sources.readers import read_csv, register_staging
from mercato.sources.sinks import export_csv, refresh_snapshot, write_partitioned
from mercato.specs import CATALOG, spec_of, table as table_of
from tests.conftest import RAW, rows, write_csv


def test_every_parent_is_a_known_earlier_table_and_column():
    seen = []
    for name, spec in CATALOG.items():
        for target in (f.refers_to for f in spec if f.refers_to):
            table, column = target.split(".")
            assert table in seen and column in CATALOG[table].named(in_key=True)
        seen.append(name)
    assert len(seen) == 9


def test_unknown_table_is_an_error(spark, raw_dir, tmp_path):
    with pytest.raises(KeyError):
        ingest_table(spark, "nope", raw_dir, str(tmp_path))


def test_all_tables_are_written_with_row_accounting(spark, ingested):
    out, reports = ingested
    by_name = {r.table: r for r in reports}
    assert set(by_name) == set(CATALOG)
    customers = by_name["customers"]
    assert (customers.rows_in, customers.rows_out) == (4, 3)
    assert (customers.duplicates_removed, customers.rows_dropped) == (1, 1)
    for table in CATALOG:
        assert spark.read.parquet(f"{out}/{table}.parquet").count() == by_name[table].rows_out


def test_types_and_blanks(spark, ingested):
    out, _ = ingested
    orders = spark.read.parquet(f"{out}/orders.parquet")
    for column in spec_of("orders").named(type="timestamp"):
        assert isinstance(orders.schema[column].dataType, T.TimestampNTZType)
    o3 = orders.filter("order_id = 'o3'").first()
    assert o3.order_delivered_customer_date is None and o3.order_delivered_carrier_date is None


def test_partitioned_ingest_keeps_all_rows(spark, raw_dir, tmp_path):
    report = ingest_table(spark, "orders", raw_dir, str(tmp_path), partitioned=True)
    read = spark.read.parquet(report.path)
    assert report.rows_out == 3
    assert rows(read, "purchase_year", "purchase_month", "order_id") == [
        (2018, 1, "o1"),
        (2018, 2, "o2"),
        (2018, 2, "o3"),
    ]


def test_hard_csv_cells(spark, tmp_path):
    """Line breaks and doubled quotes inside fields, reordered columns, padded and bad cells."""
    table = [
        ("review_score", "review_id", "order_id", "comment", "review_creation_date", "review_answer_timestamp"),
        ("5", " r1 ", "o1", 'line one\nline "two"', "2018-01-11", "never"),
        ("five", "r2", "o1", "  ", "2018-13-45", "2018-01-12 10:00:00"),
        ("five", "r2", "o1", "  ", "2018-13-45", "2018-01-12 10:00:00"),
    ]
    write_csv(tmp_path, "order_reviews", table)
    raw = read_csv(spark, str(tmp_path / "order_reviews.csv"))
    assert raw.count() == 3
    spec = spec_of("order_reviews")
    cleaned = dedupe(coerce_numeric(coerce_timestamps(clean_strings(raw), spec), spec), spec)
    got = {r.review_id: r for r in cleaned.collect()}
    assert set(got) == {"r1", "r2"}
    assert got["r1"].comment == 'line one\nline "two"' and got["r1"].review_score == 5.0
    assert got["r1"].review_answer_timestamp is None
    assert got["r2"].comment is None and got["r2"].review_score is None
    assert got["r2"].review_creation_date is None
    assert got["r2"].review_answer_timestamp == datetime(2018, 1, 12, 10)


def test_leading_zeros_survive_reading(spark, tmp_path):
    write_csv(tmp_path, "sellers", [RAW["sellers"][0], ("s9", "01234", "x", "SP")])
    assert read_csv(spark, str(tmp_path / "sellers.csv")).first().seller_zip_code_prefix == "01234"


def test_distinct_on_takes_the_first_in_order(spark):
    df = spark.createDataFrame(
        [("a", 2, "x"), ("a", 1, "y"), ("a", 1, "b"), ("b", None, "z"), (None, 1, "n"), (None, 0, "n")],
        "k string, v int, w string",
    )
    assert rows(distinct_on(df, ["k"])) == rows(
        spark.createDataFrame([("a", 1, "b"), ("b", None, "z"), (None, 0, "n")], df.schema)
    )
    assert ("a", 2, "x") in rows(distinct_on(df, ["k"], [F.desc("v")]))


def test_one_key_with_most_rows_is_reduced_before_the_shuffle(spark):
    df = spark.range(0, 20_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    result = distinct_on(df, ["k"])
    plan = result._jdf.queryExecution().executedPlan().toString()
    before_exchange = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in before_exchange
    assert result.count() == 20_000 - 6_667 + 1
    assert result.filter("k = -1").first().v == 0


def test_dedupe_without_a_key_drops_exact_copies_only(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b")], "x int, y string")
    assert rows(dedupe(df, table_of("t", "x", "y"))) == [(1, "a"), (1, "b")]


def test_partitioned_write_replaces_only_its_own_partitions(spark, tmp_path):
    path = str(tmp_path / "p")
    first = spark.createDataFrame([(1, 2020), (2, 2021)], "v int, y int")
    write_partitioned(first, path, ["y"])
    write_partitioned(spark.createDataFrame([(9, 2021)], "v int, y int"), path, ["y"], replace="present")
    assert rows(spark.read.parquet(path), "v", "y") == [(1, 2020), (9, 2021)]


def test_csv_export_and_snapshot(spark, tmp_path):
    df = spark.createDataFrame([(1, 'say "hi"'), (2, None)], "a int, b string")
    path = export_csv(df, str(tmp_path / "csv"), single_file=True)
    back = read_csv(spark, path)
    assert rows(back) == [("1", 'say "hi"'), ("2", None)]
    snapshot = refresh_snapshot(df, str(tmp_path / "snap"))
    snapshot = refresh_snapshot(df.limit(1), str(tmp_path / "snap"))
    stored = spark.read.parquet(snapshot)
    assert stored.count() == 1 and stored.filter("refreshed_at is null").count() == 0


def test_staging_views(spark, ingested, tmp_path):
    out, _ = ingested
    assert len(register_staging(spark, out)) == 9
    assert spark.table("stg_orders").count() == 3
    with pytest.raises(AnalysisException):
        register_staging(spark, str(tmp_path))


def test_ingesting_again_replaces_the_whole_table(spark, raw_dir, tmp_path):
    ingest_table(spark, "orders", raw_dir, str(tmp_path / "out"), partitioned=True)
    fewer = tmp_path / "fewer"
    fewer.mkdir()
    write_csv(fewer, "orders", RAW["orders"][:1] + RAW["orders"][2:3])
    report = ingest_table(spark, "orders", str(fewer), str(tmp_path / "out"), partitioned=True)
    assert (report.rows_in, report.rows_out, report.duplicates_removed) == (1, 1, 0)
    assert rows(spark.read.parquet(report.path), "order_id") == [("o2",)]


def test_files_with_different_headers_are_an_error(spark, tmp_path):
    folder = tmp_path / "sellers.csv"
    folder.mkdir()
    write_csv(folder, "a", [RAW["sellers"][0], RAW["sellers"][1]])
    head = RAW["sellers"][0]
    write_csv(folder, "b", [(head[1], head[0], *head[2:]), ("2002", "s2", "x", "SP")])
    with pytest.raises(Exception, match="CSV header"):
        read_csv(spark, str(folder), multi_line=False).collect()


def test_only_reviews_are_read_whole(spark):
    assert [name for name, spec in CATALOG.items() if spec.multi_line] == ["order_reviews"]


def test_a_large_month_is_written_by_several_tasks(spark, tmp_path):
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "64k")
    try:
        df = spark.range(200_000).select("id", F.when(F.col("id") % 10 == 0, 1).otherwise(2).alias("m"))
        path = write_partitioned(df, str(tmp_path / "p"), ["m"])
    finally:
        spark.conf.unset(size)
    assert len(list((tmp_path / "p" / "m=2").glob("*.parquet"))) > 1
    assert spark.read.parquet(path).count() == 200_000


def test_raw_exports_are_compressed_and_read_alike(spark, wh):
    """The raw files are most of what an ingestion run writes."""
    folder = export_raw(wh, "orders", "orders")
    files = [f.split("/")[-1] for f in spark.read.text(f"{folder}/orders.csv").inputFiles()]
    assert files and all(f.endswith(".csv.gz") for f in files)
    assert read_csv(spark, f"{folder}/orders.csv", multi_line=False).count() == wh.source("orders").count()

"""Shared session, a tiny raw data set with known results, and warehouses over both."""

from __future__ import annotations

import csv
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from mercato.plans.ingest import ingest_all  # noqa: E402
from mercato.plans.warehouse import Warehouse, open_warehouse  # noqa: E402
from mercato.session import get_spark  # noqa: E402
from mercato.specs import CATALOG  # noqa: E402

DATA = "/root/testdata/sf0.001"

# Rows as a raw export holds them, with a repeated customer and blank delivery dates.
RAW = {
    "customers": [
        ("customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"),
        ("c1", "u1", "1001", "sao paulo", "SP"),
        ("c2", "u2", "1002", "rio", "RJ"),
        ("c3", "u3", "1003", "bh", "MG"),
        ("c3", "u3", "1003", "bh", "MG"),
    ],
    "sellers": [
        ("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"),
        ("s1", "2001", "campinas", "SP"),
        ("s2", "2002", "curitiba", "PR"),
    ],
    "products": [
        (
            "product_id",
            "product_category_name",
            "product_name_lenght",
            "product_description_lenght",
            "product_photos_qty",
            "product_weight_g",
            "product_length_cm",
            "product_height_cm",
            "product_width_cm",
        ),
        ("p1", "moveis", "40", "200", "1", "500", "20", "10", "15"),
        ("p2", "eletronicos", "50", "300", "2", "1500", "30", "15", "20"),
    ],
    "product_category_translation": [
        ("product_category_name", "product_category_name_english"),
        ("moveis", "furniture"),
        ("eletronicos", "electronics"),
    ],
    "geolocation": [
        (
            "geolocation_zip_code_prefix",
            "geolocation_lat",
            "geolocation_lng",
            "geolocation_city",
            "geolocation_state",
        ),
        ("1001", "-23.5", "-46.6", "sao paulo", "SP"),
        ("1002", "-22.9", "-43.2", "rio", "RJ"),
        ("1003", "-19.9", "-43.9", "bh", "MG"),
    ],
    "orders": [
        (
            "order_id",
            "customer_id",
            "order_status",
            "order_purchase_timestamp",
            "order_approved_at",
            "order_delivered_carrier_date",
            "order_delivered_customer_date",
            "order_estimated_delivery_date",
        ),
        ("o1", "c1", "delivered", "2018-01-05 10:00:00", "2018-01-05 10:15:00", "2018-01-06 08:00:00", "2018-01-10 16:00:00", "2018-01-12 00:00:00"),
        ("o2", "c2", "delivered", "2018-02-10 14:30:00", "2018-02-10 15:00:00", "2018-02-11 08:00:00", "2018-02-15 12:00:00", "2018-02-20 00:00:00"),
        ("o3", "c3", "shipped", "2018-02-11 09:00:00", "2018-02-11 09:20:00", "", "", "2018-02-25 00:00:00"),
    ],
    "order_items": [
        ("order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price", "freight_value"),
        ("o1", "1", "p1", "s1", "2018-01-08", "100.0", "10.0"),
        ("o1", "2", "p2", "s2", "2018-01-08", "50.0", "5.0"),
        ("o2", "1", "p1", "s1", "2018-02-13", "100.0", "10.0"),
        ("o3", "1", "p2", "s2", "2018-02-14", "200.0", "20.0"),
    ],
    "order_payments": [
        ("order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"),
        ("o1", "1", "credit_card", "3", "165.0"),
        ("o2", "1", "boleto", "1", "110.0"),
        ("o3", "1", "credit_card", "2", "220.0"),
    ],
    "order_reviews": [
        ("review_id", "order_id", "review_score", "review_creation_date", "review_answer_timestamp"),
        ("r1", "o1", "5", "2018-01-11", "2018-01-12 10:00:00"),
        ("r2", "o2", "4", "2018-02-16", "2018-02-17 11:00:00"),
        ("r3", "o3", "3", "2018-02-20", "2018-02-21 09:00:00"),
    ],
}


def write_csv(folder, table: str, rows) -> None:
    with open(os.path.join(folder, f"{table}.csv"), "w", newline="") as f:
        csv.writer(f).writerows(rows)


@pytest.fixture(scope="session")
def spark():
    session = get_spark(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": 8,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.sql.warehouse.dir": "/tmp/mercato-tests-warehouse",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def raw_dir(tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    for table, rows in RAW.items():
        write_csv(folder, table, rows)
    return str(folder)


@pytest.fixture(scope="session")
def ingested(spark, raw_dir, tmp_path_factory):
    """Output folder and reports of a full ingestion of the tiny data set."""
    out = str(tmp_path_factory.mktemp("processed"))
    return out, ingest_all(spark, raw_dir, out)


@pytest.fixture(scope="session")
def tiny(spark, ingested):
    out, _ = ingested
    frames = {t: spark.read.parquet(f"{out}/{t}.parquet") for t in CATALOG}
    return Warehouse.from_frames(spark, frames)


@pytest.fixture(scope="session")
def wh(spark):
    return open_warehouse(spark, DATA)


def rows(df, *columns):
    """Rows as a set-like sorted list of tuples."""
    frame = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in frame.collect()), key=repr)

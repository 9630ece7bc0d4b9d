"""The whole pipeline: raw files to a checked warehouse."""

from __future__ import annotations

from pyspark.sql import SparkSession

from mercato.operators.quality import quality_gate, validate
from mercato.plans.ingest import IngestReport, ingest_all
from mercato.plans.marts import orders_enriched
from mercato.plans.warehouse import Warehouse
from mercato.session import materialise
from mercato.sources.readers import read_table
from mercato.sources.sinks import write_partitioned
from mercato.specs import CATALOG


def build_warehouse(
    spark: SparkSession,
    raw_dir: str,
    processed_dir: str,
    file_name: str = "{table}.csv",
) -> tuple[Warehouse, list[IngestReport]]:
    """Ingest, check, and only then shape: a failed check raises before any mart is built."""
    reports = ingest_all(spark, raw_dir, processed_dir, file_name=file_name)
    frames = {table: read_table(spark, table, processed_dir) for table in CATALOG}
    tables = {table: (lambda f=frame: f) for table, frame in frames.items()}
    quality_gate(materialise(validate(spark, tables, list(CATALOG.values())), "quality"))
    return Warehouse.from_frames(spark, frames), reports


def store_enriched_orders(wh: Warehouse, path: str) -> str:
    """The wide order fact, partitioned by purchase year and month."""
    return write_partitioned(orders_enriched(wh), path, ["purchase_year", "purchase_month"])

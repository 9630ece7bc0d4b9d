"""Raw CSV to cleaned Parquet, with row accounting."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from mercato.operators.clean import augment_date_parts, clean
from mercato.sources.readers import read_csv
from mercato.sources.sinks import write_parquet, write_partitioned
from mercato.specs import CATALOG, spec_of

# Tables stored by year and month of purchase.
PARTITIONED = {"orders": ("purchase_year", "purchase_month")}


@dataclass(frozen=True)
class IngestReport:
    table: str
    rows_in: int
    rows_out: int
    path: str

    @property
    def duplicates_removed(self) -> int:
        """Cleaning drops rows for no other reason."""
        return self.rows_in - self.rows_out

    @property
    def rows_dropped(self) -> int:
        return self.rows_in - self.rows_out


def ingest_table(
    spark: SparkSession,
    table: str,
    raw_dir: str,
    out_dir: str,
    partitioned: bool = False,
    file_name: str = "{table}.csv",
) -> IngestReport:
    """Clean one table and write it in place of the old one. ``file_name`` is the pattern of the
    raw files' names. Only a table whose cells may hold line breaks is read whole by one task.

    Rows are counted from the raw files and from the written footers. A counter inside the
    write would be cheaper, but repeats rows when an executor is lost and its task runs again.
    """
    spec = spec_of(table)
    raw = read_csv(spark, f"{raw_dir.rstrip('/')}/{file_name.format(table=table)}", spec.multi_line)
    path = f"{out_dir.rstrip('/')}/{table}.parquet"
    cleaned = clean(raw, spec)
    if partitioned and table in PARTITIONED:
        write_partitioned(augment_date_parts(cleaned), path, PARTITIONED[table])
    else:
        write_parquet(cleaned, path)
    return IngestReport(table, raw.count(), spark.read.parquet(path).count(), path)


def ingest_all(
    spark: SparkSession,
    raw_dir: str,
    out_dir: str,
    tables: Iterable[str] = tuple(CATALOG),
    partitioned: bool = False,
    file_name: str = "{table}.csv",
) -> list[IngestReport]:
    return [
        ingest_table(spark, table, raw_dir, out_dir, partitioned, file_name)
        for table in tables
    ]


def report_frame(spark: SparkSession, reports: list[IngestReport]) -> DataFrame:
    rows = [
        (r.table, r.rows_in, r.rows_out, r.duplicates_removed, r.rows_dropped) for r in reports
    ]
    return spark.createDataFrame(
        rows,
        "table_name string, rows_in bigint, rows_out bigint,"
        " duplicates_removed bigint, rows_dropped bigint",
    )

"""Reading raw and processed tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, DataFrameReader, SparkSession

from mercato.specs import CATALOG


def read_csv(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Raw table as text columns named by the header.

    Quotes are escaped by doubling and fields may span lines. No types are inferred, so only
    the header is read ahead, and no digit of a code is lost before cleaning. A file of
    ``path`` whose header differs from the first one's is an error when it is read, because
    columns are found by their place. A multi-line file is read by one task; pass
    ``multi_line=False`` for tables without line breaks in their fields (the catalog knows
    which), and large files are split among tasks.
    """

    def reader() -> DataFrameReader:
        return (
            spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')
        )

    names = reader().csv(path).schema
    return reader().schema(names).option("enforceSchema", False).csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet file or a partitioned folder (partition columns are discovered)."""
    return spark.read.parquet(path)


def read_table(
    spark: SparkSession, table: str, base_dir: str, template: str = "{base_dir}/{table}.parquet"
) -> DataFrame:
    """Table at a path built from a template; the folder can be overridden per environment."""
    return read_parquet(spark, template.format(base_dir=base_dir.rstrip("/"), table=table))


def register_staging(
    spark: SparkSession,
    base_dir: str,
    tables: Iterable[str] = tuple(CATALOG),
    prefix: str = "stg_",
    template: str = "{base_dir}/{table}.parquet",
) -> list[str]:
    """Register each table as a temporary view. A missing path raises ``AnalysisException``."""
    names = []
    for table in tables:
        read_table(spark, table, base_dir, template).createOrReplaceTempView(prefix + table)
        names.append(prefix + table)
    return names


def register_views(frames: Mapping[str, DataFrame]) -> None:
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)

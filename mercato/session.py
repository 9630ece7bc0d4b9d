"""Spark session, shared folder and materialisation helpers."""

from __future__ import annotations

import tempfile
import uuid
import warnings

from pyspark.sql import DataFrame, SparkSession


def get_spark(app_name: str = "mercato", master: str | None = None, **conf: object) -> SparkSession:
    """Session with the settings the library expects; extra settings are passed as keywords."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings: dict[str, object] = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.parquet.compression.codec": "snappy",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach.

    It is the one named in ``spark.checkpoint.dir``. A local session without it gets a
    temporary folder; a cluster session without it is an error, because a folder on one
    machine would be lost with that machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        local = spark.sparkContext.master.startswith("local")
        if not local and (configured.startswith("file:") or "://" not in configured):
            warnings.warn(
                f"spark.checkpoint.dir is {configured}: without a scheme, or with file:, it is shared"
                " only if every executor mounts the same folder there",
                stacklevel=2,
            )
        return configured.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="mercato-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/mercato/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


def drop_staged(spark: SparkSession) -> None:
    """Delete everything this application has staged in the shared folder."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(
        f"{shared_dir(spark)}/mercato/{spark.sparkContext.applicationId}"
    )
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


# Rows of a Parquet page in tables that are looked up by key: what one lookup reads.
LOOKUP_PAGE_ROWS = 1000


def materialise(df: DataFrame, name: str, lookup: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage durably (an executor loss re-reads files instead of recomputing) and
    keeps the columnar layout, so later readers prune columns and push filters.

    With ``lookup`` each file is sorted by that column and has a Bloom filter for it: a filter on one
    value then skips the files without it and reads a page or two of the others. No row is
    moved for that.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write
    if lookup:
        writer = df.sortWithinPartitions(lookup).write.options(
            **{
                f"parquet.bloom.filter.enabled#{lookup}": "true",
                "parquet.bloom.filter.adaptive.enabled": "true",
                "parquet.page.row.count.limit": str(LOOKUP_PAGE_ROWS),
            }
        )
    writer.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)

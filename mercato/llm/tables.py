"""Reading the tables, staging between steps, joins that know the size of their sides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from mercato.session import scratch_path

# A side is broadcast only if it has been counted and has at most this many rows.
BROADCAST_ROWS = 400_000


# Batches that go to Python hold at most so many bytes (or one row), whatever rows hold.
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Written once to the shared folder and read back, so a lost executor costs one read."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back.staged_at = path
    return back


def stage_kinds(df: DataFrame, name: str, column: str, kinds: tuple[int, ...]) -> list[DataFrame]:
    """One staged table per value of ``column``, from one pass over ``df``."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.partitionBy(column).parquet(path)
    out = []
    for kind in kinds:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{column}={kind}")
        there = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(folder)
        schema = df.drop(column).schema
        back = spark.read.schema(schema).parquet(folder.toString()) if there else spark.createDataFrame([], schema)
        back.staged_at = folder.toString()
        out.append(back)
    return out


def drop(*staged: DataFrame) -> None:
    """Delete staged tables that nothing reads any more, because what came of them is staged too."""
    for df in staged:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.staged_at)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def fold(column: str = "doc_id", parts: int = 1) -> Column:
    """The fold of a row: crc32 of the id as text modulo ``parts`` (null counts as empty text)."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % parts


def attach(big: DataFrame, small: DataFrame, on: list[str], how: str = "left", rows: int | None = None) -> DataFrame:
    """Join a staged side: broadcast while it is small by count, shuffled beyond that."""
    counted = small.count() if rows is None else rows
    return big.join(F.broadcast(small) if counted <= BROADCAST_ROWS else small, on, how)

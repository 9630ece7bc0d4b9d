"""Comparing snapshots and applying batch updates."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F


class UnknownKeysError(Exception):
    """Raised for ids that do not exist; ``missing`` is a DataFrame of all of them."""

    def __init__(self, message: str, missing: DataFrame) -> None:
        super().__init__(message)
        self.missing = missing


def change_audit(
    old: DataFrame, new: DataFrame, key: str, column: str, changed_at: datetime | None = None
) -> DataFrame:
    """Keys present in both snapshots whose value differs; NULL and a value do differ.

    One audit row per changed key. ``audit_id`` is a hash of the key and both values, so a
    rerun gives the same ids.
    """
    stamp = F.lit(changed_at).cast("timestamp_ntz") if changed_at else F.localtimestamp()
    before = old.select(key, F.col(column).alias("old_value"))
    after = new.select(key, F.col(column).alias("new_value"))
    return (
        before.join(after, key)
        .filter(~F.col("old_value").eqNullSafe(F.col("new_value")))
        .select(
            F.xxhash64(key, "old_value", "new_value").alias("audit_id"),
            key,
            "old_value",
            "new_value",
            stamp.alias("changed_at"),
        )
    )


class RangedSnapshot:
    """A snapshot stored by ranges of its key's hash, with checksums of every column per range.

    The checksum of a column in a range is its number of rows, and the sum and the exclusive or of
    the hashes of (key, value): the order of rows does not matter. Two snapshots with the same ranges can
    be compared by their checksums, which are ``ranges`` rows, before a row is read.
    """

    def __init__(self, spark: SparkSession, path: str, key: str) -> None:
        self.key = key
        self.rows = spark.read.parquet(f"{path}/rows")
        self.sums = spark.read.parquet(f"{path}/sums")

    @classmethod
    def store(cls, df: DataFrame, path: str, key: str, ranges: int = 1024) -> RangedSnapshot:
        spark, path = df.sparkSession, path.rstrip("/")
        placed = df.withColumn("_range", F.pmod(F.xxhash64(key), F.lit(ranges)).cast("int"))
        placed.hint("rebalance", "_range").write.mode("overwrite").partitionBy("_range").parquet(f"{path}/rows")
        stored = spark.read.schema(placed.schema).parquet(f"{path}/rows")
        told = []
        for c in df.columns:
            value = F.xxhash64(key, F.col(c).isNull(), c)
            total = F.sum(value.cast("decimal(38,0)")).cast("string")
            told.append(F.struct(F.count(F.lit(1)), total, F.bit_xor(value)).alias(c))
        stored.groupBy("_range").agg(*told).write.mode("overwrite").parquet(f"{path}/sums")
        return cls(spark, path, key)

    def differing(self, other: RangedSnapshot, column: str) -> list[int]:
        """Ranges whose checksums of the column differ, or that one side lacks; at most ``ranges`` numbers."""
        mine = self.sums.select("_range", F.col(column).alias("_mine"))
        theirs = other.sums.select("_range", F.col(column).alias("_theirs"))
        unlike = mine.join(theirs, "_range", "full").filter(~F.col("_mine").eqNullSafe(F.col("_theirs")))
        return sorted(r["_range"] for r in unlike.select("_range").collect())

    def within(self, ranges: Sequence[int]) -> DataFrame:
        return self.rows.filter(F.col("_range").isin(list(ranges))).drop("_range")


def change_audit_ranged(
    old: RangedSnapshot, new: RangedSnapshot, column: str, changed_at: datetime | None = None
) -> DataFrame:
    """``change_audit`` of two stored snapshots that reads only the ranges that differ.

    Equal ranges hold no changed key, because a key has the same range in both. Both must have been
    stored with the same number of ranges.
    """
    ranges = old.differing(new, column)
    return change_audit(old.within(ranges), new.within(ranges), old.key, column, changed_at)


def unknown_keys(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return ids.select(key).distinct().join(df.select(key), key, "left_anti")


def cancel_orders(orders: DataFrame, ids: DataFrame, status: str = "canceled") -> DataFrame:
    """Orders with the given ids set to canceled; an unknown id is an error and nothing changes.

    Write the result to a new path and swap it in, so readers see all updates or none.
    """
    missing = unknown_keys(orders, ids, "order_id")
    count = missing.count()
    if count:
        first = [r.order_id for r in missing.orderBy("order_id").take(5)]
        raise UnknownKeysError(f"{count} orders not found, the first ones: {first}", missing)
    marked = ids.select("order_id").distinct().withColumn("_cancel", F.lit(True))
    updated = F.when(F.col("_cancel"), F.lit(status)).otherwise(F.col("order_status"))
    return (
        orders.join(marked, "order_id", "left")
        .withColumn("order_status", updated)
        .select(*orders.columns)
    )

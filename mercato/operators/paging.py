"""Pages of a long sorted list: by number of rows to skip, or from the last row seen.

``offset(n).limit(m)`` sorts n + m rows into one task, so deep pages cost as much as the list. Here
rows are range-partitioned on the order once, numbered inside their bucket and stored with the
bucket as a partition of the table. One row of figures per bucket (size and first key) is all the
driver keeps. A page then reads the one or two buckets that it lies in, and the rows' numbers skip
row groups inside them.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence
from dataclasses import dataclass
from functools import cmp_to_key, reduce

from pyspark.sql import Column, DataFrame, functions as F

from mercato.session import scratch_path

_ROW_BITS = 33  # monotonically_increasing_id keeps the row within its partition in the low 33 bits


@dataclass(frozen=True)
class Order:
    """A column of the order. NULLs come last in either direction."""

    column: str
    descending: bool = False

    def sort(self) -> Column:
        column = F.col(self.column)
        return column.desc_nulls_last() if self.descending else column.asc_nulls_last()

    def compare(self, a: object, b: object) -> int:
        if a is None or b is None:
            return (a is None) - (b is None)
        return ((a > b) - (a < b)) * (-1 if self.descending else 1)

    def beyond(self, value: object) -> Column:
        """Rows that come after those with this value."""
        column = F.col(self.column)
        if value is None:
            return F.lit(False)
        later = column < F.lit(value) if self.descending else column > F.lit(value)
        return column.isNull() | later


@dataclass(frozen=True)
class Bucket:
    number: int
    before: int  # rows in earlier buckets
    rows: int
    first: tuple


class Pages:
    """A frame in a total order, stored for paging. The last order column tells all rows apart."""

    def __init__(self, frame: DataFrame, order: Sequence[Order], buckets: int | None = None) -> None:
        self.order, self.columns = tuple(order), frame.columns
        spark = frame.sparkSession
        names = [o.column for o in self.order]
        sort = [o.sort() for o in self.order]
        ranged = frame.repartitionByRange(*([buckets] if buckets else []), *sort)
        path = scratch_path(spark, "pages")
        placed = ranged.withColumn("_bucket", F.spark_partition_id()).sortWithinPartitions("_bucket", *sort)
        row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
        placed.withColumn("_row", row).write.partitionBy("_bucket").parquet(path)
        schema = placed.drop("_bucket").withColumn("_row", row).schema.add("_bucket", "integer")
        self.stored = spark.read.schema(schema).parquet(path)
        found = self.stored.groupBy("_bucket").agg(
            F.count(F.lit(1)).alias("rows"), *[F.min_by(n, "_row").alias(f"k{i}") for i, n in enumerate(names)]
        )
        self.buckets: list[Bucket] = []
        before = 0
        for r in sorted(found.collect(), key=lambda r: r["_bucket"]):  # one row per bucket
            self.buckets.append(Bucket(r["_bucket"], before, r["rows"], tuple(r[f"k{i}"] for i in range(len(names)))))
            before += r["rows"]
        self.total = before

    def page(self, offset: int, n: int) -> DataFrame:
        """Rows ``offset`` to ``offset + n`` in order; none beyond the end."""
        end = min(offset + n, self.total)
        inside = [b for b in self.buckets if b.before < end and b.before + b.rows > offset]
        if not inside or n <= 0:
            return self.stored.select(self.columns).limit(0)
        kept = self._between(inside[0], inside[-1])
        first, last = inside[0], inside[-1]
        if offset > first.before:
            kept = kept.filter((F.col("_bucket") > first.number) | (F.col("_row") >= offset - first.before))
        if end < last.before + last.rows:
            kept = kept.filter((F.col("_bucket") < last.number) | (F.col("_row") < end - last.before))
        return kept.orderBy("_bucket", "_row").limit(n).select(self.columns)

    def after(self, last: Sequence[object], n: int) -> DataFrame:
        """The ``n`` rows that follow the row with these order values, which need not exist any more."""
        if not self.buckets or n <= 0:
            return self.stored.select(self.columns).limit(0)
        key = cmp_to_key(self._compare)
        begin = max(0, bisect_right([key(b.first) for b in self.buckets], key(tuple(last))) - 1)
        end = begin
        while end + 1 < len(self.buckets) and self.buckets[end].before + self.buckets[end].rows - (
            self.buckets[begin].before + self.buckets[begin].rows
        ) < n:
            end += 1
        # Equal so far, and later in the next column.
        steps = [
            reduce(Column.__and__, [F.col(o.column).eqNullSafe(F.lit(v)) for o, v in zip(self.order[:i], last)], o.beyond(value))
            for i, (o, value) in enumerate(zip(self.order, last, strict=True))
        ]
        kept = self._between(self.buckets[begin], self.buckets[end]).filter(reduce(Column.__or__, steps))
        return kept.orderBy("_bucket", "_row").limit(n).select(self.columns)

    def _compare(self, a: tuple, b: tuple) -> int:
        return next((c for o, x, y in zip(self.order, a, b) if (c := o.compare(x, y))), 0)

    def _between(self, first: Bucket, last: Bucket) -> DataFrame:
        return self.stored.filter(F.col("_bucket").between(first.number, last.number))

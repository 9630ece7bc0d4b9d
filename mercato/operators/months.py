"""Marts that grow by months: partial states per month, merged when they are read.

A state holds, per month and key, sums, counts, least and greatest values. These can be merged: the
figures of a key are those of its months taken together. A new month is aggregated alone and
replaces only its own partition; nothing older is read or rewritten.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# How two partial values of a kind become one.
MERGES = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}


@dataclass(frozen=True)
class Measure:
    """A mergeable figure: its kind, and the value (or, for a count, the condition) per row, as SQL."""

    name: str
    kind: str
    value: str

    def __post_init__(self) -> None:
        if self.kind not in MERGES:
            raise ValueError(f"{self.kind} values cannot be merged; use one of {sorted(MERGES)}")

    def partial(self) -> Column:
        value = F.expr(self.value)
        made = F.count_if(value) if self.kind == "count" else MERGES[self.kind](value)
        return made.alias(self.name)

    def merged(self) -> Column:
        return MERGES[self.kind](self.name).alias(self.name)


class MonthlyState:
    """Partial figures at ``path``, one partition per month.

    A month's rows are given whole: ``put`` replaces the months that its rows have and
    leaves the others' files alone. Rows without a month make a partition of their own.
    """

    def __init__(self, spark: SparkSession, path: str, month: str, keys: Sequence[str], measures: Sequence[Measure]) -> None:
        self.spark, self.path, self.month = spark, path.rstrip("/"), month
        self.keys, self.measures = list(keys), list(measures)

    def put(self, rows: DataFrame) -> None:
        """Aggregate the rows by month and key, and replace these months."""
        partial = rows.groupBy(self.month, *self.keys).agg(*[m.partial() for m in self.measures])
        # Adaptive execution splits a large month over several files and joins small ones.
        (
            partial.hint("rebalance", self.month)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(self.month)
            .parquet(self.path)
        )
        self._schema = partial.schema

    def partials(self) -> DataFrame:
        schema = getattr(self, "_schema", None)
        reader = self.spark.read.schema(schema) if schema else self.spark.read
        return reader.parquet(self.path)

    def merged(self, *by: str, since: object | None = None) -> DataFrame:
        """Figures per ``by`` (default: the keys), of all months or of those from ``since`` on."""
        frame = self.partials()
        if since is not None:
            frame = frame.filter(F.col(self.month) >= F.lit(since))
        return frame.groupBy(*(by or self.keys)).agg(*[m.merged() for m in self.measures])

"""Cleaning of raw tables: text, types, duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from mercato.functions.columns import clean_text, parse_timestamp
from mercato.specs import Table


def clean_strings(df: DataFrame) -> DataFrame:
    """Trim every text column and turn blanks into NULL."""
    return df.select(
        *[
            clean_text(f.name).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
            for f in df.schema
        ]
    )


def coerce_timestamps(df: DataFrame, spec: Table) -> DataFrame:
    """Text to timestamp for the columns the table has; unparsable values become NULL."""
    return _recast(df, spec.named(type="timestamp"), lambda c: parse_timestamp(c))


def coerce_numeric(df: DataFrame, spec: Table, number_type: str = "double") -> DataFrame:
    """Text to number for the columns the table has; unparsable values become NULL."""
    df = _recast(df, spec.named(type="double"), lambda c: F.col(c).try_cast(number_type))
    return _recast(df, spec.named(type="int"), lambda c: F.col(c).try_cast("int"))


def _recast(df: DataFrame, names: Sequence[str], cast) -> DataFrame:
    wanted = set(names)
    return df.select(*[cast(c).alias(c) if c in wanted else F.col(c) for c in df.columns])


def distinct_on(df: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """First row of every key in the given order, then by all other columns.

    The order is total, so the surviving row never depends on the partitioning. ``rn = 1``
    makes Spark keep one row per key and task before the shuffle (``WindowGroupLimit``), so
    a key that holds a large part of all rows does not travel.
    """
    rest = [F.col(c).asc_nulls_last() for c in df.columns if c not in keys]
    window = Window.partitionBy(*keys).orderBy(*(list(order) + rest or [F.lit(1)]))
    return df.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")


def dedupe(df: DataFrame, spec: Table) -> DataFrame:
    """Drop exact copies; with a key, keep one row per key.

    Copies share their key, so for a keyed table both steps are the one shuffle of
    :func:`distinct_on`. Rows whose key is NULL are compared like any other.
    """
    key = spec.named(in_key=True)
    if key and set(key) <= set(df.columns):
        return distinct_on(df, key)
    return df.dropDuplicates()


def clean(df: DataFrame, spec: Table) -> DataFrame:
    """All cleaning steps of one table."""
    return dedupe(coerce_numeric(coerce_timestamps(clean_strings(df), spec), spec), spec)


def augment_date_parts(df: DataFrame, timestamp: str = "order_purchase_timestamp") -> DataFrame:
    return df.withColumns(
        {"purchase_year": F.year(timestamp), "purchase_month": F.month(timestamp)}
    )


def normalise_place(df: DataFrame, city: str, state: str) -> DataFrame:
    """Lower-case trimmed city, upper-case state."""
    return df.withColumns({city: F.lower(F.trim(F.col(city))), state: F.upper(F.col(state))})

"""Column helpers with one fixed meaning for rounding, ratios and calendar arithmetic."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, functions as F


def real(column: Column | str) -> Column:
    """Exact decimal or integer as double; apply after summing, never before."""
    return (F.col(column) if isinstance(column, str) else column).cast("double")


def whole(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("bigint")


def rounded(column: Column | str, digits: int = 2) -> Column:
    """Round half away from zero on the binary value (built-in ``round`` rounds its decimal text)."""
    value = real(column)
    scale = float(10**digits)
    return F.signum(value) * F.floor(F.abs(value) * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double, NULL when the denominator is zero."""
    return F.try_divide(real(numerator), real(denominator))


def percent(part: Column, total: Column) -> Column:
    return F.try_divide(F.lit(100.0) * real(part), real(total))


def mean(column: Column | str) -> Column:
    """Average as exact sum over count of non-null values."""
    column = F.col(column) if isinstance(column, str) else column
    return ratio(F.sum(column), F.count(column))


def share_where(condition: Column) -> Column:
    """Percentage of rows for which the condition holds (NULL counts as not holding)."""
    return percent(F.count_if(condition), F.count(F.lit(1)))


def money(column: Column | str) -> Column:
    """Sum of money rounded to cents, as double."""
    return rounded(F.sum(column))


def month_start(column: Column | str) -> Column:
    """First day of the month as a date, independent of the session time zone."""
    return F.trunc(column, "MM")


def as_timestamp(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("timestamp_ntz")


def month_index(column: Column | str) -> Column:
    return F.year(column) * 12 + F.month(column)


def months_between_starts(start: Column | str, end: Column | str) -> Column:
    """Number of month boundaries between two dates (31 Jan to 1 Feb is one)."""
    return whole(month_index(end) - month_index(start))


def day_of_week(column: Column | str) -> Column:
    """0 = Sunday to 6 = Saturday."""
    return F.dayofweek(column) - 1


def elapsed_seconds(start: Column | str, end: Column | str) -> Column:
    """Whole seconds from start to end; plain clock arithmetic, no session time zone involved."""
    return whole(F.floor(_clock_difference(start, end)))


def elapsed_days(start: Column | str, end: Column | str) -> Column:
    """Whole days elapsed (not calendar boundaries)."""
    return whole(F.floor(_clock_difference(start, end) / 86400))


def _clock_difference(start: Column | str, end: Column | str) -> Column:
    return F.datediff(_col(end), _col(start)) * 86400 + _second_of_day(end) - _second_of_day(start)


def _second_of_day(column: Column | str) -> Column:
    column = _col(column)
    return F.hour(column) * 3600 + F.minute(column) * 60 + F.extract(F.lit("SECOND"), column)


def label_or_unknown(column: Column | str) -> Column:
    return F.coalesce(_col(column), F.lit("unknown"))


def cents_to_units(column: Column | str) -> Column:
    """Integer cents as a two-digit amount."""
    return rounded(real(_col(column)) / F.lit(100.0), 2)


def clean_text(column: Column | str) -> Column:
    """Trimmed text, blank as NULL."""
    return F.nullif(F.trim(_col(column)), F.lit(""))


def parse_timestamp(column: Column | str) -> Column:
    """Text to timestamp; blank or unparsable text gives NULL."""
    return clean_text(column).try_cast("timestamp_ntz")


def bands(value: Column, edges: list[tuple[float, str]], top: str) -> Column:
    """Label of the first edge the value lies below, else ``top``."""
    chain = F
    for edge, label in edges:
        chain = chain.when(value < F.lit(edge), F.lit(label))
    return chain.otherwise(F.lit(top))


def all_of(predicates: list[Column]) -> Column:
    """Conjunction of optional predicates; no predicate keeps every row."""
    return reduce(and_, predicates, F.lit(True))


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column

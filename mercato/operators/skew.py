"""Joins that stay balanced when one key holds a large part of the rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def hot_keys(
    df: DataFrame, key: str, share: float = 0.01, fraction: float | None = None
) -> list[object]:
    """Keys (NULL may be one) that hold at least ``share`` of a sample of ``df``.

    Only the key column is scanned. The sampled fraction is 0.01, or what the setting
    ``spark.mercato.skewSampleFraction`` says: very large tables need far less.

    There can be at most ``1 / share`` of them, which bounds what reaches the driver. The
    list decides only how rows are spread, never which rows match, so a sampling error
    costs balance and not correctness.
    """
    if fraction is None:
        fraction = float(df.sparkSession.conf.get("spark.mercato.skewSampleFraction", "0.01"))
    counts = (
        df.select(key)
        .sample(fraction, seed=7)
        .rollup(key)
        .agg(F.count(F.lit(1)).alias("n"), F.grouping(key).alias("is_total"))
        .orderBy(F.desc("n"), F.desc("is_total"))
    )
    total, *top = counts.limit(int(1 / share) + 1).collect() or [None]
    floor = max(share * total["n"], 2) if total else 0
    return [row[key] for row in top if row["n"] >= floor]


def among(key: str, keys: list[object]) -> Column:
    """Whether a row's key (NULL may be one) is in the list; never NULL."""
    known = [k for k in keys if k is not None]
    found = F.coalesce(F.col(key).isin(known), F.lit(False)) if known else F.lit(False)
    return found | F.col(key).isNull() if None in keys else found


def gathered(
    df: DataFrame, key: str, total: Callable[[DataFrame], DataFrame], hot: list[object] | None = None
) -> DataFrame:
    """``total``, which groups by ``key``, over rows that one shuffle has brought together.

    Where a key has a handful of rows that lie apart, partial sums before the shuffle save no row and
    weigh more than the rows do, and a distinct count takes a second shuffle. Rows of a hot key go
    that usual way nevertheless, so that every task sends one row of each.
    """
    hot = hot_keys(df, key) if hot is None else hot
    if not hot:
        return total(df.repartition(key))
    rest = total(df.filter(~among(key, hot)).repartition(key))
    return rest.unionByName(total(df.filter(among(key, hot))))


def salted_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    salt_by: Sequence[str],
    how: str = "inner",
    spread: int = 64,
    hot: list[object] | None = None,
) -> DataFrame:
    """Join ``left`` with ``right`` (unique on ``key``), spreading the hot keys of ``left``.

    Rows of a hot key get one of ``spread`` salts from the columns ``salt_by`` (a function of
    the row, so a retried task repeats it); only the right rows of those few keys are copied
    ``spread`` times. All other keys keep salt 0 and are not copied. Rows without a key are
    spread too where a left join keeps them. ``how`` is ``inner`` or ``left``. A small right
    side still becomes a broadcast join, because Spark decides that by size.
    """
    if how not in ("inner", "left"):
        raise ValueError("salted_join supports inner and left joins")
    hot = hot_keys(left, key) if hot is None else hot
    keys = [k for k in hot if k is not None]
    spread_nulls = how == "left" and None in hot
    if not keys and not spread_nulls:
        return left.join(right, key, how)

    def is_hot() -> Column:
        return F.coalesce(F.col(key).isin(keys), F.lit(False)) if keys else F.lit(False)

    salt = F.pmod(F.xxhash64(*salt_by), F.lit(spread)).cast("int")
    spread_out = is_hot() | F.col(key).isNull() if spread_nulls else is_hot()
    copies = F.when(is_hot(), F.sequence(F.lit(0), F.lit(spread - 1))).otherwise(F.array(F.lit(0)))
    salted_left = left.withColumn("_salt", F.when(spread_out, salt).otherwise(F.lit(0)))
    salted_right = right.withColumn("_salt", F.explode(copies))
    return salted_left.join(salted_right, [key, "_salt"], how).drop("_salt")

"""Globally ordered operators that never bring all rows into one task.

A window without PARTITION BY moves every row to a single task, and a window over a hot
key does the same for that key. Here rows are range-partitioned on the full sort key
(``repartitionByRange``), sorted inside their partition, numbered and written once to the
shared folder. A row's place is then data: (range bucket, row in bucket). Everything else
needs only per-bucket totals, and there are no more buckets than shuffle partitions.

Sort keys are ascending columns; negate a number for descending order. NULL keys sort last.
The last key must make the order total where ties would change the result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from mercato.session import materialise

_ROW_BITS = 33  # monotonically_increasing_id keeps the row within its partition in the low 33 bits


def _keys(order: Sequence[Column]) -> list[Column]:
    """Each key preceded by its NULL flag, so that NULLs sort last."""
    flat: list[Column] = []
    for i, column in enumerate(order):
        flat += [column.isNull().alias(f"_null{i}"), column.alias(f"_key{i}")]
    return flat


def place(
    df: DataFrame, order: Sequence[Column], keep: Sequence[str], buckets: int | None = None
) -> DataFrame:
    """Rows with ``_at`` (sortable place), ``_bucket`` and ``_row`` (0-based within bucket)."""
    keyed = df.select(*keep, *_keys(order))
    names = [c for c in keyed.columns if c not in keep]
    ranged = keyed.repartitionByRange(*([buckets] if buckets else []), *names)
    placed = materialise(
        ranged.sortWithinPartitions(*names).withColumn("_at", F.monotonically_increasing_id()),
        "ordered",
    )
    return placed.withColumns(
        {
            "_bucket": F.shiftright("_at", _ROW_BITS),
            "_row": F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)),
        }
    )


def _together(placed: DataFrame) -> DataFrame:
    """Buckets spread evenly over tasks by their number, each in one task.

    A window over ``_bucket`` takes this placement as it is; by the hash of their numbers some
    tasks would get several buckets and others none. Each bucket is one file, and with their number
    given narrow rows of many buckets are not put into one task for their few bytes.
    """
    return placed.repartitionByRange(max(len(placed.inputFiles()), 1), "_bucket")


def _bucket_totals(placed: DataFrame, totals: Mapping[str, Column]) -> DataFrame:
    """Per bucket, the totals of all buckets before it: at most one row per range bucket."""
    per_bucket = placed.groupBy("_bucket").agg(*[c.alias(f"_own_{n}") for n, c in totals.items()])
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    return per_bucket.select(
        "_bucket",
        *[F.coalesce(F.sum(f"_own_{n}").over(before), F.lit(0)).alias(f"_before_{n}") for n in totals],
    )


def row_numbers(
    df: DataFrame, order: Sequence[Column], name: str = "row_number", buckets: int | None = None
) -> DataFrame:
    """``row_number() over (order by ...)`` for all rows."""
    placed = place(df, order, df.columns, buckets)
    offsets = _bucket_totals(placed, {"n": F.count(F.lit(1))})
    return placed.join(F.broadcast(offsets), "_bucket").select(
        *df.columns, (F.col("_before_n") + F.col("_row") + 1).alias(name)
    )


def _bucket_counts(placed: DataFrame) -> list[tuple[int, int]]:
    """Rows per bucket in order: one pair per range bucket reaches the driver."""
    return sorted((r["_bucket"], r["count"]) for r in placed.groupBy("_bucket").count().collect())


def _rows_at(
    placed: DataFrame, counts: Sequence[tuple[int, int]], positions: Sequence[int]
) -> dict[int, object]:
    """Rows at the given 0-based global positions.

    One row per requested position reaches the driver; the lookup by ``_at`` is pushed into
    the scan, where the sorted files let it skip row groups.
    """
    wanted: dict[int, int] = {}
    passed = 0
    for bucket, n in counts:
        for position in positions:
            if passed <= position < passed + n:
                wanted[(bucket << _ROW_BITS) + position - passed] = position
        passed += n
    if not wanted:
        return {}
    found = placed.filter(F.col("_at").isin(list(wanted))).collect()
    return {wanted[row["_at"]]: row for row in found}


def _tile_starts(n: int, tiles: int) -> list[int]:
    """0-based position of the first row of tiles 2..n when the first tiles take the remainder."""
    size, rest = divmod(n, tiles)
    starts = [t * size + min(t, rest) for t in range(1, tiles)]
    return [s for s in starts if s < n]


def ntiles(
    df: DataFrame, tiles: Mapping[str, tuple[int, Sequence[Column]]], buckets: int | None = None
) -> DataFrame:
    """Several ``ntile(n) over (order by ...)`` columns at once.

    Only the keys at the n-1 tile borders are needed: they are looked up exactly, and each row
    is classified against them in one narrow pass. No row is moved back or joined.
    All orders are placed in one range-partitioned table, headed by the number of the order.
    ``df`` should be materialised, since it is read for the placement and for the result.
    """
    depth = max(len(order) for _, order in tiles.values())
    orders = [
        [F.lit(i), *order, *[F.lit(None).cast("int")] * (depth - len(order))]
        for i, (_, order) in enumerate(tiles.values())
    ]
    stacked = df.select(
        F.explode(
            F.array(
                *[F.struct(*[c.alias(f"o{j}") for j, c in enumerate(order)]) for order in orders]
            )
        ).alias("o")
    ).select("o.*")
    placed = place(stacked, [F.col(c) for c in stacked.columns], (), buckets)
    counts = _bucket_counts(placed)
    size = sum(n for _, n in counts) // len(orders)
    starts = {
        name: [i * size + s for s in _tile_starts(size, n)]
        for i, (name, (n, _)) in enumerate(tiles.items())
    }
    rows = _rows_at(placed, counts, [p for ps in starts.values() for p in ps])
    types = {f.name: f.dataType for f in placed.schema if f.name.startswith(("_null", "_key"))}
    columns: dict[str, Column] = {}
    for order, (name, positions) in zip(orders, starts.items()):
        here = F.struct(*[k.cast(types[n]).alias(n) for k, n in zip(_keys(order), types)])
        passed = [
            here >= F.struct(*[F.lit(rows[p][n]).cast(t).alias(n) for n, t in types.items()])
            for p in positions
        ]
        columns[name] = reduce(
            lambda acc, p: acc + p.cast("bigint"), passed, F.lit(1).cast("bigint")
        )
    return df.withColumns(columns)


def percentile(
    df: DataFrame,
    column: str,
    shares: Sequence[float],
    tie_breaker: Sequence[Column] = (),
    buckets: int | None = None,
) -> list[float | None]:
    """Exact interpolated percentiles of a column with many distinct values.

    The built-in exact percentile gathers all distinct values in one task; this one ranks
    them in a range-partitioned table and looks up the two neighbours of each share. A value
    that very many rows share is split over buckets if ``tie_breaker`` tells its rows apart.
    """
    known = df.filter(F.col(column).isNotNull())
    placed = place(known, [F.col(column).cast("double"), *tie_breaker], (), buckets)
    counts = _bucket_counts(placed)
    n = sum(rows for _, rows in counts)
    if n == 0:
        return [None for _ in shares]
    spots = [share * (n - 1) for share in shares]
    positions = {int(s) for s in spots} | {min(int(s) + 1, n - 1) for s in spots}
    rows = _rows_at(placed, counts, sorted(positions))
    result: list[float | None] = []
    for spot in spots:
        low = rows[int(spot)]["_key0"]
        high = rows[min(int(spot) + 1, n - 1)]["_key0"]
        result.append(low + (high - low) * (spot - int(spot)))
    return result


def tied(
    df: DataFrame,
    key: Column,
    tie_breaker: Sequence[Column],
    measures: Mapping[str, Column] | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Rank figures and running sums over an ascending key, equal keys treated alike.

    Adds ``row_number``, ``rank``, ``dense_rank``, ``rows_through`` (rows up to and including
    the key) and ``<name>_through`` for every measure (the default RANGE frame).

    Rows with one key may span many buckets, because buckets are cut on key and tie-breaker.
    Figures are computed inside the bucket and completed from one summary row per bucket: what
    came before it, whether its first key began earlier, and where its last key ends.
    """
    measures = dict(measures or {})
    frame = df.select("*", *[c.alias(f"_m_{n}") for n, c in measures.items()])
    placed = _together(place(frame, [key, *tie_breaker], frame.columns, buckets))
    value = F.struct("_null0", "_key0")
    in_bucket = Window.partitionBy("_bucket").orderBy("_null0", "_key0")
    sums = {"rows": F.lit(1)} | {n: F.col(f"_m_{n}") for n in measures}
    local = placed.select(
        *df.columns,
        "_bucket",
        "_row",
        value.alias("_value"),
        *[c.alias(f"_m_{n}") for n, c in sums.items()],
        F.rank().over(in_bucket).alias("_rank"),
        F.dense_rank().over(in_bucket).alias("_dense"),
        *[F.sum(c).over(in_bucket).alias(f"_in_{n}") for n, c in sums.items()],
    )
    edges = F.broadcast(_bucket_edges(local, list(sums)))
    continued = F.col("_continues") & (F.col("_value") == F.col("_first"))
    continuing = F.col("_goes_on") & (F.col("_value") == F.col("_last"))
    through = {
        n: F.when(continuing, F.col(f"_end_{n}")).otherwise(F.col(f"_before_{n}") + F.col(f"_in_{n}"))
        for n in sums
    }
    before = F.col("_before_rows")
    return local.join(edges, "_bucket").select(
        *df.columns,
        (before + F.col("_row") + 1).alias("row_number"),
        F.when(continued, F.col("_began") + 1).otherwise(before + F.col("_rank")).alias("rank"),
        (F.col("_before_values") + F.col("_dense") - F.col("_continues").cast("int")).alias("dense_rank"),
        *[c.alias(f"{n}_through") for n, c in through.items()],
    )


def _bucket_edges(local: DataFrame, sums: Sequence[str]) -> DataFrame:
    """One row per bucket; the windows below run over buckets, not over rows."""
    per_bucket = local.groupBy("_bucket").agg(
        F.max("_dense").alias("_values"),
        F.max("_rank").alias("_last_rank"),
        F.min("_value").alias("_first"),
        F.max("_value").alias("_last"),
        *[F.sum(f"_m_{n}").alias(f"_all_{n}") for n in sums],
        *[F.min_by(f"_in_{n}", "_value").alias(f"_head_{n}") for n in sums],
    )
    order = Window.orderBy("_bucket")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    from_here = order.rowsBetween(0, Window.unboundedFollowing)
    linked = per_bucket.select(
        "*",
        F.coalesce(F.lag("_last").over(order) == F.col("_first"), F.lit(False)).alias("_continues"),
        F.coalesce(F.lead("_first").over(order) == F.col("_last"), F.lit(False)).alias("_goes_on"),
        *[F.coalesce(F.sum(f"_all_{n}").over(earlier), F.lit(0)).alias(f"_before_{n}") for n in sums],
    )
    one_key = F.col("_first") == F.col("_last")
    # Rows before the last key of a bucket; a bucket inside a run takes over the run's start.
    start = F.when(
        ~(one_key & F.col("_continues")), F.col("_before_rows") + F.col("_last_rank") - 1
    )
    # Totals through the first key of a bucket; a bucket inside a run takes over the run's end.
    ends = {
        n: F.when(~(one_key & F.col("_goes_on")), F.col(f"_before_{n}") + F.col(f"_head_{n}"))
        for n in sums
    }
    runs = linked.select(
        "*",
        F.last(start, ignorenulls=True).over(so_far).alias("_start"),
        *[F.first(c, ignorenulls=True).over(from_here).alias(f"_close_{n}") for n, c in ends.items()],
    )
    new_values = F.col("_values") - F.col("_continues").cast("int")
    return runs.select(
        "_bucket",
        "_first",
        "_last",
        "_continues",
        "_goes_on",
        F.coalesce(F.sum(new_values).over(earlier), F.lit(0)).alias("_before_values"),
        F.lag("_start").over(order).alias("_began"),
        *[f"_before_{n}" for n in sums],
        *[F.lead(f"_close_{n}").over(order).alias(f"_end_{n}") for n in sums],
    )


def ranks(
    df: DataFrame, key: Column, tie_breaker: Sequence[Column], buckets: int | None = None
) -> DataFrame:
    """row_number, rank, dense_rank, percent_rank and cume_dist of every row by an ascending key."""
    total = F.broadcast(df.agg(F.count(F.lit(1)).alias("_total")))
    rows = F.col("_total").cast("double")
    return (
        tied(df, key, tie_breaker, buckets=buckets)
        .crossJoin(total)
        .select(
            *df.columns,
            "row_number",
            "rank",
            "dense_rank",
            F.coalesce(F.try_divide((F.col("rank") - 1).cast("double"), rows - 1), F.lit(0.0)).alias(
                "percent_rank"
            ),
            (F.col("rows_through").cast("double") / rows).alias("cume_dist"),
        )
    )


def lag_within(
    df: DataFrame,
    group: str,
    order: Sequence[Column],
    column: str,
    name: str,
    buckets: int | None = None,
) -> DataFrame:
    """``lag(column) over (partition by group order by ...)`` without gathering a group in a task.

    Rows are range-partitioned on (group, order), so a large group spans several buckets. The
    predecessor of a bucket's first row is the last row of the nearest bucket before it.
    """
    placed = _together(place(df, [F.col(group), *order], df.columns, buckets))
    local = Window.partitionBy("_bucket").orderBy("_row")
    last = placed.groupBy("_bucket").agg(F.max("_row").alias("_row"))
    tails = (
        placed.join(F.broadcast(last), ["_bucket", "_row"])
        .select("_bucket", F.struct(group, column).alias("_tail"))
        .select("_bucket", F.lag("_tail").over(Window.orderBy("_bucket")).alias("_tail"))
    )
    previous = F.coalesce(F.lag(F.struct(group, column)).over(local), F.col("_tail"))
    return (
        placed.join(F.broadcast(tails), "_bucket")
        .withColumn("_previous", previous)
        .select(
            *df.columns,
            F.when(
                F.col("_previous")[group].eqNullSafe(F.col(group)), F.col("_previous")[column]
            ).alias(name),
        )
    )

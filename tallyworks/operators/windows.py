"""Ranks, top-k and running totals.

Windows hold one group per task. ``top_k`` is safe for groups of any size
because each task first keeps its own k best rows (for k up to Spark's
``windowGroupLimitThreshold``, 1000 unless set); ``running_total`` is for groups that are
already aggregated to a bounded number of steps (the months of a year).

The other three take groups and k of any size: rows are range-partitioned into sorted
slices, so that a group spans as many tasks as it needs, each slice is worked on by itself,
and what carries over from slice to slice is a small table of (key, slice): places for
``ranked`` and ``first_rows``, sums for ``running_balance``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.session import pin


def top_k(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, into: str = "rank"
) -> DataFrame:
    """The k first rows per key with their row number; ``order`` should end in a unique key."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(into, F.row_number().over(window)).where(F.col(into) <= k)


def running_total(
    df: DataFrame,
    value: str,
    keys: Sequence[str],
    order: Sequence[str],
    into: str,
    frame: str = "rows",
) -> DataFrame:
    """Running sum per key.

    ``frame="rows"`` adds row by row; ``"range"`` gives rows with an equal
    order value the same total, as a window with ORDER BY and no frame does.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    start, here = Window.unboundedPreceding, Window.currentRow
    framed = window.rowsBetween(start, here) if frame == "rows" else window.rangeBetween(start, here)
    return df.withColumn(into, F.sum(value).over(framed))


def running_balance(
    df: DataFrame,
    value: str,
    keys: Sequence[str],
    order: Sequence[str],
    tie: Sequence[str],
    into: str,
    frame: str = "rows",
) -> DataFrame:
    """Running sum per key over raw rows, for keys of any size.

    ``frame="rows"`` adds row by row in the order of ``order`` and ``tie``, which together
    should be unique; ``"range"`` gives rows that are equal in ``order`` (peers) the same
    total, and ``tie`` only lets many peers spread over slices. Orders ascend, nulls first.
    As in SQL, null values add nothing, and the total is null until one is not null.

    Sums are exact, and the same however rows are sliced, for whole numbers and decimals.
    """
    position = [*order, *tie]
    peers = F.struct(*order)
    window = Window.partitionBy("_slice", *keys)
    if frame == "rows":
        window = window.orderBy(*position).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    else:
        window = window.orderBy(*order).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    slices = pin(
        df.repartitionByRange(*map(F.col, [*keys, *position]))
        .withColumn("_slice", F.spark_partition_id())
        .withColumn("_local", F.sum(value).over(window))
    )
    borders = pin(
        slices.groupBy(*keys, "_slice").agg(
            F.sum(value).alias("_sum"),
            F.min(peers).alias("_head"),
            F.max(peers).alias("_tail"),
            F.min_by("_local", peers).alias("_head_sum"),
        )
    )
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = borders.withColumn("_before", F.sum("_sum").over(earlier))
    carried = _with_later_peers(carried, keys) if frame == "range" else carried.withColumn("_after", F.lit(None))
    carry = pin(
        carried.select(
            *(F.col(key).alias(f"_at_{key}") for key in keys), F.col("_slice").alias("_at"),
            "_tail", "_before", "_after",
        )
    )
    after = F.when(peers == F.col("_tail"), F.col("_after"))
    parts = [F.col("_local"), F.col("_before"), after]
    total = reduce(lambda a, b: a + b, (F.coalesce(part, F.lit(0)) for part in parts))
    return slices.join(carry, _same_slice(keys)).select(
        *df.columns, F.when(F.coalesce(*parts).isNotNull(), total).alias(into)
    )


def _with_later_peers(borders: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Adds ``_after``: what peers of a slice's last row come to in later slices."""
    heads = borders.select(*keys, "_slice", F.col("_head").alias("_peer"), F.col("_head_sum").alias("_more"))
    tails = borders.select(*keys, "_slice", F.col("_tail").alias("_peer"), "_tail", "_before")
    later = Window.partitionBy(*keys, "_peer").orderBy("_slice").rangeBetween(1, Window.unboundedFollowing)
    met = heads.unionByName(tails, allowMissingColumns=True)
    return met.withColumn("_after", F.sum("_more").over(later)).where("_tail IS NOT NULL")


def ranked(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], into: str = "ranking"
) -> DataFrame:
    """Row number of every row within its key; ``order`` must end in a unique key.

    The rows are range-partitioned into slices along (keys, order) and sorted there,
    so one key may span many slices and each row's place in its slice is known
    before the slices are pinned in shared storage. A row's number is its place, less
    the first place of its key in that slice, plus the key's rows in earlier slices.
    Only that table of (key, slice) is shuffled again.
    """
    return _numbered(df, keys, order, into)


def first_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, into: str = "rank"
) -> DataFrame:
    """As ``top_k``, for any k: the rows are cut by slices and places, never by a window.

    Each slice keeps at most k rows of a key, and a slice that begins behind the k-th row
    of a key keeps none of it.
    """
    return _numbered(df, keys, order, into, k)


def _numbered(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], into: str, k: int | None = None
) -> DataFrame:
    placed = (
        df.repartitionByRange(*[F.col(key) for key in keys], *order)
        .sortWithinPartitions(*[F.col(key) for key in keys], *order)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    # The upper bits of that id are the partition, the lower 33 the place in it.
    slices = pin(
        placed.withColumn("_slice", F.shiftright("_place", 33)).withColumn(
            "_place", F.col("_place").bitwiseAND((1 << 33) - 1)
        )
    )
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_rows").over(earlier), F.lit(0))
    shifts = (
        slices.groupBy(*keys, "_slice")
        .agg(F.count("*").alias("_rows"), F.min("_place").alias("_first"))
        .withColumn("_before", before)
    )
    # Written, so that the planner knows its size and need not shuffle the rows to it.
    shifts = pin(
        (shifts if k is None else shifts.where(F.col("_before") < k)).select(
            *(F.col(key).alias(f"_at_{key}") for key in keys),
            F.col("_slice").alias("_at"),
            (F.col("_before") - F.col("_first") + 1).alias("_shift"),
        )
    )
    numbered = slices.join(shifts, _same_slice(keys)).select(
        *df.columns, (F.col("_place") + F.col("_shift")).alias(into)
    )
    return numbered if k is None else numbered.where(F.col(into) <= k)


def _same_slice(keys: Sequence[str]) -> Column:
    same = F.col("_slice") == F.col("_at")
    return reduce(lambda met, key: met & F.col(key).eqNullSafe(F.col(f"_at_{key}")), keys, same)

"""Joins, planned so that no side is broadcast without a look at its size.

No join here carries a broadcast hint: the planner, and AQE with measured sizes,
broadcast a side below ``spark.sql.autoBroadcastJoinThreshold``. A key that fills a
large part of the rows is handled in one of three ways: a small side is broadcast
(the other side is not shuffled at all), matching and non-matching tests first
reduce the tested side to its distinct keys, and the remaining shuffle joins are
left to AQE, which splits skewed partitions.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bits of the filter of ``sifted``; a table of at most an eighth of a million words, whatever is joined.
FILTER_BITS = 1 << 23


def lookup(
    facts: DataFrame, dimension: DataFrame, on: str | Sequence[str], how: str = "inner"
) -> DataFrame:
    """Facts with the columns of a dimension, joined on columns of the same name."""
    return facts.join(dimension, [on] if isinstance(on, str) else list(on), how)


def large_join(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Inner join of two unfiltered sides that both grow with the data: never a broadcast.

    File sizes make a narrow slice of a large compressed table look small; the
    hint keeps the planner from sending it to every executor. AQE still splits
    skewed partitions. Where a side was filtered, ``lookup`` lets AQE choose.
    """
    return left.join(right.hint("merge"), on)


def bucketing(spark: SparkSession, table: str) -> tuple[int, tuple[str, ...]]:
    """The number of buckets of a stored table and their columns; (0, ()) without buckets."""
    facts = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    columns = facts.get("Bucket Columns", "[]").strip("[]").replace("`", "")
    return int(facts.get("Num Buckets", 0)), tuple(c.strip() for c in columns.split(",") if c)


def co_bucketed(spark: SparkSession, left: str, right: str, on: str) -> DataFrame:
    """Inner join of two stored tables that share their buckets: neither side is shuffled.

    Both must be bucketed by ``on`` alone, with the same number of buckets, or it is an
    error: the join would still be right, but shuffle both. What follows may group by
    ``on`` without a shuffle, too. A value of ``on`` that fills a bucket fills a task;
    ``large_join`` of unbucketed tables is the way for such keys.
    """
    stored = {name: bucketing(spark, name) for name in (left, right)}
    if len(set(stored.values())) != 1 or stored[left][1] != (on,):
        raise ValueError(f"not bucketed alike by {on}: {stored}")
    return spark.table(left).join(spark.table(right).hint("merge"), on)


def matched(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key occurs in ``right``."""
    return _key_test(left, right, on, "left_semi")


def unmatched(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key does not occur in ``right``; null keys never occur."""
    return _key_test(left, right, on, "left_anti")


def same_key(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Equality of all keys that also pairs null with null."""
    return reduce(
        lambda condition, more: condition & more,
        (left[key].eqNullSafe(right[key]) for key in keys),
    )


def _key_test(left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str) -> DataFrame:
    keys = [on] if isinstance(on, str) else list(on)
    # distinct() merges a hot key inside the map tasks, and its shuffle is the
    # one the join needs anyway.
    return left.join(right.select(*keys).distinct(), keys, how)


def sifted(df: DataFrame, on: str, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of ``df`` whose key may be in ``known``, and the rows whose key is not there for certain.

    ``on`` is a column of whole numbers in both, evenly spread (a hash). The rows are told by a
    filter of fixed size that is broadcast, so the wide rows of the second frame need no
    shuffle for a key test; the first holds those with the key and about one in
    ``FILTER_BITS`` / keys of the others. A null key is not in ``known``.
    """
    place = F.pmod(F.col(on), F.lit(FILTER_BITS))
    word, bits = F.shiftright(place, 6), "_sifted_bits"
    held = known.select(word.alias("_sifted"), F.pmod(place, F.lit(64)).cast("int").alias("_bit"))
    words = held.groupBy("_sifted").agg(F.bit_or(F.expr("shiftleft(1L, _bit)")).alias(bits))
    told = df.withColumn("_sifted", word).join(F.broadcast(words), "_sifted", "left")
    # The word that a row met, moved so that the bit of the row is the last.
    met = F.call_function("shiftright", F.col(bits), F.pmod(place, F.lit(64)).cast("int")).bitwiseAND(F.lit(1))
    may = F.coalesce(met == 1, F.lit(False))
    return told.where(may).select(*df.columns), told.where(~may).select(*df.columns)

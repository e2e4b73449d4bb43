"""Grouped aggregates. Everything is partially aggregated before its shuffle."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.functions import money
from tallyworks.operators import windows
from tallyworks.operators.joins import lookup, same_key


#: About so many rows go to one part where the number of parts follows the rows.
PART_ROWS = 250_000


def parts_for(df: DataFrame) -> int:
    """How many parts hold about ``PART_ROWS`` rows each, two at least; the count of a file reads no column."""
    return max(2, math.ceil(df.count() / PART_ROWS))


def count_by(df: DataFrame, *keys: str, into: str = "count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(into))


def row_count(df: DataFrame, into: str = "count") -> DataFrame:
    return df.agg(F.count("*").alias(into))


def distinct_count(df: DataFrame, column: str, into: str) -> DataFrame:
    """Distinct values with null counted as one value; filter nulls first to leave it out."""
    return df.select(column).distinct().agg(F.count("*").alias(into))


def share_by(
    df: DataFrame,
    keys: Sequence[str],
    condition: Column,
    hits: str,
    rows: str,
    share: str,
    digits: int | None = None,
) -> DataFrame:
    """Rows, rows that meet ``condition``, and their share in percent per key."""
    counted = df.groupBy(*keys).agg(F.count_if(condition).alias(hits), F.count("*").alias(rows))
    percent = money.percent(hits, rows)
    return counted.withColumn(share, percent if digits is None else F.round(percent, digits))


def one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One whole row per key: the smallest by ``order``, then by the remaining columns.

    Each map task keeps one row per key, so many copies of one key cost no skew.
    """
    rest = [name for name in df.columns if name not in keys]
    if not rest:
        return df.distinct()
    ranked = [*order, *(name for name in rest if name not in order)]
    return windows.top_k(df, keys, [F.asc(name) for name in ranked], 1, "_place").drop("_place")


def nest(
    df: DataFrame,
    keys: Sequence[str],
    fields: Sequence[str],
    into: str,
    part_by: Column | None = None,
) -> DataFrame:
    """Fold the rows of a key into arrays of structs, one for each of its parts.

    ``part_by`` is an integer made from a row's content, such as the year of its date,
    or a hash of the row for keys with very many rows. It is part of the group,
    whatever the number of rows, so the result does not depend on their number and a
    large key is spread over tasks. Without it a key is one part, 0; so is a null.
    """
    part = F.lit(0) if part_by is None else F.coalesce(part_by.cast("int"), F.lit(0))
    placed = df.select(*keys, part.alias("part"), F.struct(*fields).alias("_item"))
    return placed.groupBy(*keys, "part").agg(F.sort_array(F.collect_list("_item")).alias(into))


def nested_under(
    parents: DataFrame,
    children: DataFrame,
    keys: Sequence[str],
    fields: Sequence[str],
    into: str,
    summary: Sequence[Column] = (),
    part_by: Column | None = None,
) -> DataFrame:
    """Each parent with its children as arrays, one row per part as in ``nest``.

    A parent without children has one row, part 0, with a null. ``summary`` adds
    aggregates over all children of a parent. The join is left to AQE, which may
    split the parts of one parent over tasks.
    """
    children = children.dropna(subset=list(keys))
    nested = nest(children, keys, fields, into, part_by)
    if summary:
        parents = parents.join(children.groupBy(*keys).agg(*summary), list(keys), "left")
    return parents.join(nested, list(keys), "left").withColumn(
        "part", F.coalesce("part", F.lit(0))
    )


def sums_through(
    facts: DataFrame,
    dimension: DataFrame,
    key: str,
    attributes: Sequence[str],
    sums: dict[str, Column],
) -> DataFrame:
    """Sums over facts per attribute of the dimension row their key points to.

    Facts are summed per key before the join and per attribute after it, so
    each key meets the join once, however many facts it has.
    """
    per_key = facts.groupBy(key).agg(*(total.alias(name) for name, total in sums.items()))
    return (
        lookup(per_key, dimension.select(key, *attributes), key)
        .groupBy(*attributes)
        .agg(*(F.sum(name).alias(name) for name in sums))
    )


def partition_profile(df: DataFrame) -> DataFrame:
    """Rows per Spark partition, which also tells how many partitions hold rows."""
    return df.groupBy(F.spark_partition_id().alias("partition_id")).agg(
        F.count("*").alias("count")
    )


def correlation(x: str, y: str) -> Column:
    """Aggregate: Pearson's correlation of rows that have both; null if either does not vary.

    Spark's own ends the job there, with a division by zero.
    """
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    spread = F.stddev_pop(F.when(both, F.col(x))) * F.stddev_pop(F.when(both, F.col(y)))
    return F.try_divide(F.covar_pop(x, y), spread)


def catalogue(df: DataFrame, keys: Sequence[str], x: str, y: str) -> DataFrame:
    """The statistical aggregates of two numeric columns per key.

    Central moments are gathered once; what follows from them (the sample forms,
    the roots) is computed from the result. Different values are counted in a group
    of their own, so the moments need no plan for distinct aggregates.
    """
    pairs = F.count(F.when(F.col(x).isNotNull() & F.col(y).isNotNull(), 1))
    moments = df.groupBy(*keys).agg(
        F.count(x).alias("count"),
        F.approx_count_distinct(x).alias("approx_count_distinct"),
        F.min(x).alias("min"),
        F.max(x).alias("max"),
        F.mean(x).alias("mean"),
        F.sum(x).alias("sum"),
        F.var_pop(x).alias("var_pop"),
        F.skewness(x).alias("skewness"),
        F.kurtosis(x).alias("kurtosis"),
        correlation(x, y).alias("corr"),
        F.covar_pop(x, y).alias("covar_pop"),
        pairs.alias("_pairs"),
    )
    values = (
        df.groupBy(*keys, x)
        .agg(F.lit(1).alias("_one"))
        .groupBy(*(F.col(key).alias(f"_at_{key}") for key in keys))
        .agg(F.count(x).alias("count_distinct"), F.sum(x).alias("sum_distinct"))
    )
    same = F.lit(True)
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_at_{key}"))

    def sample(moment: str, n: str) -> Column:
        return F.when(F.col(n) > 1, F.col(moment) * F.col(n) / (F.col(n) - 1))

    variance = sample("var_pop", "count")
    return moments.join(values, same).select(
        *keys,
        "count",
        "count_distinct",
        "approx_count_distinct",
        "min",
        "max",
        "mean",
        "sum",
        "sum_distinct",
        "var_pop",
        variance.alias("var_samp"),
        variance.alias("variance"),
        F.sqrt(variance).alias("stddev"),
        F.sqrt("var_pop").alias("stddev_pop"),
        F.sqrt(variance).alias("stddev_samp"),
        "skewness",
        "kurtosis",
        "corr",
        "covar_pop",
        sample("covar_pop", "_pairs").alias("covar_samp"),
    )


def ends_by(df: DataFrame, keys: Sequence[str], value: str, order: Sequence[str]) -> DataFrame:
    """First and last value per key in a stated order, and the set of values seen.

    The set grows with the number of different values, so ``value`` should be
    a code or a category.
    """
    position = F.struct(*order)
    return df.groupBy(*keys).agg(
        F.min_by(value, position).alias("first"),
        F.max_by(value, position).alias("last"),
        F.sort_array(F.collect_set(value)).alias("values"),
    )


def cube_counts(df: DataFrame, first: str, second: str) -> DataFrame:
    """Counts for all four groupings of two columns, marked by grouping and grouping id."""
    return df.cube(first, second).agg(
        F.grouping(first).cast("int").alias(f"{first}_is_total"),
        F.grouping(second).cast("int").alias(f"{second}_is_total"),
        F.grouping_id().alias("grouping_id"),
        F.count("*").alias("count"),
    )

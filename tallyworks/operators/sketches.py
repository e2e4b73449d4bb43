"""Distinct counts that can be merged: stored HyperLogLog sketches.

A sketch of a few kilobytes stands for the set of values it has seen. Sketches of parts are
gathered once, stored, and merged for any union of parts without reading the rows again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 2 ** 14 registers: a relative standard error of 0.65 percent.
PRECISION = 14


def sketched(
    df: DataFrame, keys: Sequence[str], value: str, into: str = "sketch", precision: int = PRECISION
) -> DataFrame:
    """One sketch of the values per key; nulls are no values. Partial sketches meet, not rows."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(value, F.lit(precision)).alias(into))


def merged(
    sketches: DataFrame, keys: Sequence[str], sketch: str = "sketch", into: str = "values"
) -> DataFrame:
    """Estimated number of different values per coarser key, from stored sketches."""
    union = F.hll_sketch_estimate(F.hll_union_agg(sketch))
    return sketches.groupBy(*keys).agg(union.alias(into))


def relative_error(precision: int = PRECISION, deviations: float = 3.0) -> float:
    """The bound that an estimate keeps to, but for one in a few hundred at three deviations."""
    return deviations * 1.04 / 2 ** (precision / 2)


def within(estimate: Column, exact: Column, precision: int = PRECISION) -> Column:
    """Whether an estimate is as near to the exact number as stated; one value more or less is."""
    return F.abs(estimate - exact) <= F.greatest(F.lit(1.0), exact * relative_error(precision))

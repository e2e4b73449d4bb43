"""Sums, means and rates that give the same digits whatever the task order.

A sum of doubles depends on which task adds first. Here every value is split
into whole units and millionths, both summed as integers, which is as fast as
summing doubles and needs no decimal per row. ``scale`` digits of every value count,
six unless asked for more; at six the integers hold for some 10^12 rows of 10^6
each, and every further digit takes a tenth of that. NaN and infinity give what
Spark's own sum and mean give.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SCALE = 6


def _odd(value: Column | str) -> Column:
    """NaN and infinities, null for every other value."""
    number = _column(value).cast("double")
    return F.when(F.isnan(number) | (F.abs(number) == float("inf")), number)


def exact_sum(value: Column | str, scale: int = SCALE) -> Column:
    """Aggregate: the exact sum as a decimal; nulls are skipped, NaN and infinity make it null."""
    number = _column(value).cast("double")
    number = F.when(_odd(value).isNull(), number)
    whole = F.floor(number)
    parts = F.rint((number - whole) * 10**scale).cast("long")
    exact = (
        F.sum(whole).cast("decimal(20,0)")
        + F.sum(parts).cast("decimal(20,0)") * F.lit(f"{10**-scale:.{scale}f}").cast(f"decimal({scale},{scale})")
    ).cast(f"decimal({22 + scale},{scale})")
    return F.when(F.count(_odd(value)) == 0, exact)


def exact_mean(value: Column | str, scale: int = SCALE) -> Column:
    """Aggregate: the mean as a decimal; null if there is no value, or NaN or infinity."""
    return F.try_divide(exact_sum(value, scale), F.count(value).cast("decimal(20,0)"))


def total(value: Column | str, digits: int = 2, scale: int = SCALE) -> Column:
    """Aggregate: exact sum, rounded half up."""
    exact = F.round(exact_sum(value, max(scale, digits)), digits).cast("double")
    return F.coalesce(exact, F.sum(_odd(value)))


def mean(value: Column | str, digits: int = 2, scale: int = SCALE) -> Column:
    """Aggregate: exact mean, rounded half up; nulls are skipped."""
    exact = F.round(exact_mean(value, max(scale, digits)), digits).cast("double")
    return F.coalesce(exact, F.sum(_odd(value)))


def percent(part: Column | str, whole: Column | str) -> Column:
    """``part`` of ``whole`` in percent; null when ``whole`` is zero."""
    return F.try_divide(_column(part), _column(whole)) * 100


def inverse_ratio(amount: Column | str, per: Column | str) -> Column:
    """1 / (amount / per); null instead of an error when either is zero."""
    return F.try_divide(F.lit(1.0), F.try_divide(_column(amount), _column(per)))


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value

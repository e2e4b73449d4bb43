"""Dates, weeks and durations."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


# A time of day with an optional fraction and zone, and whatever stands before it.
TIME_PART = r"^(.+?)[T ]\d{1,2}:\d{2}(?::\d{2}(?:\.\d+)?)?\s*(?:Z|[+-]\d{2}:?\d{2})?$"


def parsed_date(text: Column | str, pattern: str) -> Column:
    """Date in the given pattern, with or without a time after it.

    Null for text that fits neither.
    """
    column = F.col(text) if isinstance(text, str) else text
    before_time = F.regexp_extract(column, TIME_PART, 1)
    return F.coalesce(F.try_to_date(column, pattern), F.try_to_date(before_time, pattern))


def within_year(column: str, year: int) -> Column:
    """The rows of one year as a range on the raw column, which reaches the file scan."""
    return (F.col(column) >= F.lit(date(year, 1, 1))) & (F.col(column) < F.lit(date(year + 1, 1, 1)))


def iso_year(column: Column | str) -> Column:
    """The year that the ISO week of the date belongs to."""
    value = F.col(column) if isinstance(column, str) else column
    return F.year(F.date_add(F.date_trunc("week", value).cast("date"), 3))


def hours_between(start: str, end: str) -> Column:
    """Hours from ``start`` to ``end``, rounded half up to two digits."""
    seconds = F.unix_timestamp(F.col(end)) - F.unix_timestamp(F.col(start))
    return F.round(seconds / 3600, 2)

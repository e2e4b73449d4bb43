"""Cleaning of text columns: locale numbers, separated parts, codes and labels."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def locale_number(text: Column | str) -> Column:
    """``1.234,56`` -> 1234.56; text that is no number gives null."""
    return F.translate(text, ",.", ".").try_cast("double")


def decimal_comma(text: Column | str) -> Column:
    """``12,5`` -> 12.5; text that is no number gives null."""
    return F.translate(text, ",", ".").try_cast("double")


def part(text: Column | str, separator: str, index: int) -> Column:
    """The part at ``index`` between literal separators; null when there is none."""
    return F.get(F.split(text, re.escape(separator)), F.lit(index))


def last_part(text: Column | str, separator: str) -> Column:
    return F.element_at(F.split(text, re.escape(separator)), -1)


def zip5(text: Column | str) -> Column:
    """Five-digit postal code as text: drops a ``-nnnn`` tail, restores leading zeros."""
    head = F.trim(part(text, "-", 0))
    return F.when(F.length(head).between(1, 4), F.lpad(head, 5, "0")).otherwise(head)


def label(main: str, sub: str) -> Column:
    """``main sub``; a missing ``sub`` leaves the trailing space, a missing ``main`` null."""
    return F.concat(F.col(main), F.lit(" "), F.coalesce(F.col(sub), F.lit("")))


def registry_id(state: str, county: str, dataset_id: str) -> Column:
    return F.concat(F.col(state), F.lit("_"), F.col(county), F.lit("_"), F.col(dataset_id))

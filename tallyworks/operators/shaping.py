"""Renaming, flattening, nesting and uniting of columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def raw(name: str) -> Column:
    """A column by its literal name, which may hold dots or blanks."""
    return F.col(f"`{name}`")


def pick(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Only the named columns, each under its new name."""
    return df.select(*(raw(old).alias(new) for old, new in names.items()))


def typed(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """The named text columns cast to their types, the others as they are.

    Text that does not fit becomes null. All named columns must be there.
    """
    missing = [name for name in types if name not in df.columns]
    if missing:
        raise ValueError(f"columns not found: {missing}")
    kinds = {name: kind for name, kind in types.items() if kind != "string"}
    return df.select(
        *(raw(name).try_cast(kinds[name]).alias(name) if name in kinds else raw(name) for name in df.columns)
    )


def rejects(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Per column, how many non-null texts would not fit the type."""
    return df.agg(
        *(
            F.count_if(raw(name).isNotNull() & raw(name).try_cast(kind).isNull()).alias(name)
            for name, kind in types.items()
        )
    )


def lifted(struct: str, fields: Sequence[str], prefix: str | None = None) -> list[Column]:
    """Struct fields as top-level columns named ``<prefix>_<field>``."""
    lead = struct if prefix is None else prefix
    return [F.col(f"{struct}.{field}").alias(f"{lead}_{field}") for field in fields]


def unnested(df: DataFrame, array: str, fields: Sequence[str]) -> DataFrame:
    """One row per element of an array of structs, its fields lifted; empty arrays drop out."""
    rest = [name for name in df.columns if name != array]
    return df.select(*(raw(name) for name in rest), F.explode(array).alias("_item")).select(
        *(raw(name) for name in rest), *(F.col(f"_item.{field}").alias(field) for field in fields)
    )


def united(first: DataFrame, *others: DataFrame, allow_missing: bool = False) -> DataFrame:
    """All rows, columns matched by name, duplicates kept."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=allow_missing)
    return first

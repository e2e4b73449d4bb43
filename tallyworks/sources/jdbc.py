"""JDBC reads, in parallel where the caller names a numeric column to split on.

Connection options (url, user, password, driver) come from the caller and are
never stored here.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Split:
    """How to cut a read: ``parts`` ranges of ``column`` between two bounds.

    The bounds only place the cuts; rows outside them are read too.
    """

    column: str
    lower: int
    upper: int
    parts: int


def read_query(
    spark: SparkSession,
    connection: Mapping[str, str],
    query: str,
    split: Split | None = None,
    fetch_rows: int = 10_000,
) -> DataFrame:
    """The result of a remote query; joins inside the query run in the database.

    Filters and column choices made on the returned DataFrame are pushed into
    the wrapped query. Without a split one task reads everything.
    """
    reader = spark.read.format("jdbc").options(**connection).option("fetchsize", fetch_rows)
    if split is None:
        return reader.option("query", query).load()
    return (
        reader.option("dbtable", f"({query}) q")
        .option("partitionColumn", split.column)
        .option("lowerBound", split.lower)
        .option("upperBound", split.upper)
        .option("numPartitions", split.parts)
        .load()
    )


def read_table(
    spark: SparkSession, connection: Mapping[str, str], table: str, split: Split | None = None
) -> DataFrame:
    return read_query(spark, connection, f"SELECT * FROM {table}", split)


def find_split(
    spark: SparkSession,
    connection: Mapping[str, str],
    query: str,
    column: str,
    parts: int,
) -> Split | None:
    """A split over the column's range, asked from the database in one short query."""
    bounds = read_query(
        spark,
        connection,
        f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM ({query}) b",
    ).first()
    if bounds is None or bounds[0] is None:
        return None
    return Split(column, int(bounds[0]), int(bounds[1]), parts)

"""Small in-memory tables with declared schemas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks import schemas


def named_rows(
    spark: SparkSession, rows: Sequence[tuple], names: Sequence[str], slices: int | None = None
) -> DataFrame:
    """Tuples with column names; types follow the values."""
    df = spark.createDataFrame(list(rows)).toDF(*names)
    return df.repartition(slices) if slices else df


def typed_rows(
    spark: SparkSession, rows: Sequence[tuple], schema: str, slices: int | None = None
) -> DataFrame:
    """Tuples with a declared schema, which also allows no rows at all."""
    df = spark.createDataFrame(list(rows), schema)
    return df.repartition(slices) if slices else df


def people(spark: SparkSession, rows: Sequence[tuple[str, str, int]]) -> DataFrame:
    """(ID, Name, Age) rows in two slices."""
    return typed_rows(spark, rows, schemas.PEOPLE, slices=2)


def numbered_people(spark: SparkSession, rows: Sequence[tuple[str, str, int]]) -> DataFrame:
    """(Gender, Name, Age) rows with a generated ID: increasing, unique, not dense."""
    return named_rows(spark, rows, ["Gender", "Name", "Age"]).withColumn(
        "ID", F.monotonically_increasing_id()
    )

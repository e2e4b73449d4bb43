"""CSV and JSON files."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tallyworks.operators.shaping import typed


def csv_text(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """CSV with a header, every column as text.

    The files of a folder must all have the same header; one with other names or
    another order fails the job instead of filling the wrong columns.
    """
    reader = spark.read.option("header", True).option("sep", sep)
    names = reader.csv(path).schema
    return reader.schema(names).option("enforceSchema", False).csv(path)


def csv_typed(
    spark: SparkSession, path: str, types: Mapping[str, str], sep: str = ","
) -> DataFrame:
    """All columns of a CSV: the named ones with their types, the others as text.

    Columns are found by header name, whatever their order or number. There is
    no inference pass over the data; a value that does not fit becomes null.
    """
    return typed(csv_text(spark, path, sep), types)


def csv_inferred(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """CSV with types guessed from the data: one more pass over it, for exploration only."""
    return (
        spark.read.option("header", True)
        .option("inferSchema", True)
        .option("sep", sep)
        .csv(path)
    )


def json_lines(
    spark: SparkSession, path: str, schema: str | StructType | None = None
) -> DataFrame:
    """One JSON document per line; without a schema the data is read once to infer one."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def json_documents(
    spark: SparkSession, path: str, schema: str | StructType | None = None
) -> DataFrame:
    """A file, or a folder of files, that each hold one JSON value over several lines.

    A top-level array gives one row per element. Such a file cannot be split,
    so one task reads each file; subfolders are not visited.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.option("multiLine", True).json(path)

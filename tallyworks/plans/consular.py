"""Consular travel documents: a folder of multi-line JSON files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyworks.operators import aggregates
from tallyworks.sources import files


def load_documents(spark: SparkSession, folder: str, schema: str | None = None) -> DataFrame:
    return files.json_documents(spark, folder, schema)


def record_count(documents: DataFrame) -> DataFrame:
    return aggregates.row_count(documents, "records")

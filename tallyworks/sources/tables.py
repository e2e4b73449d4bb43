"""Parquet tables under a common folder, read with their declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyworks.schemas import TABLES


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{base.rstrip('/')}/{name}.parquet")

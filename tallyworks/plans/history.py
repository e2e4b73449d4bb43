"""Facts kept for years: stored by year, rerun in part, pruned by what a dimension asks for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks import sinks


def by_year(facts: DataFrame, date: str) -> DataFrame:
    return facts.withColumn("year", F.year(date))


def store_years(facts: DataFrame, date: str, path: str) -> DataFrame:
    """The facts in one subfolder per year, as read back."""
    dated = by_year(facts, date)
    sinks.write_partitioned(dated, path, ["year"])
    return facts.sparkSession.read.schema(dated.schema).parquet(path)


def calendar(facts: DataFrame) -> DataFrame:
    """The years that occur, with their number of days."""
    days = F.dayofyear(F.make_date(F.col("year"), F.lit(12), F.lit(31)))
    return facts.select("year").where("year IS NOT NULL").distinct().withColumn("days", days)


def sales_in_years(stored: DataFrame, years: DataFrame, chosen: Column, cents: Column) -> DataFrame:
    """Sales per year, for years that the dimension chooses.

    The filter is on the dimension only; at run time its years become a partition filter
    of the facts, so folders of other years are not read.
    """
    joined = stored.join(years.where(chosen), "year")
    return joined.groupBy("year", "days").agg(
        F.count("*").alias("sales"), F.sum(cents).alias("cents")
    )

"""Brazilian cities: locale numbers, largest cities, people per outlet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks import schemas
from tallyworks.functions import money, text
from tallyworks.sources import files


def load_cities(spark: SparkSession, path: str) -> DataFrame:
    return repaired(files.csv_typed(spark, path, schemas.BRAZIL_CITIES, sep=";"))


def repaired(cities: DataFrame) -> DataFrame:
    """``AREA`` as a number."""
    return cities.withColumn("AREA", text.locale_number("AREA"))


def largest_city(cities: DataFrame, by: str, into: str) -> DataFrame:
    """The city with the largest value, names that occur twice counting once."""
    return (
        cities.groupBy("CITY")
        .agg(F.max(by).alias(into))
        .orderBy(F.desc(into), "CITY")
        .limit(1)
    )


def most_populous(cities: DataFrame) -> DataFrame:
    return largest_city(cities, "IBGE_RES_POP", "population")


def widest(cities: DataFrame) -> DataFrame:
    return largest_city(cities, "AREA", "area")


def people_per_outlet(cities: DataFrame) -> DataFrame:
    """Inhabitants per outlet where the outlet count is known; null for zero outlets."""
    return cities.where(F.col("MAC").isNotNull()).select(
        "CITY", "IBGE_POP", "MAC", money.inverse_ratio("MAC", "IBGE_POP").alias("mac_density")
    )

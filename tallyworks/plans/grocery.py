"""Household spending per week: market against meals, and by category."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks import schemas
from tallyworks.functions import dates, money, text
from tallyworks.sources import files


def load_spending(spark: SparkSession, path: str) -> DataFrame:
    return tidy(files.csv_typed(spark, path, schemas.GROCERY))


def tidy(raw: DataFrame) -> DataFrame:
    """Numbers, dates and ISO weeks from text; plain column names."""
    return raw.withColumnsRenamed(
        {"sub-category": "subcategory", "main-category": "maincategory"}
    ).withColumns(
        {
            "value": text.decimal_comma("value"),
            "date": dates.parsed_date("date", "dd/MM/yyyy"),
            "week": F.weekofyear(dates.parsed_date("date", "dd/MM/yyyy")),
        }
    )


def with_iso_year(spending: DataFrame) -> DataFrame:
    """Adds ``year``, the year the ISO week belongs to, for data over several years."""
    return spending.withColumn("year", dates.iso_year("date"))


def market_and_meals(spending: DataFrame, by_year: bool = False) -> DataFrame:
    """Weekly market total beside total, mean and largest meal without a subcategory.

    Both sides come from one pass: a week stays if it has rows of both kinds,
    which is what joining the two weekly results keeps.
    """
    is_market = F.col("maincategory") == "market"
    is_meal = (F.col("maincategory") == "meal") & F.col("subcategory").isNull()
    value = F.col("value")
    keys = ["year", "week"] if by_year else ["week"]
    rows = with_iso_year(spending) if by_year else spending
    return (
        rows.where(is_market | is_meal)
        .groupBy(*keys)
        .agg(
            F.count_if(is_market).alias("_market"),
            F.count_if(is_meal).alias("_meal"),
            money.exact_sum(F.when(is_meal, value)).cast("double").alias("meal_total_weekly_spending"),
            money.mean(F.when(is_meal, value)).alias("avg_meal_expending"),
            F.max(F.when(is_meal, value)).alias("higher_expending"),
            money.total(F.when(is_market, value)).alias("market_expending"),
        )
        .where((F.col("_market") > 0) & (F.col("_meal") > 0) & F.col("week").isNotNull())
        .drop("_market", "_meal")
    )


def spending_by_category(
    spending: DataFrame, by_year: bool = False, ordered: bool = True
) -> DataFrame:
    """Weekly spending per category with its label."""
    keys = ["year", "week"] if by_year else ["week"]
    rows = with_iso_year(spending) if by_year else spending
    labelled = (
        rows.groupBy(*keys, "maincategory", "subcategory")
        .agg(money.total("value").alias("expending"))
        .withColumn("category", text.label("maincategory", "subcategory"))
    )
    return labelled.orderBy(*keys, "category") if ordered else labelled

"""Retail sales: locations, discounts, monthly category totals, published tables."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks import schemas, sinks
from tallyworks.functions import dates, money, rules
from tallyworks.operators import aggregates, joins, windows
from tallyworks.sources import files

# File headers and the names used from here on.
SALES_NAMES = {
    "Store ID": "store_id",
    "Product ID": "product_id",
    "Units Sold": "units_sold",
    "Sales Revenue (USD)": "sales_revenue_usd",
    "Store Location": "store_location",
    "Discount Percentage": "discount_percentage",
    "Product Category": "product_category",
    "Day of the Week": "day_of_week",
}


def load_sales(spark: SparkSession, path: str) -> DataFrame:
    return tidy_sales(files.csv_typed(spark, path, schemas.RETAIL_SALES))


def tidy_sales(raw: DataFrame) -> DataFrame:
    """Plain column names; revenue rounded to one digit."""
    return raw.withColumnsRenamed(SALES_NAMES).withColumn(
        "sales_revenue_usd", F.round("sales_revenue_usd", 1)
    )


def distinct_locations(sales: DataFrame) -> DataFrame:
    known = sales.where(F.col("store_location").isNotNull())
    return aggregates.distinct_count(known, "store_location", "locations")


def discounted(sales: DataFrame) -> DataFrame:
    return sales.where(F.col("discount_percentage") > 0)


def discounted_sales(sales: DataFrame) -> DataFrame:
    return aggregates.row_count(discounted(sales), "discounted_sales")


def top_locations(sales: DataFrame, k: int = 10) -> DataFrame:
    return top_counted(aggregates.count_by(sales, "store_location"), k)


def top_counted(counted: DataFrame, k: int = 10) -> DataFrame:
    return counted.orderBy(F.desc("count"), F.asc("store_location")).limit(k)


def with_good_store(locations: DataFrame, above: int = 150) -> DataFrame:
    return locations.withColumn("is_good_store", rules.good_store("count", above))


def with_good_store_udf(locations: DataFrame, above: int = 150) -> DataFrame:
    """The same flag through a typed pandas UDF, kept as the one example of such.

    Catalyst cannot look into it and columns travel to Python, a batch at a time;
    prefer ``with_good_store``.
    """

    @F.pandas_udf("boolean")
    def is_good(counts: pd.Series) -> pd.Series:
        return (counts > above).where(counts.notna(), None)

    return locations.withColumn("is_good_store", is_good("count"))


def publish_locations(
    locations: DataFrame, table: str = "sales_per_location", path: str | None = None
) -> DataFrame:
    return sinks.write_bucketed(locations, table, "store_location", buckets=3, path=path)


def write_by_store(sales: DataFrame, path: str, fmt: str = "parquet") -> None:
    sinks.write_partitioned(sales, path, ["store_id", "store_location"], fmt)


def monthly_category_summary(sales: DataFrame, year: int = 2022, ordered: bool = True) -> DataFrame:
    """Units and revenue per category and month of one year.

    The year is a range on ``Date``, so file statistics can skip other years.
    """
    summary = (
        sales.where(dates.within_year("Date", year))
        .groupBy("product_category", F.year("Date").alias("year"), F.month("Date").alias("month"))
        .agg(
            F.sum("units_sold").alias("units_sold_total"),
            money.total("sales_revenue_usd").alias("revenue_total"),
        )
    )
    return summary.orderBy("month", "product_category") if ordered else summary


def category_running_total(summary: DataFrame) -> DataFrame:
    """Units accumulated month by month per category, over at most twelve rows each."""
    return windows.running_total(
        summary.drop("revenue_total"),
        "units_sold_total",
        ["product_category"],
        ["month"],
        "RunningTotal",
    )


def order_lines(orders: DataFrame, products: DataFrame) -> DataFrame:
    """Order lines with product names; the quantity is the ordered one."""
    return joins.lookup(orders, products.drop("qty"), "prod_id").select(
        "order_id", "prod_id", "prod_name", "unit_price", "list_price", "qty"
    )


def unique_people(people: DataFrame) -> DataFrame:
    """One row per name and age, youngest first; the smallest ID stays."""
    return aggregates.one_per_key(people, ["Name", "Age"], ["ID"]).orderBy(
        F.col("Age").asc(), "Name"
    )

"""Marketplace orders: customers, baskets, products per place, delivery and cancellation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks import schemas
from tallyworks.functions import dates, money, rules
from tallyworks.operators import aggregates, joins, windows
from tallyworks.sources import files

# Order states.
DELIVERED, CANCELED, UNAVAILABLE = "delivered", "canceled", "unavailable"


def load_products(spark: SparkSession, base: str) -> DataFrame:
    return files.csv_typed(spark, f"{base}/olist_products_dataset.csv", schemas.OLIST_PRODUCTS)


def load_orders(spark: SparkSession, base: str) -> DataFrame:
    """One row per order; in purchase order only if the caller sorts the final view."""
    raw = files.csv_typed(spark, f"{base}/olist_orders_dataset.csv", schemas.OLIST_ORDERS)
    return aggregates.one_per_key(raw, ["order_id"], ["order_purchase_timestamp"])


def load_order_items(spark: SparkSession, base: str) -> DataFrame:
    path = f"{base}/olist_order_items_dataset.csv"
    return files.csv_typed(spark, path, schemas.OLIST_ORDER_ITEMS)


def load_customers(spark: SparkSession, base: str) -> DataFrame:
    return files.csv_typed(spark, f"{base}/olist_customers_dataset.csv", schemas.OLIST_CUSTOMERS)


def load_geo(spark: SparkSession, base: str) -> DataFrame:
    path = f"{base}/olist_geolocation_dataset.csv"
    return one_place_per_zip(files.csv_typed(spark, path, schemas.OLIST_GEOLOCATION))


def one_place_per_zip(geo: DataFrame) -> DataFrame:
    """One row per zip prefix: the first by city, then state."""
    return aggregates.one_per_key(
        geo.select("geolocation_zip_code_prefix", "geolocation_city", "geolocation_state"),
        ["geolocation_zip_code_prefix"],
        ["geolocation_city", "geolocation_state"],
    )


def orders_by_status(orders: DataFrame) -> DataFrame:
    return aggregates.count_by(orders, "order_status")


def repeat_customers(orders: DataFrame) -> DataFrame:
    return (
        orders.groupBy("customer_id")
        .agg(F.count("order_id").alias("purchases"))
        .where(F.col("purchases") > 1)
    )


def customer_average_order(
    items: DataFrame,
    orders: DataFrame,
    left_out: tuple[str, ...] = (CANCELED, UNAVAILABLE),
    ordered: bool = True,
) -> DataFrame:
    """Purchases and mean order value per customer, an order's value being the mean of its lines.

    A mean of means, so the two levels stay apart. The first one leaves the
    lines partitioned by order, which the join then uses as it is. Orders with
    an unknown status are left out together with the named ones.
    """
    line = F.col("price") * F.col("order_item_id") + F.col("freight_value")
    per_order = items.groupBy("order_id").agg(money.exact_mean(line).alias("order_total_avg"))
    kept = orders.where(~F.col("order_status").isin(*left_out)).select("order_id", "customer_id")
    result = (
        joins.large_join(per_order, kept, "order_id")
        .groupBy("customer_id")
        .agg(
            F.count("order_id").alias("purchases"),
            F.round(F.avg("order_total_avg"), 2).cast("double").alias("total_avg"),
        )
    )
    return result.orderBy(F.desc("purchases"), "customer_id") if ordered else result


def spending_tiers(averages: DataFrame, normal: float = 100, prime: float = 250) -> DataFrame:
    return averages.withColumn("category", rules.spending_tier("total_avg", normal, prime))


def largest_basket(items: DataFrame) -> DataFrame:
    return items.agg(F.max("order_item_id").alias("max_num_items_sold"))


def sold_products(
    items: DataFrame, orders: DataFrame, customers: DataFrame, geo: DataFrame
) -> DataFrame:
    """Product, state and city of every line.

    The place is brought to the customers, then to the orders, and meets the
    many lines last, so only two narrow columns travel along.
    """
    place = joins.lookup(
        customers.select("customer_id", F.col("customer_zip_code_prefix").alias("zip")),
        geo.select(
            F.col("geolocation_zip_code_prefix").alias("zip"),
            F.col("geolocation_state").alias("state"),
            F.col("geolocation_city").alias("city"),
        ),
        "zip",
    )
    order_place = joins.lookup(
        orders.select("order_id", "customer_id"), place.drop("zip"), "customer_id"
    ).drop("customer_id")
    lines = items.select("order_id", F.col("product_id").alias("product"))
    return joins.large_join(lines, order_place, "order_id").drop("order_id")


def products_by_city(sold: DataFrame, ordered: bool = True) -> DataFrame:
    """Lines sold per state, city and product."""
    counted = sold.groupBy("state", "city", "product").agg(F.count("product").alias("qtd"))
    return counted.orderBy("state", "city", F.desc("product")) if ordered else counted


def top_product(sold: DataFrame, place: str = "state") -> DataFrame:
    """The product sold most in each state (or city); of equals, the first by id.

    Counted from the lines: adding up the counts per city would shuffle twice.
    """
    sales = sold.groupBy(place, "product").agg(F.count("product").alias("total_sales"))
    return windows.top_k(sales, [place], [F.desc("total_sales"), F.asc("product")], 1).select(
        place, "product", "total_sales"
    )


def units_per_category(items: DataFrame, products: DataFrame, ordered: bool = True) -> DataFrame:
    """Units per category. Units are summed per product first, so the join meets each product once."""
    totals = aggregates.sums_through(
        items,
        products.select("product_id", F.col("product_category_name").alias("category")),
        "product_id",
        ["category"],
        {"total": F.sum("order_item_id")},
    )
    return totals.orderBy(F.desc("total"), "category") if ordered else totals


def buyers_per_state(
    items: DataFrame, orders: DataFrame, customers: DataFrame, ordered: bool = True
) -> DataFrame:
    """Customers with at least one order that has items, counted per state."""
    sold = joins.matched(orders.select("order_id", "customer_id"), items, "order_id")
    buyers = joins.matched(
        customers.select("customer_id", F.col("customer_state").alias("state")),
        sold,
        "customer_id",
    )
    counted = aggregates.count_by(buyers, "state")
    return counted.orderBy(F.desc("count"), "state") if ordered else counted


def never_bought(customers: DataFrame, orders: DataFrame) -> DataFrame:
    return joins.unmatched(customers, orders, "customer_id")


def delivery_hours_by_state(
    orders: DataFrame, customers: DataFrame, delivered: str = DELIVERED, ordered: bool = True
) -> DataFrame:
    """Mean hours from carrier to customer per state, from sums and counts per customer."""
    hours = orders.where(F.col("order_status") == delivered).select(
        "customer_id",
        dates.hours_between("order_delivered_carrier_date", "order_delivered_customer_date").alias(
            "hours"
        ),
    )
    totals = aggregates.sums_through(
        hours,
        customers,
        "customer_id",
        ["customer_state"],
        {"hours": money.exact_sum("hours"), "deliveries": F.count("hours")},
    )
    averages = totals.select(
        "customer_state",
        F.round(F.try_divide("hours", "deliveries"), 2).cast("double").alias("delivery_time_avg"),
    )
    return averages.orderBy(F.desc("delivery_time_avg"), "customer_state") if ordered else averages


def cancellation_rate(
    orders: DataFrame, canceled: str = CANCELED, by_year: bool = False
) -> DataFrame:
    """Canceled share per month number; years fall together unless ``by_year``."""
    bought = F.col("order_purchase_timestamp")
    dated = orders.select(
        "order_status", F.year(bought).alias("orders_year"), F.month(bought).alias("orders_month")
    )
    keys = ["orders_year", "orders_month"] if by_year else ["orders_month"]
    return aggregates.share_by(
        dated,
        keys,
        F.col("order_status") == canceled,
        "total_cancelled",
        "total_orders_month",
        "rate_cancelled_month",
    ).select(*keys, "total_orders_month", "total_cancelled", "rate_cancelled_month")


def late_delivery_rate(
    orders: DataFrame, delivered: str = DELIVERED, ordered: bool = True
) -> DataFrame:
    """Share of deliveries after the estimate, per month of purchase, newest first."""
    arrived = F.col("order_delivered_customer_date")
    bought = F.col("order_purchase_timestamp")
    dated = orders.where((F.col("order_status") == delivered) & arrived.isNotNull()).select(
        F.year(bought).alias("year"),
        F.month(bought).alias("month"),
        (arrived > F.col("order_estimated_delivery_date")).alias("late"),
    )
    rates = aggregates.share_by(
        dated,
        ["year", "month"],
        F.col("late"),
        "num_late_deliveries",
        "total_orders",
        "percentage",
        digits=2,
    )
    return rates.orderBy(F.desc("year"), F.desc("month")) if ordered else rates

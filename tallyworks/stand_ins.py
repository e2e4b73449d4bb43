"""The test tables in the shapes the plans expect.

The original files are not at hand, so each function below selects columns of
the star schema and event tables under the names of a dataset. Only names and
simple expressions change; rows are never cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.operators import aggregates, joins
from tallyworks.sources.tables import read_table


class Tables:
    """The tables below one folder."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base

    def read(self, name: str) -> DataFrame:
        return read_table(self.spark, self.base, name)

    # --- retail ---------------------------------------------------------------

    def sale_lines(self) -> DataFrame:
        return self.read("lineitem").select(
            F.col("l_suppkey").alias("store_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_shipdate").alias("Date"),
            F.col("l_quantity").cast("int").alias("units_sold"),
            F.round("l_extendedprice", 1).alias("sales_revenue_usd"),
            F.col("l_discount").alias("discount_percentage"),
        )

    def categorised_sales(self) -> DataFrame:
        kinds = self.read("part").select(
            F.col("p_partkey").alias("product_id"), F.col("p_type").alias("product_category")
        )
        return joins.lookup(self.sale_lines(), kinds, "product_id")

    def located_customers(self) -> DataFrame:
        """Customers with the name of their nation as the location."""
        nations = self.read("nation").select(
            F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("store_location")
        )
        return joins.lookup(self.read("customer"), nations, "c_nationkey")

    def sales_per_location(self) -> DataFrame:
        """Orders counted per nation of their customer."""
        return aggregates.sums_through(
            self.read("orders").select(F.col("o_custkey").alias("c_custkey")),
            self.located_customers(),
            "c_custkey",
            ["store_location"],
            {"count": F.count("*")},
        )

    def order_lines(self) -> DataFrame:
        return self.read("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("prod_id"),
            F.col("l_extendedprice").alias("unit_price"),
            F.col("l_quantity").alias("qty"),
        )

    def products_in_stock(self) -> DataFrame:
        return self.read("part").select(
            F.col("p_partkey").alias("prod_id"),
            F.col("p_name").alias("prod_name"),
            F.col("p_retailprice").alias("list_price"),
            F.col("p_size").alias("qty"),
        )

    # --- marketplace ------------------------------------------------------------

    def items(self) -> DataFrame:
        return self.read("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("order_item_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_extendedprice").alias("price"),
            F.col("l_quantity").alias("freight_value"),
        )

    def orders(self) -> DataFrame:
        return self.read("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderstatus").alias("order_status"),
            F.col("o_orderdate").alias("order_purchase_timestamp"),
        )

    def delivered_orders(self) -> DataFrame:
        """One row per line: ordered and due on the order date, delivered on the ship date."""
        shipped = self.read("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_shipdate").alias("order_delivered_customer_date"),
        )
        ordered = F.col("order_purchase_timestamp")
        return (
            joins.large_join(shipped, self.orders(), "order_id")
            .withColumn("order_delivered_carrier_date", ordered)
            .withColumn("order_estimated_delivery_date", ordered)
        )

    def products(self) -> DataFrame:
        return self.read("part").select(
            F.col("p_partkey").alias("product_id"), F.col("p_type").alias("product_category_name")
        )

    def customers(self) -> DataFrame:
        return self.located_customers().select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_nationkey").cast("string").alias("customer_zip_code_prefix"),
            F.col("store_location").alias("customer_state"),
        )

    def geo(self) -> DataFrame:
        regions = self.read("region").select(
            F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("geolocation_state")
        )
        return joins.lookup(self.read("nation"), regions, "n_regionkey").select(
            F.col("n_nationkey").cast("string").alias("geolocation_zip_code_prefix"),
            F.col("n_name").alias("geolocation_city"),
            "geolocation_state",
        )

    # --- shipments and restaurants ------------------------------------------------

    def shipments(self) -> DataFrame:
        """One document per customer (or part of one) with its orders as books."""
        orders = self.read("orders").select(
            F.col("o_custkey").alias("c_custkey"),
            F.col("o_orderkey").alias("qty"),
            F.col("o_orderpriority").alias("title"),
        )
        owners = self.located_customers().select(
            "c_custkey", "c_name", "c_mktsegment", "store_location"
        )
        documents = aggregates.nested_under(
            owners,
            orders,
            ["c_custkey"],
            ["qty", "title"],
            "books",
            part_by=F.pmod("qty", F.lit(4)),
        )

        def party(name: Column, country: Column) -> Column:
            return F.struct(
                name.alias("name"),
                F.lower(country).alias("city"),
                F.substring(country, 1, 3).alias("state"),
                country.alias("country"),
            )

        return documents.select(
            party(F.col("c_mktsegment"), F.col("store_location")).alias("supplier"),
            party(F.col("c_name"), F.col("store_location")).alias("customer"),
            "books",
        )

    def first_registry(self) -> DataFrame:
        """Suppliers as the flat, all-text registry."""
        opened = F.date_add(F.lit("2000-01-01").cast("date"), F.col("s_suppkey").cast("int"))
        return self.read("supplier").select(
            F.col("s_suppkey").cast("string").alias("HSISID"),
            F.col("s_name").alias("NAME"),
            F.concat(F.col("s_nationkey").cast("string"), F.lit(" Main St")).alias("ADDRESS1"),
            F.lit(None).cast("string").alias("ADDRESS2"),
            F.lit("RALEIGH").alias("CITY"),
            F.lit("NC").alias("STATE"),
            F.lpad(F.col("s_nationkey").cast("string"), 5, "0").alias("POSTALCODE"),
            F.lit(None).cast("string").alias("PHONENUMBER"),
            F.date_format(opened, "yyyy-MM-dd").alias("RESTAURANTOPENDATE"),
            F.lit("Restaurant").alias("FACILITYTYPE"),
            F.col("s_nationkey").cast("string").alias("X"),
            F.lit("1.5").alias("Y"),
        )

    def second_registry(self) -> DataFrame:
        """Customers as the nested registry; some have a type without a second part."""
        segment = F.col("c_mktsegment")
        nation = F.col("c_nationkey")
        return self.read("customer").select(
            F.struct(
                F.col("c_custkey").cast("string").alias("id"),
                F.col("c_name").alias("premise_name"),
                segment.alias("premise_address1"),
                F.lit(None).cast("string").alias("premise_address2"),
                F.lit("DURHAM").alias("premise_city"),
                F.lit("NC").alias("premise_state"),
                F.lpad(nation.cast("string"), 5, "0").alias("premise_zip"),
                F.lit(None).cast("string").alias("premise_phone"),
                F.lit("2003-05-07").alias("opening_date"),
                F.when(segment == "BUILDING", "2010-05-04T00:00:00Z")
                .when(nation == 3, F.concat(F.lit("closed in "), segment))
                .alias("closing_date"),
                F.when(segment == "MACHINERY", segment)
                .otherwise(F.concat(F.lit("1 - "), segment))
                .alias("type_description"),
                F.array(nation.cast("double"), F.lit(2.5)).alias("geolocation"),
            ).alias("fields")
        )

    def businesses(self) -> DataFrame:
        return self.located_customers().select(
            F.col("c_custkey").alias("business_id"),
            F.col("c_name").alias("name"),
            F.col("c_mktsegment").alias("address"),
            F.col("store_location").alias("city"),
            F.lit("NC").alias("state"),
            F.col("c_nationkey").cast("string").alias("postal_code"),
            F.col("c_acctbal").alias("latitude"),
            F.lit(2.5).alias("longitude"),
            F.lit(None).cast("string").alias("phone_number"),
        )

    def inspections(self) -> DataFrame:
        """Orders as inspections: the score is the price in steps of five thousand."""
        return self.read("orders").select(
            F.col("o_custkey").alias("business_id"),
            F.floor(F.col("o_totalprice") / 5000).cast("int").alias("score"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
            F.col("o_orderpriority").alias("type"),
        )

    # --- rentals --------------------------------------------------------------------

    def loans(self) -> DataFrame:
        """Lines as rentals by shipping date, without their customers."""
        return self.read("lineitem").select(
            F.col("l_partkey").alias("film_id"), F.col("l_shipdate").alias("rental_date")
        )

    def rental(self) -> DataFrame:
        """Orders as rentals; those with status O are still out."""
        date = F.col("o_orderdate")
        return self.read("orders").select(
            F.col("o_orderkey").alias("inventory_id"),
            F.col("o_custkey").alias("customer_id"),
            date.alias("rental_date"),
            F.when(F.col("o_orderstatus") != "O", date).alias("return_date"),
        )

    def inventory(self) -> DataFrame:
        return self.read("lineitem").select(
            F.col("l_orderkey").alias("inventory_id"),
            F.col("l_partkey").alias("film_id"),
            F.col("l_suppkey").alias("store_id"),
        )

    def films(self) -> DataFrame:
        return self.read("part").select(
            F.col("p_partkey").alias("film_id"),
            F.col("p_name").alias("title"),
            F.col("p_type").alias("category"),
            F.col("p_retailprice").alias("rental_rate"),
        )

    def measured_films(self) -> DataFrame:
        """Films with the numbers that may tell how often they are rented."""
        return self.read("part").select(
            F.col("p_partkey").alias("film_id"),
            F.col("p_size").alias("rental_duration"),
            F.col("p_retailprice").alias("rental_rate"),
        )

    def renters(self) -> DataFrame:
        return self.located_customers().select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("first_name"),
            F.concat(F.lower("c_mktsegment"), F.lit("@example.com")).alias("email"),
            F.col("store_location").alias("country"),
        )

    # --- civic and economic -----------------------------------------------------------

    def attendance(self) -> DataFrame:
        """Orders as attendance: whole prices per customer and year."""
        price = F.floor("o_totalprice")
        return self.read("orders").select(
            F.year("o_orderdate").alias("SchoolYear"),
            F.col("o_custkey").alias("school_id"),
            price.alias("Enrolled"),
            price.alias("Absent"),
        )

    def yearly_prices(self) -> DataFrame:
        return self.read("orders").select(
            F.year("o_orderdate").alias("SchoolYear"), F.col("o_totalprice").alias("Enrolled")
        )

    def labelled_customers(self) -> DataFrame:
        return self.read("customer").select(
            F.col("c_custkey").alias("GEO.id2"),
            F.replace("c_name", F.lit("#"), F.lit(", ")).alias("GEO.display-label"),
        )

    def campuses(self) -> DataFrame:
        """Customers as campuses whose address ends in the nation code as ZIP+4."""
        zip_plus = F.concat(F.lpad(F.col("c_nationkey").cast("string"), 5, "0"), F.lit("-0001"))
        return self.read("customer").select(
            F.col("c_name").alias("LocationName"),
            F.when(F.col("c_mktsegment") == "MACHINERY", "Additional Location")
            .otherwise("Institution")
            .alias("LocationType"),
            F.concat(F.lit("1 Main St "), zip_plus).alias("Address"),
        )

    def county_zips(self) -> DataFrame:
        return self.read("nation").select(
            F.col("n_nationkey").alias("zip"), F.col("n_regionkey").alias("county")
        )

    def census(self) -> DataFrame:
        return self.read("region").select(
            F.col("r_regionkey").alias("id"), F.col("r_name").alias("label")
        )

    def cities(self) -> DataFrame:
        """Customers as cities named after their nation, the balance written as 1.234,56."""
        return self.located_customers().select(
            F.col("store_location").alias("CITY"), written(F.col("c_acctbal")).alias("AREA")
        )

    def outlets(self) -> DataFrame:
        return self.read("lineitem").select(
            F.col("l_orderkey").alias("CITY"),
            F.col("l_quantity").alias("IBGE_POP"),
            F.round(F.col("l_discount") * 100).cast("long").alias("MAC"),
        )

    def spending(self) -> DataFrame:
        """Events as spending: purchases are market, clicks are meals, small keys lack a subcategory."""
        key = F.get_json_object("props", "$.k").cast("int")
        kind = F.col("event_type")
        return self.read("events").select(
            F.date_format("ts", "dd/MM/yyyy").alias("date"),
            F.replace(F.col("value").cast("string"), F.lit("."), F.lit(",")).alias("value"),
            F.when(kind == "purchase", "market")
            .when(kind == "click", "meal")
            .otherwise(kind)
            .alias("main-category"),
            F.when(key >= 50, "large").alias("sub-category"),
        )

    # --- clicks and images ------------------------------------------------------------

    def clicks(self) -> DataFrame:
        return self.read("events").select(
            F.lit("192.0.2.1").alias("ip"),
            "user_id",
            F.lit("agent").alias("user_agent"),
            F.concat_ws("-", F.col("user_id"), F.date_format("ts", "yyyyMMdd")).alias("session_id"),
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("event_time"),
            F.col("event_type").alias("event_name"),
            F.lit("web").alias("channel"),
            F.struct(F.get_json_object("props", "$.k").alias("query")).alias("metadata"),
        )

    def click_lines(self) -> DataFrame:
        """Clicks as JSON lines; some lack their end, some hold a name where a number belongs."""
        kind, line = F.col("user_id") % 10, F.col("value")
        cut = F.substring(line, F.lit(1), F.length(line) - 9)
        named = F.regexp_replace(line, r'"user_id":(\d+)', r'"user_id":"x$1"')
        lines = self.clicks().withColumn("value", F.to_json(F.struct("*")))
        return lines.select(F.when(kind == 3, cut).when(kind == 7, named).otherwise(line).alias("value"))

    def supplier_photos(self) -> DataFrame:
        """One JPEG start per supplier; every tenth has five long colour profiles in front."""
        profile = F.concat(F.unhex(F.lit("FFE2FFFF")), F.unhex(F.repeat(F.lit("00"), 65533)))
        photo = jpeg_header(F.col("s_name"), F.lit("2020:01:02 03:04:05"))
        rest = F.expr("substring(photo, 3)")
        number = F.col("s_suppkey")
        return self.read("supplier").select(number, photo.alias("photo")).select(
            F.concat(F.lit("supplier-"), number, F.lit(".jpg")).alias("path"),
            F.when(number % 10 == 0, F.concat(F.substring("photo", 1, 2), *[profile] * 5, rest))
            .otherwise(F.col("photo"))
            .alias("content"),
        )

    def photos(self) -> DataFrame:
        """One JPEG header per order: priority as make, order date as date; none for status P."""
        make = F.col("o_orderpriority")
        taken = F.date_format("o_orderdate", "yyyy:MM:dd HH:mm:ss")
        return self.read("orders").select(
            F.concat(F.lit("order-"), F.col("o_orderkey"), F.lit(".jpg")).alias("path"),
            F.when(F.col("o_orderstatus") == "P", F.unhex(F.lit("FFD8FFDA0002")))
            .otherwise(jpeg_header(make, taken))
            .alias("content"),
        )


def written(amount: Column) -> Column:
    """A number as 1.234,56."""
    return F.translate(F.format_number(amount, 2), ",.", ".,")


def jpeg_header(make: Column, taken: Column) -> Column:
    """A JPEG start with an EXIF block (big-endian) that holds two texts."""
    make_text = F.concat(F.encode(make, "US-ASCII"), F.unhex(F.lit("00")))
    taken_text = F.concat(F.encode(taken, "US-ASCII"), F.unhex(F.lit("00")))
    make_size, taken_size = F.length(make_text), F.length(taken_text)

    def number(value: Column, digits: int) -> Column:
        return F.unhex(F.lpad(F.hex(value.cast("long")), digits, "0"))

    def entry(tag: int, kind: int, size: Column, value: Column) -> Column:
        return F.concat(number(F.lit(tag), 4), number(F.lit(kind), 4), number(size, 8), number(value, 8))

    # Layout: header 8, main folder 30 (two entries), EXIF folder 18 (one entry), texts.
    exif_at, texts_at = F.lit(8 + 30), F.lit(8 + 30 + 18)
    tiff = F.concat(
        F.unhex(F.lit("4D4D002A00000008")),
        F.unhex(F.lit("0002")),
        entry(271, 2, make_size, texts_at),
        entry(34665, 4, F.lit(1), exif_at),
        F.unhex(F.lit("00000000")),
        F.unhex(F.lit("0001")),
        entry(36867, 2, taken_size, texts_at + make_size),
        F.unhex(F.lit("00000000")),
        make_text,
        taken_text,
    )
    block = F.concat(F.encode(F.lit("Exif"), "US-ASCII"), F.unhex(F.lit("0000")), tiff)
    return F.concat(
        F.unhex(F.lit("FFD8FFE1")), number(F.length(block) + 2, 4), block, F.unhex(F.lit("FFDA0002"))
    )

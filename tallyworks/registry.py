"""Every query by name, over the test tables, with the SQL that gives the same rows.

``QUERIES`` maps a name to a function of (session, folder of tables).
``ORACLES`` maps it to SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks import schemas, session, sinks
from tallyworks.functions import dates, rules, text
from tallyworks.operators import aggregates, joins, sampling, shaping, sketches, windows
from tallyworks.plans import (
    brazil,
    census,
    consular,
    grocery,
    history,
    olist,
    rental,
    restaurants,
    retail,
    schools,
    shipments,
)
from tallyworks.sources import exif, files
from tallyworks.stand_ins import Tables, written
from tallyworks.streaming import batches, clicks

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Stand-ins for the named values of the original datasets.
LEFT_OUT_STATUS = ("P",)
DELIVERED_STATUS = "F"
CANCELED_STATUS = "F"
COUNTRY = "NATION_7"
CUSTOMER = 148
SALES_YEAR = 1997
TIERS = (200_000, 260_000)
PASS_MARK = 50


def query(sql: str | None) -> Callable[[Callable[[Tables], DataFrame]], Callable]:
    def add(build: Callable[[Tables], DataFrame]) -> Callable:
        QUERIES[build.__name__] = lambda spark, base: build(Tables(spark, base))
        if sql:
            ORACLES[build.__name__] = sql
        return build

    return add


# --- retail ---------------------------------------------------------------------


@query("""
    SELECT count(DISTINCT n_name) AS locations
    FROM customer JOIN nation ON n_nationkey = c_nationkey
""")
def distinct_locations(t: Tables) -> DataFrame:
    return retail.distinct_locations(t.located_customers())


@query("SELECT count(*) AS discounted_sales FROM lineitem WHERE l_discount > 0")
def discounted_sales(t: Tables) -> DataFrame:
    return retail.discounted_sales(t.sale_lines())


TOP_LOCATIONS_SQL = """
    SELECT n_name AS store_location, count(*) AS count, count(*) > 150 AS is_good_store
    FROM orders
    JOIN customer ON c_custkey = o_custkey
    JOIN nation ON n_nationkey = c_nationkey
    GROUP BY n_name
    ORDER BY count(*) DESC, n_name
    LIMIT 10
"""


@query(TOP_LOCATIONS_SQL)
def top_locations_good(t: Tables) -> DataFrame:
    return retail.with_good_store(retail.top_counted(t.sales_per_location()))


@query(TOP_LOCATIONS_SQL)
def top_locations_good_udf(t: Tables) -> DataFrame:
    return retail.with_good_store_udf(retail.top_counted(t.sales_per_location()))


@query(TOP_LOCATIONS_SQL)
def bucketed_publish(t: Tables) -> DataFrame:
    return retail.publish_locations(
        top_locations_good(t), path=session.new_shared_folder(t.spark, "sales-per-location")
    )


@query("""
    SELECT o_orderstatus AS store_id, o_orderpriority AS store_location, count(*) AS count
    FROM orders GROUP BY ALL
""")
def partitioned_write(t: Tables) -> DataFrame:
    sales = t.read("orders").withColumnsRenamed(
        {"o_orderstatus": "store_id", "o_orderpriority": "store_location"}
    )
    path = session.new_shared_folder(t.spark, "sales-by-store")
    retail.write_by_store(sales, path, fmt="json")
    stored = "o_orderkey BIGINT, store_id STRING, store_location STRING"
    return aggregates.count_by(
        files.json_lines(t.spark, path, stored), "store_id", "store_location"
    )


MONTHLY_SQL = f"""
    SELECT p_type AS product_category,
           CAST(year(l_shipdate) AS INTEGER) AS year,
           CAST(month(l_shipdate) AS INTEGER) AS month,
           CAST(sum(CAST(l_quantity AS INTEGER)) AS BIGINT) AS units_sold_total,
           CAST(sum(round(CAST(l_extendedprice AS DECIMAL(20,6)), 1)) AS DOUBLE) AS revenue_total
    FROM lineitem JOIN part ON p_partkey = l_partkey
    WHERE year(l_shipdate) = {SALES_YEAR}
    GROUP BY 1, 2, 3
"""


@query(MONTHLY_SQL)
def monthly_category_summary(t: Tables) -> DataFrame:
    return retail.monthly_category_summary(t.categorised_sales(), SALES_YEAR)


@query(f"""
    SELECT product_category, year, month, units_sold_total,
           CAST(sum(units_sold_total) OVER (
               PARTITION BY product_category ORDER BY month
               ROWS UNBOUNDED PRECEDING) AS BIGINT) AS "RunningTotal"
    FROM ({MONTHLY_SQL})
""")
def category_running_total(t: Tables) -> DataFrame:
    return retail.category_running_total(
        retail.monthly_category_summary(t.categorised_sales(), SALES_YEAR, ordered=False)
    )


SPLITS = 12


@query(f"""
    SELECT CAST(l_orderkey % {SPLITS} AS INTEGER) AS partition_id, count(*) AS count
    FROM lineitem GROUP BY 1
""")
def partition_profile(t: Tables) -> DataFrame:
    """Rows in each partition of lines that were dealt out by their order's number."""
    split = F.pmod("l_orderkey", F.lit(SPLITS)).cast("int")
    return aggregates.partition_profile(
        t.read("lineitem").select("l_orderkey").repartitionById(SPLITS, F.coalesce(split, F.lit(0)))
    )


@query("""
    SELECT l_orderkey AS order_id, l_partkey AS prod_id, p_name AS prod_name,
           l_extendedprice AS unit_price, p_retailprice AS list_price, l_quantity AS qty
    FROM lineitem JOIN part ON p_partkey = l_partkey
""")
def order_product_join(t: Tables) -> DataFrame:
    return retail.order_lines(t.order_lines(), t.products_in_stock())


@query("""
    SELECT s_name AS supplier, count(*) AS lines
    FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY s_name
""")
def broadcast_join(t: Tables) -> DataFrame:
    suppliers = t.read("supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_name").alias("supplier")
    )
    lines = joins.lookup(t.read("lineitem").select("l_suppkey"), suppliers, "l_suppkey")
    return aggregates.count_by(lines, "supplier", into="lines")


@query("""
    SELECT * FROM lineitem
    QUALIFY row_number() OVER (
        PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount,
                 l_tax, l_returnflag, l_linestatus) = 1
""")
def dedup_keys(t: Tables) -> DataFrame:
    return aggregates.one_per_key(
        t.read("lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"]
    )


@query("SELECT * FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 0")
def sql_view_filter(t: Tables) -> DataFrame:
    return session.query_shared_view(
        t.read("customer"), "customers", "c_mktsegment = 'BUILDING' AND c_acctbal > 0"
    )


# --- marketplace ------------------------------------------------------------------


@query("SELECT o_orderstatus AS order_status, count(*) AS count FROM orders GROUP BY 1")
def orders_by_status(t: Tables) -> DataFrame:
    return olist.orders_by_status(t.orders())


@query("""
    SELECT o_custkey AS customer_id, count(o_orderkey) AS purchases
    FROM orders GROUP BY o_custkey HAVING count(o_orderkey) > 1
""")
def repeat_customers(t: Tables) -> DataFrame:
    return olist.repeat_customers(t.orders())


# Money in whole hundredths; order means scaled by 10^10, customer means back to cents.
AVERAGE_ORDER_SQL = """
    SELECT customer_id, purchases,
           CAST((2 * s + purchases * 100000000) // (2 * purchases * 100000000) AS DOUBLE) / 100
               AS total_avg
    FROM (
        SELECT o_custkey AS customer_id, count(*) AS purchases, sum(order_avg) AS s
        FROM (
            SELECT l_orderkey,
                   (2 * sum(cents) * 100000000 + count(*)) // (2 * count(*)) AS order_avg
            FROM (
                SELECT l_orderkey,
                       CAST(round(l_extendedprice * 100) AS HUGEINT) * l_linenumber
                       + CAST(round(l_quantity * 100) AS HUGEINT) AS cents
                FROM lineitem)
            GROUP BY l_orderkey)
        JOIN orders ON o_orderkey = l_orderkey
        WHERE o_orderstatus NOT IN ('P')
        GROUP BY o_custkey)
"""


@query(AVERAGE_ORDER_SQL)
def customer_avg_order(t: Tables) -> DataFrame:
    return olist.customer_average_order(t.items(), t.orders(), LEFT_OUT_STATUS)


@query(f"""
    SELECT *, CASE WHEN total_avg > {TIERS[1]} THEN 'prime'
                   WHEN total_avg > {TIERS[0]} AND total_avg < {TIERS[1]} THEN 'normal'
                   ELSE 'basic' END AS category
    FROM ({AVERAGE_ORDER_SQL})
""")
def spending_tier(t: Tables) -> DataFrame:
    averages = olist.customer_average_order(t.items(), t.orders(), LEFT_OUT_STATUS, ordered=False)
    return olist.spending_tiers(averages, *TIERS)


@query("SELECT max(l_linenumber) AS max_num_items_sold FROM lineitem")
def largest_basket(t: Tables) -> DataFrame:
    return olist.largest_basket(t.items())


BY_PLACE_SQL = """
    SELECT r_name AS state, n_name AS city, l_partkey AS product, count(*) AS qtd
    FROM lineitem
    JOIN orders ON o_orderkey = l_orderkey
    JOIN customer ON c_custkey = o_custkey
    JOIN nation ON n_nationkey = c_nationkey
    JOIN region ON r_regionkey = n_regionkey
    GROUP BY 1, 2, 3
"""


def _sold(t: Tables) -> DataFrame:
    return olist.sold_products(t.items(), t.orders(), t.customers(), t.geo())


@query(BY_PLACE_SQL)
def products_by_region_nation(t: Tables) -> DataFrame:
    return olist.products_by_city(_sold(t))


def _top_by(place: str) -> str:
    return f"""
        SELECT {place}, product, CAST(sum(qtd) AS BIGINT) AS total_sales
        FROM ({BY_PLACE_SQL}) GROUP BY {place}, product
        QUALIFY row_number() OVER (PARTITION BY {place} ORDER BY sum(qtd) DESC, product) = 1
    """


@query(_top_by("state"))
def top_part_per_region(t: Tables) -> DataFrame:
    return olist.top_product(_sold(t))


@query(_top_by("city"))
def top_part_per_nation(t: Tables) -> DataFrame:
    return olist.top_product(_sold(t), "city")


@query("""
    SELECT p_type AS category, CAST(sum(l_linenumber) AS BIGINT) AS total
    FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY p_type
""")
def units_per_category(t: Tables) -> DataFrame:
    return olist.units_per_category(t.items(), t.products())


@query("""
    SELECT n_name AS state, count(*) AS count
    FROM customer JOIN nation ON n_nationkey = c_nationkey
    WHERE c_custkey IN (
        SELECT o_custkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem))
    GROUP BY n_name
""")
def buyers_per_nation(t: Tables) -> DataFrame:
    return olist.buyers_per_state(t.items(), t.orders(), t.customers())


@query("""
    SELECT c_custkey AS customer_id, CAST(c_nationkey AS VARCHAR) AS customer_zip_code_prefix,
           n_name AS customer_state
    FROM customer JOIN nation ON n_nationkey = c_nationkey
    WHERE NOT EXISTS (
        SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')
""")
def never_bought_status_p(t: Tables) -> DataFrame:
    pending = t.orders().where(F.col("order_status") == "P")
    return olist.never_bought(t.customers(), pending)


@query("""
    SELECT c_custkey AS customer_id, CAST(c_nationkey AS VARCHAR) AS customer_zip_code_prefix,
           n_name AS customer_state
    FROM customer JOIN nation ON n_nationkey = c_nationkey
    WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL)
""")
def never_bought(t: Tables) -> DataFrame:
    return olist.never_bought(t.customers(), t.orders())


@query("""
    SELECT doc_id AS customer_id, lang, source
    FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)
""")
def never_labelled(t: Tables) -> DataFrame:
    """The same program on a pair of whole tables where many keys are missing."""
    documents = t.read("documents").select(F.col("doc_id").alias("customer_id"), "lang", "source")
    labels = t.read("labels").select(F.col("doc_id").alias("customer_id"))
    return olist.never_bought(documents, labels)


# Hours between two midnights are whole, so hundredths of them are exact in integers.
@query("""
    SELECT customer_state,
           CAST(CASE WHEN s >= 0 THEN (2 * s + n) // (2 * n)
                     ELSE -((-2 * s + n) // (2 * n)) END AS DOUBLE) / 100 AS delivery_time_avg
    FROM (
        SELECT n_name AS customer_state, count(*) AS n,
               sum(CAST(round((epoch(l_shipdate) - epoch(o_orderdate)) / 36) AS HUGEINT)) AS s
        FROM lineitem
        JOIN orders ON o_orderkey = l_orderkey
        JOIN customer ON c_custkey = o_custkey
        JOIN nation ON n_nationkey = c_nationkey
        WHERE o_orderstatus = 'F'
        GROUP BY n_name)
""")
def ship_lag_hours_by_nation(t: Tables) -> DataFrame:
    return olist.delivery_hours_by_state(t.delivered_orders(), t.customers(), DELIVERED_STATUS)


STATUS_RATE_SQL = """
    count(*) AS total_orders_month,
    count(*) FILTER (o_orderstatus = 'F') AS total_cancelled,
    CAST(count(*) FILTER (o_orderstatus = 'F') AS DOUBLE) / count(*) * 100
        AS rate_cancelled_month
"""


@query(f"""
    SELECT CAST(month(o_orderdate) AS INTEGER) AS orders_month, {STATUS_RATE_SQL}
    FROM orders GROUP BY 1
""")
def status_rate_by_month(t: Tables) -> DataFrame:
    return olist.cancellation_rate(t.orders(), CANCELED_STATUS)


@query(f"""
    SELECT CAST(year(o_orderdate) AS INTEGER) AS orders_year,
           CAST(month(o_orderdate) AS INTEGER) AS orders_month, {STATUS_RATE_SQL}
    FROM orders GROUP BY 1, 2
""")
def status_rate_by_year_month(t: Tables) -> DataFrame:
    return olist.cancellation_rate(t.orders(), CANCELED_STATUS, by_year=True)


@query("""
    SELECT CAST(year(o_orderdate) AS INTEGER) AS year,
           CAST(month(o_orderdate) AS INTEGER) AS month,
           count(*) FILTER (l_shipdate > o_orderdate) AS num_late_deliveries,
           count(*) AS total_orders,
           round(CAST(count(*) FILTER (l_shipdate > o_orderdate) AS DOUBLE) / count(*) * 100, 2)
               AS percentage
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey
    WHERE o_orderstatus = 'F'
    GROUP BY 1, 2
""")
def late_rate_by_month(t: Tables) -> DataFrame:
    return olist.late_delivery_rate(t.delivered_orders(), DELIVERED_STATUS)


# --- nested records and registries ----------------------------------------------------


@query("""
    SELECT c_mktsegment AS supplier_name, lower(n_name) AS supplier_city,
           substr(n_name, 1, 3) AS supplier_state, n_name AS supplier_country,
           c_name AS customer_name, lower(n_name) AS customer_city,
           substr(n_name, 1, 3) AS customer_state, n_name AS customer_country,
           o_orderkey AS qty, o_orderpriority AS title
    FROM orders
    JOIN customer ON c_custkey = o_custkey
    JOIN nation ON n_nationkey = c_nationkey
""")
def nest_explode_roundtrip(t: Tables) -> DataFrame:
    return shipments.flatten_shipments(t.shipments())


@query("""
    SELECT CAST(s_suppkey AS VARCHAR) AS "datasetId", s_name AS name,
           s_nationkey || ' Main St' AS address1, CAST(NULL AS VARCHAR) AS address2,
           'RALEIGH' AS city, 'NC' AS state, lpad(CAST(s_nationkey AS VARCHAR), 5, '0') AS zip,
           CAST(NULL AS VARCHAR) AS tel, DATE '2000-01-01' + CAST(s_suppkey AS INTEGER) AS "dateStart",
           CAST(NULL AS DATE) AS "dateEnd", 'Restaurant' AS type,
           CAST(s_nationkey AS VARCHAR) AS "geoX", '1.5' AS "geoY", 'Wake' AS county,
           'NC_Wake_' || s_suppkey AS id
    FROM supplier
    UNION ALL
    SELECT CAST(c_custkey AS VARCHAR), c_name, c_mktsegment, NULL, 'DURHAM', 'NC',
           lpad(CAST(c_nationkey AS VARCHAR), 5, '0'), NULL, DATE '2003-05-07',
           CASE WHEN c_mktsegment = 'BUILDING' THEN DATE '2010-05-04' END,
           CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_mktsegment END,
           c_nationkey || '.0', '2.5', 'Durham', 'NC_Durham_' || c_custkey
    FROM customer
""")
def union_parties(t: Tables) -> DataFrame:
    return restaurants.all_restaurants(t.first_registry(), t.second_registry())


def _scored(t: Tables) -> DataFrame:
    return restaurants.inspected_businesses(t.businesses(), t.inspections(), PASS_MARK)


def _as_text(inspected: DataFrame) -> DataFrame:
    """Inspections as one text per row, for comparison with SQL."""
    entry = F.transform(
        "inspections", lambda one: F.concat_ws("|", one["score"], one["date"], one["type"])
    )
    return inspected.select(
        "business_id",
        "name",
        "city",
        "part",
        F.concat_ws(";", entry).alias("inspections"),
        "can_be_opened",
    )


SCORED_SQL = f"""
    SELECT c_custkey AS business_id, any_value(c_name) AS name, any_value(n_name) AS city,
           coalesce(year, 0) AS part,
           coalesce(string_agg(score || '|' || date || '|' || o_orderpriority, ';'
                               ORDER BY score, date, o_orderpriority), '') AS inspections,
           coalesce(any_value(mean) > {PASS_MARK}, true) AS can_be_opened
    FROM customer
    JOIN nation ON n_nationkey = c_nationkey
    LEFT JOIN (
        SELECT o_custkey, CAST(floor(o_totalprice / 5000) AS INTEGER) AS score,
               strftime(o_orderdate, '%Y-%m-%d') AS date, o_orderpriority,
               CAST(year(o_orderdate) AS INTEGER) AS year
        FROM orders) ON o_custkey = c_custkey
    LEFT JOIN (
        SELECT o_custkey AS scored, avg(floor(o_totalprice / 5000)) AS mean
        FROM orders GROUP BY 1) ON scored = c_custkey
    GROUP BY c_custkey, year
"""


@query(SCORED_SQL)
def score_nested(t: Tables) -> DataFrame:
    return _as_text(_scored(t))


@query(f"SELECT * FROM ({SCORED_SQL}) WHERE NOT can_be_opened")
def score_closed(t: Tables) -> DataFrame:
    return _as_text(restaurants.may_not_open(_scored(t)))


@query(f"SELECT business_id, part, inspections, can_be_opened FROM ({SCORED_SQL})")
def nested_json_write(t: Tables) -> DataFrame:
    path = session.new_shared_folder(t.spark, "inspected")
    restaurants.write_inspected(_scored(t), path)
    stored = """
        business_id BIGINT, name STRING, city STRING, part INT,
        inspections ARRAY<STRUCT<score: INT, date: STRING, type: STRING>>, can_be_opened BOOLEAN
    """
    return _as_text(files.json_lines(t.spark, path, stored)).drop("name", "city")


# --- rentals ----------------------------------------------------------------------------


FEATURES = ("small", "red", "large plate", "bolt")


@query("""
    SELECT p_partkey AS film_id, p_name AS title,
           CAST(list_contains(string_split(p_name, ' '), 'small') AS INTEGER) AS feature_small,
           CAST(list_contains(string_split(p_name, ' '), 'red') AS INTEGER) AS feature_red,
           CAST(list_contains(string_split(p_name, ' '), 'large plate') AS INTEGER)
               AS feature_large_plate,
           CAST(list_contains(string_split(p_name, ' '), 'bolt') AS INTEGER) AS feature_bolt
    FROM part
""")
def feature_flags(t: Tables) -> DataFrame:
    films = t.films()
    return films.select(
        "film_id", "title", *rules.feature_flags("title", FEATURES, separator=" ")
    )


@query("""
    SELECT p_partkey AS film_id, p_name AS title,
           CASE p_type WHEN 'ECONOMY' THEN 'ADULTS_ONLY' WHEN 'MEDIUM' THEN 'ADULTS_ONLY'
                       WHEN 'STANDARD' THEN 'PARENTAL_GUIDANCE'
                       WHEN 'PROMO' THEN 'PARENTAL_GUIDANCE' WHEN 'SMALL' THEN 'GENERAL' END
               AS rating,
           CAST(p_brand = 'Brand#1' AS INTEGER) AS feature_trailers,
           CAST(true AS INTEGER) AS feature_commentaries,
           CAST(p_brand = 'Brand#2' AS INTEGER) AS feature_deleted_scenes,
           CAST(false AS INTEGER) AS feature_behind_the_scenes
    FROM part
""")
def film_catalogue(t: Tables) -> DataFrame:
    # Which part type stands for which rating.
    ratings = {"ECONOMY": "NC-17", "MEDIUM": "R", "STANDARD": "PG-13", "PROMO": "PG", "SMALL": "G"}
    first = F.when(F.col("p_brand") == "Brand#1", "Trailers").when(
        F.col("p_brand") == "Brand#2", "Deleted Scenes"
    )
    raw = t.read("part").select(
        F.col("p_partkey").alias("film_id"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("description"),
        F.coalesce(rules.mapped("p_type", ratings), F.lit("X")).alias("rating"),
        F.concat_ws(",", first, F.lit("Commentaries")).alias("special_features"),
    )
    return rental.catalogue(raw)


@query("""
    SELECT o_orderkey AS order_id,
           CASE o_orderpriority WHEN '1-URGENT' THEN 'FIRST' WHEN '2-HIGH' THEN 'FIRST'
                                WHEN '3-MEDIUM' THEN 'SECOND' WHEN '5-LOW' THEN 'LAST' END
               AS priority_class
    FROM orders
""")
def priority_class(t: Tables) -> DataFrame:
    # Fixed values; the fourth priority is left out on purpose and gives null.
    classes = {"1-URGENT": "FIRST", "2-HIGH": "FIRST", "3-MEDIUM": "SECOND", "5-LOW": "LAST"}
    return t.read("orders").select(
        F.col("o_orderkey").alias("order_id"),
        rules.mapped("o_orderpriority", classes).alias("priority_class"),
    )


@query("SELECT p_type AS category, count(*) AS count FROM part GROUP BY 1")
def parts_per_type(t: Tables) -> DataFrame:
    return rental.films_per_category(t.films())


@query("""
    SELECT p_partkey AS film_id, p_name AS title, n_name AS category
    FROM part JOIN nation ON n_nationkey = p_size
""")
def films_with_category(t: Tables) -> DataFrame:
    part = t.read("part")
    film = part.select(F.col("p_partkey").alias("film_id"), F.col("p_name").alias("title"))
    link = part.select(
        F.col("p_partkey").alias("film_id"), F.col("p_size").alias("category_id")
    )
    category = t.read("nation").select(
        F.col("n_nationkey").alias("category_id"), F.col("n_name").alias("name")
    )
    return rental.films(film, link, category)


@query("""
    SELECT c_custkey AS customer_id, c_name AS first_name, c_custkey AS address_id,
           c_mktsegment AS address, 'd' AS district, '00000' AS postal_code, '555' AS phone,
           n_nationkey AS city_id, n_name AS city, r_regionkey AS country_id, r_name AS country
    FROM customer
    JOIN nation ON n_nationkey = c_nationkey
    JOIN region ON r_regionkey = n_regionkey
""")
def customer_addresses(t: Tables) -> DataFrame:
    people = t.read("customer")
    customer = people.select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("first_name"),
        F.col("c_custkey").alias("address_id"),
    )
    address = people.select(
        F.col("c_custkey").alias("address_id"),
        F.col("c_mktsegment").alias("address"),
        F.lit("d").alias("district"),
        F.lit("00000").alias("postal_code"),
        F.lit("555").alias("phone"),
        F.col("c_nationkey").alias("city_id"),
    )
    city = t.read("nation").toDF("city_id", "city", "country_id")
    country = t.read("region").toDF("country_id", "country")
    return rental.customers(customer, address, city, country)


@query(f"""
    SELECT p_type AS category, count(*) AS count
    FROM lineitem
    JOIN orders ON o_orderkey = l_orderkey
    JOIN customer ON c_custkey = o_custkey
    JOIN nation ON n_nationkey = c_nationkey
    JOIN part ON p_partkey = l_partkey
    WHERE n_name = '{COUNTRY}'
    GROUP BY p_type
""")
def rentals_one_country(t: Tables) -> DataFrame:
    return rental.category_rentals(t.rental(), t.renters(), t.films(), COUNTRY, t.inventory())


RENTED_SQL = """
    SELECT p_name, p_size, p_retailprice, count(l_partkey) AS rentals
    FROM part LEFT JOIN lineitem ON l_partkey = p_partkey
    GROUP BY p_partkey, p_name, p_size, p_retailprice
"""


@query(f"""
    SELECT 'feature_' || replace(name, ' ', '_') AS feature,
           CAST(list_contains(string_split(p_name, ' '), name) AS INTEGER) AS has_feature,
           count(*) AS films, CAST(sum(rentals) AS BIGINT) AS rentals,
           CAST(sum(rentals) AS DOUBLE) / count(*) AS rentals_per_film
    FROM ({RENTED_SQL}), (SELECT unnest({list(FEATURES)}) AS name)
    GROUP BY 1, 2
""")
def rentals_per_feature(t: Tables) -> DataFrame:
    return rental.rentals_per_feature(t.loans(), t.films(), FEATURES, "title", " ")


@query(f"""
    SELECT p_size AS rental_duration, count(*) AS films, CAST(sum(rentals) AS BIGINT) AS rentals,
           CAST(sum(rentals) AS DOUBLE) / count(*) AS rentals_per_film
    FROM ({RENTED_SQL}) GROUP BY 1
""")
def rentals_per_duration(t: Tables) -> DataFrame:
    return rental.rentals_per_value(t.loans(), t.measured_films())


@query(f"""
    SELECT 'rental_duration' AS measure, count(p_size) AS films,
           round(corr(p_size, rentals), 6) AS correlation,
           round(regr_slope(rentals, p_size), 6) AS slope
    FROM ({RENTED_SQL})
    UNION ALL
    SELECT 'rental_rate', count(p_retailprice), round(corr(p_retailprice, rentals), 6),
           round(regr_slope(rentals, p_retailprice), 6)
    FROM ({RENTED_SQL})
""")
def rental_trends(t: Tables) -> DataFrame:
    return rental.rental_trends(t.loans(), t.measured_films(), ["rental_duration", "rental_rate"])


@query("""
    SELECT c_name AS first_name, lower(c_mktsegment) || '@example.com' AS email,
           p_name AS title, o_orderdate AS rental_date
    FROM lineitem
    JOIN orders ON o_orderkey = l_orderkey
    JOIN customer ON c_custkey = o_custkey
    JOIN part ON p_partkey = l_partkey
    WHERE o_orderstatus = 'O'
""")
def open_items(t: Tables) -> DataFrame:
    return rental.unreturned(t.rental(), t.renters(), t.films(), t.inventory())


@query(f"""
    SELECT rental_year, rental_month, CAST(cents AS DOUBLE) / 100 AS expending,
           CAST(sum(cents) OVER (PARTITION BY rental_year ORDER BY rental_month) AS DOUBLE) / 100
               AS expending_accumulated
    FROM (
        SELECT CAST(year(o_orderdate) AS INTEGER) AS rental_year,
               CAST(month(o_orderdate) AS INTEGER) AS rental_month,
               CAST(sum(CAST(round(p_retailprice * 100) AS BIGINT)) AS BIGINT) AS cents
        FROM lineitem
        JOIN orders ON o_orderkey = l_orderkey
        JOIN part ON p_partkey = l_partkey
        WHERE o_custkey = {CUSTOMER}
        GROUP BY 1, 2)
""")
def accumulated_monthly_spend(t: Tables) -> DataFrame:
    rentals = rental.rentals(t.rental(), t.inventory())
    return rental.accumulated_spend(rentals, t.films(), CUSTOMER)


TOP10_SQL = """
    SELECT film_id, rental_year, rental_month, count
    FROM (
        SELECT l_partkey AS film_id, CAST(year(l_shipdate) AS INTEGER) AS rental_year,
               CAST(month(l_shipdate) AS INTEGER) AS rental_month, count(*) AS count
        FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part)
        GROUP BY 1, 2, 3)
    QUALIFY row_number() OVER (
        PARTITION BY rental_year, rental_month ORDER BY count DESC, film_id) <= 10
"""


@query(TOP10_SQL)
def top10_parts_per_month(t: Tables) -> DataFrame:
    return rental.top_films_by_month(t.loans(), t.films())


@query(f"SELECT film_id, count(*) AS count FROM ({TOP10_SQL}) GROUP BY 1 HAVING count(*) > 1")
def repeat_toppers(t: Tables) -> DataFrame:
    return rental.repeat_toppers(rental.top_films_by_month(t.loans(), t.films()))


# --- civic and economic ---------------------------------------------------------------------


@query("SELECT count(DISTINCT o_custkey) AS schools FROM orders")
def school_count(t: Tables) -> DataFrame:
    return schools.school_count(t.attendance())


@query("""
    SELECT CAST(year(o_orderdate) AS INTEGER) AS "SchoolYear",
           CAST((2 * sum(CAST(round(o_totalprice * 100) AS HUGEINT)) + count(*))
                // (2 * count(*)) AS DOUBLE) / 100 AS enrollment_avg
    FROM orders GROUP BY 1
""")
def avg_total_by_year(t: Tables) -> DataFrame:
    return schools.average_enrolment(t.yearly_prices())


def _rank_sql(into: str, direction: str) -> str:
    return f"""
        SELECT "SchoolYear", school_id, {into},
               row_number() OVER (
                   PARTITION BY "SchoolYear" ORDER BY {into} {direction}, school_id) AS ranking
        FROM (
            SELECT CAST(year(o_orderdate) AS INTEGER) AS "SchoolYear", o_custkey AS school_id,
                   CAST(sum(CAST(floor(o_totalprice) AS BIGINT)) AS BIGINT) AS {into}
            FROM orders GROUP BY 1, 2)
    """


@query(_rank_sql("enrolled", "DESC"))
def rank_desc(t: Tables) -> DataFrame:
    return schools.enrolment_rank(t.attendance())


@query(_rank_sql("absent", "ASC"))
def rank_asc(t: Tables) -> DataFrame:
    return schools.absence_rank(t.attendance())


@query("SELECT count(*) AS records FROM events")
def json_multiline_dir(t: Tables) -> DataFrame:
    """Events written as files of one JSON array each, then read back as documents."""
    path = session.new_shared_folder(t.spark, "documents")
    events = t.read("events").withColumn("day", F.to_date("ts"))
    half = F.floor(F.hour("ts") / 12)
    arrays = aggregates.nest(events, ["day"], ["event_id", "event_type"], "events", half)
    arrays.select(F.to_json("events").alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    return consular.record_count(
        consular.load_documents(t.spark, path, "event_id BIGINT, event_type STRING")
    )


@query("""
    SELECT c_custkey AS id, replace(c_name, '#', ', ') AS label,
           CAST(c_custkey // 1000 AS INTEGER) AS "stateId", c_custkey % 1000 AS "countyId",
           split_part(c_name, '#', 2) AS state, split_part(c_name, '#', 1) AS county
    FROM customer
""")
def name_parts(t: Tables) -> DataFrame:
    return census.counties(t.labelled_customers())


@query("""
    SELECT c_custkey AS id, replace(c_name, '#', ', ') AS label,
           CAST(c_custkey // 1000 AS INTEGER) AS "stateId", c_custkey % 1000 AS "countyId",
           split_part(c_name, '#', 2) AS state, split_part(c_name, '#', 1) AS county
    FROM customer
    WHERE CAST('0x' || substr(md5('42:' || c_custkey), 1, 8) AS BIGINT) < 429496729
""")
def seeded_sample(t: Tables) -> DataFrame:
    return census.sample_by_key(census.counties(t.labelled_customers()), "id", 0.1)


@query("""
    SELECT page_id, split_part(string_split(url, '/')[-1], '?', 1) AS segment FROM pages
""")
def url_last_segment(t: Tables) -> DataFrame:
    return t.read("pages").select(
        "page_id", text.part(text.last_part("url", "/"), "?", 0).alias("segment")
    )


@query("""
    SELECT r_regionkey AS id, r_name AS label, lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS zip,
           c_name AS institution
    FROM customer
    JOIN nation ON n_nationkey = c_nationkey
    JOIN region ON r_regionkey = n_regionkey
    WHERE c_mktsegment <> 'MACHINERY'
""")
def code_chain_join(t: Tables) -> DataFrame:
    return census.institutions_by_county(
        census.institutions(t.campuses()), t.county_zips(), t.census()
    )


@query("SELECT o_orderkey, o_totalprice AS amount FROM orders")
def locale_number_roundtrip(t: Tables) -> DataFrame:
    return t.read("orders").select(
        "o_orderkey", text.locale_number(written(F.col("o_totalprice"))).alias("amount")
    )


@query("""
    SELECT n_name AS "CITY", max(c_acctbal) AS area
    FROM customer JOIN nation ON n_nationkey = c_nationkey
    GROUP BY n_name ORDER BY max(c_acctbal) DESC, n_name LIMIT 1
""")
def top_city(t: Tables) -> DataFrame:
    return brazil.widest(brazil.repaired(t.cities()))


@query("""
    SELECT l_orderkey AS "CITY", l_quantity AS "IBGE_POP", mac AS "MAC",
           1.0::DOUBLE / nullif(mac::DOUBLE / nullif(l_quantity, 0), 0) AS mac_density
    FROM (SELECT *, CAST(round(l_discount * 100) AS BIGINT) AS mac FROM lineitem)
""")
def safe_ratio(t: Tables) -> DataFrame:
    return brazil.people_per_outlet(t.outlets())


SPENDING_SQL = """
    SELECT CAST(weekofyear(ts) AS INTEGER) AS week, CAST(isoyear(ts) AS INTEGER) AS year,
           CASE event_type WHEN 'purchase' THEN 'market' WHEN 'click' THEN 'meal'
                           ELSE event_type END AS maincategory,
           CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) >= 50
                THEN 'large' END AS subcategory,
           value, CAST(round(value * 100) AS BIGINT) AS cents
    FROM events
"""


def _two_way_sql(keys: str) -> str:
    return f"""
        SELECT * FROM (
            SELECT {keys}, CAST(sum(cents) AS DOUBLE) / 100 AS meal_total_weekly_spending,
                   CAST((2 * sum(cents) + count(*)) // (2 * count(*)) AS DOUBLE) / 100
                       AS avg_meal_expending,
                   max(value) AS higher_expending
            FROM ({SPENDING_SQL}) WHERE maincategory = 'meal' AND subcategory IS NULL
            GROUP BY ALL)
        JOIN (
            SELECT {keys}, CAST(sum(cents) AS DOUBLE) / 100 AS market_expending
            FROM ({SPENDING_SQL}) WHERE maincategory = 'market' GROUP BY ALL)
        USING ({keys})
    """


@query(_two_way_sql("week"))
def weekly_two_way(t: Tables) -> DataFrame:
    return grocery.market_and_meals(grocery.tidy(t.spending()))


@query(_two_way_sql("year, week"))
def weekly_two_way_by_year(t: Tables) -> DataFrame:
    return grocery.market_and_meals(grocery.tidy(t.spending()), by_year=True)


@query(f"""
    SELECT week, maincategory, subcategory, CAST(sum(cents) AS DOUBLE) / 100 AS expending,
           maincategory || ' ' || coalesce(subcategory, '') AS category
    FROM ({SPENDING_SQL}) GROUP BY week, maincategory, subcategory
""")
def label_concat(t: Tables) -> DataFrame:
    return grocery.spending_by_category(grocery.tidy(t.spending()))


# --- sources ----------------------------------------------------------------------------------


ORDERS_SQL = "SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders"
ORDER_COLUMNS = {
    "o_orderkey": "long",
    "o_orderstatus": "string",
    "o_totalprice": "double",
    "o_orderpriority": "string",
}


@query("SELECT * FROM orders")
def csv_roundtrip(t: Tables) -> DataFrame:
    path = session.new_shared_folder(t.spark, "csv")
    orders = t.read("orders").repartition(3, "o_orderkey")
    orders.write.option("header", True).option("sep", ";").csv(path)
    more = {"o_custkey": "long", "o_orderdate": "timestamp_ntz"}
    return files.csv_typed(t.spark, path, ORDER_COLUMNS | more, sep=";")


@query(ORDERS_SQL)
def json_roundtrip(t: Tables) -> DataFrame:
    path = session.new_shared_folder(t.spark, "json")
    sinks.write_json(t.read("orders").select(*ORDER_COLUMNS), path)
    schema = ", ".join(f"{name} {kind}" for name, kind in ORDER_COLUMNS.items())
    return files.json_lines(t.spark, path, schema.replace(" long", " BIGINT"))


@query("""
    SELECT 'order-' || o_orderkey || '.jpg' AS image_path,
           CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS camera_make,
           CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y:%m:%d %H:%M:%S') END
               AS date_time_original
    FROM orders
""")
def exif_from_column(t: Tables) -> DataFrame:
    return exif.exif_from_content(t.photos())


@query("""
    SELECT 'supplier-' || s_suppkey || '.jpg' AS image, s_name AS camera_make,
           '2020:01:02 03:04:05' AS date_time_original
    FROM supplier
""")
def exif_scan(t: Tables) -> DataFrame:
    """One image file per supplier, written by tasks and read through the ``exif`` source."""
    folder = session.new_shared_folder(t.spark, "images")
    exif.write_images(t.supplier_photos(), folder)
    exif.register(t.spark)
    found = t.spark.read.format("exif").load(folder)
    name = F.element_at(F.split("image_path", "/"), -1).alias("image")
    return found.select(name, "camera_make", "date_time_original")


@query("""
    SELECT count(*) FILTER (c_mktsegment <> 'BUILDING' AND c_nationkey = 3) AS "dateEnd",
           0::BIGINT AS "dateStart"
    FROM customer
""")
def rejected_dates(t: Tables) -> DataFrame:
    shaped = restaurants.durham_registry(t.second_registry())
    parsed = {
        name: F.col(name).isNotNull() & dates.parsed_date(name, "yyyy-MM-dd").isNull()
        for name in ("dateStart", "dateEnd")
    }
    return shaped.agg(*(F.count_if(bad).alias(name) for name, bad in parsed.items()))


# --- stream -----------------------------------------------------------------------------------


@query("""
    SELECT '192.0.2.1' AS ip, user_id, user_id || '-' || strftime(ts, '%Y%m%d') AS session_id,
           strftime(ts, '%Y-%m-%d %H:%M:%S') AS event_time, event_type AS event_name,
           'web' AS channel, json_extract_string(props, '$.k') AS user_query
    FROM events
""")
def click_stream(t: Tables) -> DataFrame:
    """Events written as JSON files, run through the stream job, and read from its output.

    Half of them are written as JSON lines, half as files of one array each.
    """
    root = session.new_shared_folder(t.spark, "clicks")
    events = t.clicks()
    odd = F.pmod("user_id", F.lit(2)) == 1
    sinks.write_json(events.where(odd | odd.isNull()), f"{root}/in/lines")
    day = F.substring("event_time", 1, 10).alias("day")
    arrays = aggregates.nest(events.where(~odd).select("*", day), ["day"], events.columns, "events")
    arrays.select(F.to_json("events").alias("value")).write.option("maxRecordsPerFile", 1).text(
        f"{root}/in/arrays"
    )
    clicks.run_available(t.spark, f"{root}/in/*", f"{root}/out", f"{root}/checkpoint")
    projected = clicks.project_clicks(t.spark.createDataFrame([], schemas.CLICK_EVENT)).schema
    return files.json_lines(t.spark, f"{root}/out", projected).drop("metadata")


# --- aggregates named but not used in the datasets ----------------------------------------------


@query("""
    SELECT l_returnflag, count(l_quantity) AS count,
           count(DISTINCT l_quantity) AS count_distinct, true AS approx_is_close,
           min(l_quantity) AS min, max(l_quantity) AS max, sum(l_quantity) AS sum,
           sum(DISTINCT l_quantity) AS sum_distinct,
           round(avg(l_quantity), 6) AS mean,
           round(var_pop(l_quantity), 6) AS var_pop, round(var_samp(l_quantity), 6) AS var_samp,
           round(var_samp(l_quantity), 6) AS variance,
           round(stddev_samp(l_quantity), 6) AS stddev,
           round(stddev_pop(l_quantity), 6) AS stddev_pop,
           round(stddev_samp(l_quantity), 6) AS stddev_samp,
           round(sum(power(l_quantity - m, 3)) / count(*)
                 / power(var_pop(l_quantity), 1.5), 6) AS skewness,
           round(kurtosis_pop(l_quantity), 6) AS kurtosis,
           round(corr(l_quantity, l_linenumber), 6) AS corr,
           round(covar_pop(l_quantity, l_linenumber), 6) AS covar_pop,
           round(covar_samp(l_quantity, l_linenumber), 6) AS covar_samp
    FROM lineitem
    JOIN (SELECT l_returnflag AS flag, avg(l_quantity) AS m FROM lineitem GROUP BY 1)
        ON flag = l_returnflag
    GROUP BY l_returnflag
""")
def aggregate_catalogue(t: Tables) -> DataFrame:
    exact = {"count", "count_distinct", "min", "max", "sum", "sum_distinct"}
    stats = aggregates.catalogue(t.read("lineitem"), ["l_returnflag"], "l_quantity", "l_linenumber")
    error = F.abs(F.col("approx_count_distinct") - F.col("count_distinct"))
    return stats.select(
        "l_returnflag",
        (error <= F.col("count_distinct") * 0.2).alias("approx_is_close"),
        *(
            F.col(name) if name in exact else F.round(name, 6).alias(name)
            for name in stats.columns
            if name not in ("l_returnflag", "approx_count_distinct")
        ),
    )


@query("""
    SELECT o_orderstatus,
           arg_min(o_orderpriority, (o_orderdate, o_orderkey)) AS first,
           arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS last,
           string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS values
    FROM orders GROUP BY o_orderstatus
""")
def first_last_set(t: Tables) -> DataFrame:
    ends = aggregates.ends_by(
        t.read("orders"), ["o_orderstatus"], "o_orderpriority", ["o_orderdate", "o_orderkey"]
    )
    return ends.withColumn("values", F.array_join("values", ","))


@query("""
    SELECT o_orderstatus, o_orderpriority,
           CAST(grouping(o_orderstatus) AS INTEGER) AS o_orderstatus_is_total,
           CAST(grouping(o_orderpriority) AS INTEGER) AS o_orderpriority_is_total,
           CAST(grouping_id(o_orderstatus, o_orderpriority) AS BIGINT) AS grouping_id,
           count(*) AS count
    FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)
""")
def cube_counts(t: Tables) -> DataFrame:
    return aggregates.cube_counts(t.read("orders"), "o_orderstatus", "o_orderpriority")


# --- groups, partitions and streams of any size -----------------------------------------------


@query("""
    SELECT l_returnflag, l_orderkey, l_linenumber, cents,
           CAST(sum(cents) OVER (
               PARTITION BY l_returnflag
               ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey
               ROWS UNBOUNDED PRECEDING) AS BIGINT) AS balance,
           CAST(sum(cents) OVER (
               PARTITION BY l_returnflag ORDER BY l_shipdate) AS BIGINT) AS day_balance
    FROM (SELECT *, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents FROM lineitem)
""")
def running_balances(t: Tables) -> DataFrame:
    """Over all lines, of which a flag has a third: row by row, and by whole days."""
    key, day = ["l_returnflag"], ["l_shipdate"]
    tie = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    lines = t.read("lineitem").select(
        *key, *day, *tie, F.round(F.col("l_extendedprice") * 100).cast("long").alias("cents")
    )
    rows = windows.running_balance(lines, "cents", key, day, tie, "balance")
    days = windows.running_balance(rows, "cents", key, day, tie, "day_balance", "range")
    return days.select(*key, "l_orderkey", "l_linenumber", "cents", "balance", "day_balance")


MANY = 15_000


@query(f"""
    SELECT l_returnflag, l_orderkey, l_linenumber, l_extendedprice,
           row_number() OVER (
               PARTITION BY l_returnflag
               ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS rank
    FROM lineitem QUALIFY rank <= {MANY}
""")
def top_lines_per_flag(t: Tables) -> DataFrame:
    """The dearest lines of each flag, many more than Spark's limit per task keeps."""
    rest = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    lines = t.read("lineitem").select("l_returnflag", "l_extendedprice", *rest)
    order = [F.desc("l_extendedprice"), *map(F.asc, rest)]
    return windows.first_rows(lines, ["l_returnflag"], order, MANY).drop("l_partkey", "l_suppkey")


@query("""
    SELECT o_orderkey AS order_id, o_orderstatus AS status, count(*) AS lines,
           CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS units
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL
""")
def bucketed_join(t: Tables) -> DataFrame:
    """Orders and their lines stored with the same buckets, joined and grouped in place."""
    heads = t.read("orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderstatus").alias("status")
    )
    lines = t.read("lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_quantity").cast("long").alias("units")
    )
    for df, table in ((heads, "order_heads"), (lines, "order_lines")):
        sinks.write_bucketed(df, table, "order_id", 8, session.new_shared_folder(t.spark, table))
    joined = joins.co_bucketed(t.spark, "order_heads", "order_lines", "order_id")
    return joined.groupBy("order_id", "status").agg(
        F.count("*").alias("lines"), F.sum("units").alias("units")
    )


@query("""
    SELECT CAST(year(o_orderdate) AS INTEGER) AS year,
           CASE WHEN year(o_orderdate) IN (1996, 1998) THEN 'X' ELSE o_orderstatus END AS status,
           count(*) AS sales
    FROM orders WHERE year(o_orderdate) <> 2001 GROUP BY 1, 2
""")
def rerun_years(t: Tables) -> DataFrame:
    """Two years of the stored orders are corrected and one turns out empty, twice over."""
    orders = t.read("orders").select("o_orderdate", F.col("o_orderstatus").alias("status"))
    path = session.new_shared_folder(t.spark, "orders-by-year")
    stored = history.store_years(orders, "o_orderdate", path)
    corrected = history.by_year(orders, "o_orderdate").withColumn("status", F.lit("X"))
    for _ in range(2):
        sinks.rerun_partitions(corrected.where("year <> 2001"), path, "year", [1996, 1998, 2001])
    again = t.spark.read.schema(stored.schema).parquet(path)
    return again.groupBy("year", "status").agg(F.count("*").alias("sales"))


@query("""
    SELECT CAST(year(o_orderdate) AS INTEGER) AS year, 366 AS days, count(*) AS sales,
           CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents
    FROM orders WHERE year(o_orderdate) % 4 = 0 GROUP BY 1
""")
def leap_year_sales(t: Tables) -> DataFrame:
    """Orders stored by year; only the folders of the calendar's long years are read."""
    path = session.new_shared_folder(t.spark, "orders-by-year")
    orders = t.read("orders").select("o_orderdate", "o_totalprice")
    stored = history.store_years(orders, "o_orderdate", path)
    years = session.pin(history.calendar(stored))
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    return history.sales_in_years(stored, years, F.col("days") == 366, cents)


SPANS_SQL = """
    SELECT kind, span, count(DISTINCT o_custkey) AS customers, true AS is_close
    FROM (SELECT o_custkey, unnest([
              {'kind': 'all', 'span': 'all'},
              {'kind': 'year', 'span': strftime(o_orderdate, '%Y')},
              {'kind': 'quarter', 'span': strftime(o_orderdate, '%Y') || '-' || quarter(o_orderdate)}
          ], recursive := true) FROM orders)
    GROUP BY kind, span
"""


@query(SPANS_SQL)
def mergeable_counts(t: Tables) -> DataFrame:
    """Customers per quarter, year and in all from stored monthly sketches, beside exact counts."""
    month = F.trunc("o_orderdate", "month").alias("month")
    orders = t.read("orders").select(month, "o_custkey")
    year = F.date_format("month", "yyyy")
    spans = F.inline(
        F.array(
            F.struct(F.lit("all").alias("kind"), F.lit("all").alias("span")),
            F.struct(F.lit("year").alias("kind"), year.alias("span")),
            F.struct(
                F.lit("quarter").alias("kind"),
                F.concat(year, F.lit("-"), F.quarter("month")).alias("span"),
            ),
        )
    )
    monthly = session.pin(sketches.sketched(orders, ["month"], "o_custkey"))
    estimated = sketches.merged(monthly.select("sketch", spans), ["kind", "span"], into="_estimate")
    exact = orders.distinct().select("o_custkey", spans).groupBy("kind", "span").agg(
        F.count_distinct("o_custkey").alias("customers")
    )
    close = sketches.within(F.col("_estimate"), F.col("customers")).alias("is_close")
    return exact.join(estimated, ["kind", "span"]).select("kind", "span", "customers", close)


@query("""
    SELECT lang, doc_id, n_chars FROM documents
    QUALIFY row_number() OVER (
        PARTITION BY lang ORDER BY sha256('tally' || doc_id), doc_id) <= 25
""")
def exact_size_sample(t: Tables) -> DataFrame:
    docs = t.read("documents").select("lang", "doc_id", "n_chars")
    return sampling.bottom_k(docs, ["lang"], "doc_id", 25, "tally")


@query(f"""
    SELECT o_orderstatus AS status, count(*) AS lines,
           CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS units
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey
    JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
    WHERE n_name = '{COUNTRY}' GROUP BY 1
""")
def chain_by_statistics(t: Tables) -> DataFrame:
    """Four stored and analysed tables, joined from the largest down as written.

    Their statistics turn the chain round: the one nation first, then its customers.
    """
    sister = session.cost_based(t.spark)
    tables = Tables(sister, t.base)
    columns = {
        "lineitem": [F.col("l_orderkey"), F.col("l_quantity").cast("long").alias("units")],
        "orders": [F.col("o_orderkey").alias("l_orderkey"), "o_custkey", F.col("o_orderstatus").alias("status")],
        "customer": [F.col("c_custkey").alias("o_custkey"), "c_nationkey"],
        "nation": [F.col("n_nationkey").alias("c_nationkey"), "n_name"],
    }
    stored = []
    for name, chosen in columns.items():
        path = session.new_shared_folder(sister, f"analysed-{name}")
        df = tables.read(name).select(*chosen)
        stored.append(session.analysed(sister, df, f"analysed_{name}", df.columns, path))
    lines, orders, customers, nations = stored
    chain = lines.join(orders, "l_orderkey").join(customers, "o_custkey").join(nations, "c_nationkey")
    return chain.where(F.col("n_name") == COUNTRY).groupBy("status").agg(
        F.count("*").alias("lines"), F.sum("units").alias("units")
    )


@query("""
    SELECT user_id, user_id || '-' || strftime(ts, '%Y%m%d') AS session_id,
           strftime(ts, '%Y-%m-%d %H:%M:%S') AS event_time, event_type AS event_name,
           json_extract_string(props, '$.k') AS user_query,
           CAST(user_id % 2 AS BIGINT) AS batch
    FROM events
""")
def replayed_stream(t: Tables) -> DataFrame:
    """Events arrive twice; the second batch is written, not committed, and run again."""
    root = session.new_shared_folder(t.spark, "replayed")
    events = t.clicks()
    for arrival in range(2):
        sinks.append_json(events.where(F.col("user_id") % 2 == arrival), f"{root}/in")
        run_batches(t.spark, root)
    batches.forget_last_commit(t.spark, f"{root}/checkpoint")
    run_batches(t.spark, root)
    projected = clicks.project_clicks(t.spark.createDataFrame([], schemas.CLICK_EVENT)).schema
    return batches.read_batches(t.spark, f"{root}/out", batches.GOOD, projected).drop(
        "ip", "channel", "metadata"
    )


def run_batches(spark: SparkSession, root: str) -> None:
    lines = batches.read_lines(spark, f"{root}/in", schemas.CLICK_EVENT)
    batches.start(lines, "batches", f"{root}/out", f"{root}/checkpoint", True).awaitTermination()


@query("""
    SELECT CASE WHEN user_id % 10 IN (3, 7) THEN 'dead' ELSE 'good' END AS kind,
           count(*) AS lines, CAST(sum(user_id) AS BIGINT) AS users
    FROM events GROUP BY 1
""")
def dead_letters(t: Tables) -> DataFrame:
    """Events as lines, of which some lack their end and some hold a name for a number."""
    root = session.new_shared_folder(t.spark, "letters")
    t.click_lines().write.text(f"{root}/in")
    run_batches(t.spark, root)
    good = batches.read_batches(t.spark, f"{root}/out", batches.GOOD, "user_id BIGINT")
    dead = batches.read_batches(t.spark, f"{root}/out", batches.DEAD, "line STRING")
    user = F.regexp_extract("line", r'"user_id":"?x?(\d+)', 1).cast("long").alias("user_id")
    kinds = good.select(F.lit("good").alias("kind"), "user_id").unionByName(
        dead.select(F.lit("dead").alias("kind"), user)
    )
    return kinds.groupBy("kind").agg(F.count("*").alias("lines"), F.sum("user_id").alias("users"))

"""Column names and types of every dataset, as DDL strings or name-to-type maps.

CSV maps list the columns that some plan names; the reader finds them by header
name and keeps the file's other columns as text. Numbers whose kind is not stated
anywhere are doubles, so that no decimal becomes null.
"""

from __future__ import annotations

# --- CSV: column name -> Spark type ------------------------------------------

RETAIL_SALES = {
    "Store ID": "string",
    "Product ID": "string",
    "Date": "date",
    "Units Sold": "double",
    "Sales Revenue (USD)": "double",
    "Store Location": "string",
    "Discount Percentage": "double",
    "Product Category": "string",
    "Day of the Week": "string",
}

OLIST_ORDERS = {
    "order_id": "string",
    "customer_id": "string",
    "order_status": "string",
    "order_purchase_timestamp": "timestamp",
    "order_delivered_carrier_date": "timestamp",
    "order_delivered_customer_date": "timestamp",
    "order_estimated_delivery_date": "timestamp",
}

OLIST_ORDER_ITEMS = {
    "order_id": "string",
    "order_item_id": "int",
    "product_id": "string",
    "price": "double",
    "freight_value": "double",
}

OLIST_PRODUCTS = {"product_id": "string", "product_category_name": "string"}

OLIST_CUSTOMERS = {
    "customer_id": "string",
    "customer_zip_code_prefix": "string",
    "customer_state": "string",
}

OLIST_GEOLOCATION = {
    "geolocation_zip_code_prefix": "string",
    "geolocation_city": "string",
    "geolocation_state": "string",
}

BUSINESSES = {
    "business_id": "string",
    "name": "string",
    "address": "string",
    "city": "string",
    "state": "string",
    "postal_code": "string",
    "latitude": "double",
    "longitude": "double",
    "phone_number": "string",
}

INSPECTIONS = {"business_id": "string", "score": "double", "date": "string", "type": "string"}

SCHOOL_ATTENDANCE = {
    "School DBN": "string",
    "SchoolYear": "string",
    "Enrolled": "double",
    "Absent": "double",
}

CENSUS = {
    "GEO.id2": "int",
    "GEO.display-label": "string",
    "rescen42010": "string",
    "respop72010": "long",
    "respop72011": "long",
    "respop72012": "long",
    "respop72013": "long",
    "respop72014": "long",
    "respop72015": "long",
    "respop72016": "long",
    "respop72017": "long",
}

CAMPUSES = {"LocationName": "string", "LocationType": "string", "Address": "string"}

COUNTY_ZIP = {"zip": "string", "county": "int"}

BRAZIL_CITIES = {
    "CITY": "string",
    "AREA": "string",
    "IBGE_RES_POP": "long",
    "IBGE_POP": "long",
    "MAC": "long",
}

GROCERY = {
    "date": "string",
    "value": "string",
    "main-category": "string",
    "sub-category": "string",
}

# --- JSON: DDL ----------------------------------------------------------------

SHIPMENT = """
    supplier STRUCT<name: STRING, city: STRING, state: STRING, country: STRING>,
    customer STRUCT<name: STRING, city: STRING, state: STRING, country: STRING>,
    books ARRAY<STRUCT<qty: BIGINT, title: STRING>>
"""

DURHAM_REGISTRY = """
    fields STRUCT<
        id: STRING, premise_name: STRING, premise_address1: STRING,
        premise_address2: STRING, premise_city: STRING, premise_state: STRING,
        premise_zip: STRING, premise_phone: STRING, opening_date: STRING,
        closing_date: STRING, type_description: STRING,
        geolocation: ARRAY<DOUBLE>>
"""

CLICK_EVENT = """
    ip STRING, user_id BIGINT, user_agent STRING, session_id STRING,
    event_time STRING, event_name STRING, channel STRING,
    metadata STRUCT<query: STRING>
"""

EXIF = "image_path STRING, camera_make STRING, date_time_original STRING"

# --- small in-memory tables ----------------------------------------------------

JOIN_ORDERS = "order_id STRING, prod_id STRING, unit_price BIGINT, qty BIGINT"
JOIN_PRODUCTS = "prod_id STRING, prod_name STRING, list_price BIGINT, qty BIGINT"
PEOPLE = "ID STRING, Name STRING, Age INT"

# --- Parquet tables of the test data -------------------------------------------

TABLES = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": (
        "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"
    ),
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": (
        "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
        "p_retailprice DOUBLE"
    ),
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
        "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
    ),
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
        "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
        "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ"
    ),
    "events": (
        "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, "
        "props STRING"
    ),
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "embeddings": "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT",
    "pages": "page_id BIGINT, url STRING, html STRING",
    "benchmark": "item_id BIGINT, text STRING",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
}

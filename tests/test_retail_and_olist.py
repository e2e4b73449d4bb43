from datetime import date, datetime

from tallyworks import schemas
from tallyworks.plans import olist, retail
from tallyworks.sources import literals

SALES = """store_id STRING, product_id STRING, Date DATE, units_sold INT, sales_revenue_usd DOUBLE,
           store_location STRING, discount_percentage INT, product_category STRING"""


def sales(spark):
    return spark.createDataFrame(
        [
            ("s1", "p1", date(2022, 1, 5), 2, 10.0, "Oslo", 5, "toys"),
            ("s1", "p2", date(2022, 3, 5), 3, 20.5, "Oslo", 0, "toys"),
            ("s2", "p1", date(2022, 1, 31), 1, 5.1, "Bergen", None, "toys"),
            ("s3", "p3", date(2022, 12, 31), 7, 1.0, None, 10, "food"),
            ("s3", "p3", date(2023, 1, 1), 9, 1.0, "Voss", 10, "food"),
        ],
        SALES,
    )


def test_sales_questions(spark, rows):
    df = sales(spark)
    assert rows(retail.distinct_locations(df)) == [(3,)]
    assert rows(retail.discounted_sales(df)) == [(3,)]
    assert [tuple(r) for r in retail.top_locations(df, 2).collect()] == [("Oslo", 2), (None, 1)]
    flagged = retail.with_good_store(retail.top_locations(df), above=1)
    assert rows(flagged, "store_location", "is_good_store")[0] == ("Bergen", False)
    assert rows(retail.with_good_store_udf(retail.top_locations(df), above=1)) == rows(flagged)


def test_monthly_summary_and_running_total(spark, rows):
    summary = retail.monthly_category_summary(sales(spark))
    assert rows(summary) == [
        ("food", 2022, 12, 7, 1.0), ("toys", 2022, 1, 3, 15.1), ("toys", 2022, 3, 3, 20.5),
    ]
    running = retail.category_running_total(summary)
    assert running.columns == ["product_category", "year", "month", "units_sold_total", "RunningTotal"]
    assert rows(running, "product_category", "month", "RunningTotal") == [
        ("food", 12, 7), ("toys", 1, 3), ("toys", 3, 6),
    ]
    assert retail.monthly_category_summary(sales(spark).limit(0)).count() == 0


def test_tidy_sales_rounds_revenue_to_one_digit(spark):
    raw = spark.createDataFrame([(2.25,), (2.249,), (None,)], "`Sales Revenue (USD)` DOUBLE")
    tidy = retail.tidy_sales(raw).collect()
    assert [r[0] for r in tidy] == [2.3, 2.2, None]


# An order of a product that is not in stock, and a quantity on both sides.
ORDERS = [
    ("o-1", "lamp", 40, 2), ("o-1", "rug", 95, 1), ("o-2", "lamp", 42, 5), ("o-3", "vase", 12, 4),
]
PRODUCTS = [("lamp", "Reading lamp", 45, 8), ("rug", "Woven rug", 99, 3), ("desk", "Oak desk", 310, 1)]


def test_order_lines(spark, rows):
    orders = literals.typed_rows(spark, ORDERS, schemas.JOIN_ORDERS)
    products = literals.typed_rows(spark, PRODUCTS, schemas.JOIN_PRODUCTS)
    lines = retail.order_lines(orders, products)
    assert lines.columns == ["order_id", "prod_id", "prod_name", "unit_price", "list_price", "qty"]
    assert lines.count() == 3
    assert lines.where("prod_id = 'vase'").count() == 0
    assert rows(lines.where("prod_id = 'rug'")) == [("o-1", "rug", "Woven rug", 95, 99, 1)]


def test_people(spark):
    people = literals.people(spark, [("a-7", "Nina", 41), ("b-9", "Omar", 35)])
    assert people.rdd.getNumPartitions() == 2 and people.count() == 2
    doubled = literals.numbered_people(
        spark, [("F", "Ada", 52), ("M", "Ben", 19), ("F", "Ada", 52)]
    )
    unique = retail.unique_people(doubled).collect()
    assert [(r["Name"], r["Age"]) for r in unique] == [("Ben", 19), ("Ada", 52)]


ORDER_SCHEMA = """order_id STRING, customer_id STRING, order_status STRING,
    order_purchase_timestamp TIMESTAMP, order_delivered_carrier_date TIMESTAMP,
    order_delivered_customer_date TIMESTAMP, order_estimated_delivery_date TIMESTAMP"""


def olist_orders(spark):
    def at(day, hour=0, month=1, year=2018):
        return datetime(year, month, day, hour)

    return spark.createDataFrame(
        [
            ("o1", "c1", "delivered", at(1), at(2), at(3, 6), at(4)),
            ("o2", "c1", "delivered", at(1), at(2), at(5), at(4)),
            ("o3", "c2", "canceled", at(1, year=2017), None, None, at(4)),
            ("o4", "c2", "delivered", at(1, month=2), at(2), None, at(4)),
            ("o5", "c3", "unavailable", at(1, month=2), None, None, at(4)),
            ("o6", "c3", None, at(1, month=2), None, None, at(4)),
            ("o7", None, "delivered", at(1, month=2), at(2), at(3), at(3)),
        ],
        ORDER_SCHEMA,
    )


def olist_items(spark):
    return spark.createDataFrame(
        [
            ("o1", 1, "p1", 10.0, 1.0), ("o1", 2, "p1", 10.0, 1.0), ("o2", 1, "p2", 250.0, 0.0),
            ("o3", 1, "p1", 99.0, 1.0), ("o4", 1, "p3", 100.0, 0.005), ("o6", 1, "p1", 5.0, 0.0),
            ("zz", 1, "p2", 1.0, 1.0),
        ],
        "order_id STRING, order_item_id INT, product_id STRING, price DOUBLE, freight_value DOUBLE",
    )


def olist_customers(spark):
    return spark.createDataFrame(
        [("c1", "01", "SP"), ("c2", "02", "SP"), ("c3", "02", "RJ"), ("c4", "99", "RJ")],
        "customer_id STRING, customer_zip_code_prefix STRING, customer_state STRING",
    )


def test_status_counts_and_repeat_customers(spark, rows):
    orders = olist_orders(spark)
    assert rows(olist.orders_by_status(orders)) == [
        ("canceled", 1), ("delivered", 4), ("unavailable", 1), (None, 1),
    ]
    assert rows(olist.repeat_customers(orders)) == [("c1", 2), ("c2", 2), ("c3", 2)]


def test_customer_average_is_a_mean_of_order_means(spark, rows):
    averages = olist.customer_average_order(olist_items(spark), olist_orders(spark))
    # c1: order means (11 + 21) / 2 = 16 and 250; c2: 100.005 rounds up; unknown status is left out.
    assert [tuple(r) for r in averages.collect()] == [("c1", 2, 133.0), ("c2", 1, 100.01)]
    tiers = olist.spending_tiers(averages)
    assert rows(tiers, "customer_id", "category") == [("c1", "normal"), ("c2", "normal")]


def test_basket_and_categories(spark, rows):
    items = olist_items(spark)
    assert rows(olist.largest_basket(items)) == [(2,)]
    assert rows(olist.largest_basket(items.limit(0))) == [(None,)]
    products = spark.createDataFrame(
        [("p1", "toys"), ("p2", None), ("p4", "food")],
        "product_id STRING, product_category_name STRING",
    )
    assert rows(olist.units_per_category(items, products)) == [("toys", 5), (None, 2)]


def test_places(spark, rows):
    geo = olist.one_place_per_zip(
        spark.createDataFrame(
            [("01", "sao paulo", "SP"), ("01", "osasco", "SP"), ("02", "rio", "RJ")],
            "geolocation_zip_code_prefix STRING, geolocation_city STRING, geolocation_state STRING",
        )
    )
    sold = olist.sold_products(
        olist_items(spark), olist_orders(spark), olist_customers(spark), geo
    )
    assert [tuple(r) for r in olist.products_by_city(sold).collect()] == [
        ("RJ", "rio", "p3", 1), ("RJ", "rio", "p1", 2),
        ("SP", "osasco", "p2", 1), ("SP", "osasco", "p1", 2),
    ]
    assert rows(olist.top_product(sold)) == [("RJ", "p1", 2), ("SP", "p1", 2)]
    assert rows(olist.top_product(sold.limit(0))) == []


def test_buyers_and_never_bought(spark, rows):
    items, orders, customers = olist_items(spark), olist_orders(spark), olist_customers(spark)
    assert [tuple(r) for r in olist.buyers_per_state(items, orders, customers).collect()] == [
        ("SP", 2), ("RJ", 1),
    ]
    assert rows(olist.never_bought(customers, orders)) == [("c4", "99", "RJ")]
    assert olist.never_bought(customers, orders.limit(0)).count() == 4


def test_delivery_times_and_rates(spark, rows):
    orders, customers = olist_orders(spark), olist_customers(spark)
    # o1 took 30 hours, o2 72; o4 has no arrival and o7 no customer.
    assert rows(olist.delivery_hours_by_state(orders, customers)) == [("SP", 51.0)]
    assert rows(olist.cancellation_rate(orders)) == [(1, 3, 1, 1 / 3 * 100), (2, 4, 0, 0.0)]
    assert rows(olist.cancellation_rate(orders, by_year=True)) == [
        (2017, 1, 1, 1, 100.0), (2018, 1, 2, 0, 0.0), (2018, 2, 4, 0, 0.0),
    ]
    late = [tuple(r) for r in olist.late_delivery_rate(orders).collect()]
    assert late == [(2018, 2, 0, 1, 0.0), (2018, 1, 1, 2, 50.0)]


def test_olist_files(spark, tmp_path):
    (tmp_path / "olist_orders_dataset.csv").write_text(
        "order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,"
        "order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date\n"
        "o1,c1,delivered,2018-01-01 10:00:00,,2018-01-02 10:00:00,2018-01-03 10:00:00,2018-01-04 00:00:00\n"
        "o1,c1,delivered,2018-01-01 10:00:00,,2018-01-02 10:00:00,2018-01-03 10:00:00,2018-01-04 00:00:00\n"
        "o2,c1,canceled,not a time,,,,\n"
    )
    (tmp_path / "olist_order_items_dataset.csv").write_text(
        "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\n"
        "o1,1,p1,s,2018-01-01,10.5,1.5\n"
    )
    (tmp_path / "olist_products_dataset.csv").write_text("product_id,product_category_name\np1,toys\n")
    (tmp_path / "olist_customers_dataset.csv").write_text(
        "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\n"
        "c1,u,01037,sp,SP\n"
    )
    (tmp_path / "olist_geolocation_dataset.csv").write_text(
        "geolocation_zip_code_prefix,geolocation_lat,geolocation_lng,geolocation_city,geolocation_state\n"
        "01037,1,2,sao paulo,SP\n01037,1,2,osasco,SP\n"
    )
    base = str(tmp_path)
    orders = olist.load_orders(spark, base)
    assert orders.count() == 2
    assert orders.where("order_id = 'o2'").first()["order_purchase_timestamp"] is None
    items, geo = olist.load_order_items(spark, base), olist.load_geo(spark, base)
    sold = olist.sold_products(items, orders, olist.load_customers(spark, base), geo)
    assert [tuple(r) for r in olist.products_by_city(sold).collect()] == [("SP", "osasco", "p1", 1)]
    units = olist.units_per_category(items, olist.load_products(spark, base))
    assert [tuple(r) for r in units.collect()] == [("toys", 1)]

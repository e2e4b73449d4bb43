import json
from collections import Counter
from datetime import date, datetime

import pytest

from tallyworks import schemas
from tallyworks.functions import text
from tallyworks.operators import aggregates
from tallyworks.plans import (
    brazil,
    census,
    consular,
    grocery,
    rental,
    restaurants,
    schools,
    shipments,
)


def test_shipments(spark, rows, tmp_path):
    party = {"name": "n", "city": "c", "state": "s", "country": "x"}
    documents = [
        {"supplier": party, "customer": party, "books": [{"qty": 2, "title": "A"}, {"qty": 1, "title": "B"}]},
        {"supplier": party, "customer": None, "books": []},
    ]
    path = tmp_path / "shipment.json"
    path.write_text(json.dumps(documents, indent=2))
    flat = shipments.flatten_shipments(shipments.load_shipments(spark, str(path)))
    assert flat.columns[:2] == ["supplier_name", "supplier_city"]
    assert flat.columns[-2:] == ["qty", "title"]
    assert rows(flat, "customer_country", "qty", "title") == [("x", 1, "B"), ("x", 2, "A")]


def registries(spark):
    wake = spark.createDataFrame(
        [("1", "9", "X", "s", "Ann", "77", "1 St", None, "Cary", "NC", "27511", "1", "2010-05-04", "Cafe", "1", "2")],
        "OBJECTID STRING, PERMITID STRING, GEOCODESTATUS STRING, SHAPE STRING, NAME STRING, HSISID STRING, "
        "ADDRESS1 STRING, ADDRESS2 STRING, CITY STRING, STATE STRING, POSTALCODE STRING, PHONENUMBER STRING, "
        "RESTAURANTOPENDATE STRING, FACILITYTYPE STRING, X STRING, Y STRING",
    )

    def fields(**change):
        known = {
            "id": "5", "premise_name": "Bob", "premise_address1": "2 St", "premise_city": "Durham",
            "premise_state": "NC", "premise_zip": "27701", "premise_phone": "2",
            "opening_date": "2011-01-01", "closing_date": None, "type_description": "1 - Bakery",
            "geolocation": [35.5, -78.5],
        }
        return json.dumps({"fields": {**known, **change}, "geometry": {}, "recordid": "r"})

    lines = [
        fields(),
        fields(id="6", type_description="Bakery", geolocation=[], closing_date="2012-02-30"),
        fields(id=None, geolocation=None),
    ]
    return wake, spark.read.schema(schemas.DURHAM_REGISTRY).json(spark.sparkContext.parallelize(lines))


def test_registries_unite(spark, rows):
    united = restaurants.all_restaurants(*registries(spark))
    assert set(united.columns) == {
        "datasetId", "name", "address1", "address2", "city", "state", "zip", "tel", "dateStart",
        "dateEnd", "type", "geoX", "geoY", "county", "id",
    }
    assert dict(united.dtypes)["dateEnd"] == "date"
    assert rows(united, "id", "type", "geoX", "geoY", "dateStart", "dateEnd") == [
        ("NC_Durham_5", "Bakery", "35.5", "-78.5", date(2011, 1, 1), None),
        ("NC_Durham_6", None, None, None, date(2011, 1, 1), None),
        ("NC_Wake_77", "Cafe", "1", "2", date(2010, 5, 4), None),
        (None, "Bakery", None, None, date(2011, 1, 1), None),
    ]


def inspected(spark):
    businesses = spark.createDataFrame(
        [(i, "n", "a", "c", "s", "p", 1.0, 2.0, None) for i in "12345"],
        "business_id STRING, name STRING, address STRING, city STRING, state STRING, "
        "postal_code STRING, latitude DOUBLE, longitude DOUBLE, phone_number STRING",
    )
    inspections = spark.createDataFrame(
        [("1", 93, "2015-01-02", "t"), ("1", 91, "2016-01-02", "t"), ("2", 100, "d", "t"), ("2", None, "d", "t"),
         ("3", None, "d", "t"), ("4", 92, "d", "t"), ("4", 93, "d", "t"), ("9", 1, "d", "t")],
        "business_id STRING, score INT, date STRING, type STRING",
    )
    return restaurants.inspected_businesses(businesses, inspections)


def test_inspected_businesses(spark, rows):
    df = inspected(spark)
    assert rows(df, "business_id", "part") == [("1", 2015), ("1", 2016), ("2", 0), ("3", 0), ("4", 0), ("5", 0)]
    # Mean 92 is not above the mark; no score at all may open.
    verdicts = df.select("business_id", "can_be_opened").distinct()
    assert rows(verdicts) == [("1", False), ("2", True), ("3", True), ("4", True), ("5", True)]
    closed = restaurants.may_not_open(df).selectExpr("business_id", "explode(inspections.score)")
    assert rows(closed) == [("1", 91), ("1", 93)]
    lonely = df.where("business_id = '5'").first()
    assert [tuple(i) for i in lonely["inspections"]] == [(None, None, None)]


def test_inspected_businesses_as_json(spark, tmp_path):
    path = str(tmp_path / "out")
    restaurants.write_inspected(inspected(spark), path)
    restaurants.write_inspected(inspected(spark), path)
    back = spark.read.json(path)
    assert back.count() == 6
    closed = back.where("can_be_opened = false AND part = 2016").first()
    assert closed["inspections"][0]["score"] == 91


def test_film_sources(spark, rows):
    film = spark.createDataFrame([(1, "A"), (2, "B")], "film_id INT, title STRING")
    link = spark.createDataFrame([(1, 7)], "film_id INT, category_id INT")
    category = spark.createDataFrame([(7, "Action")], "category_id INT, name STRING")
    assert rows(rental.films(film, link, category)) == [(1, "A", "Action")]
    customer = spark.createDataFrame([(1, 10)], "customer_id INT, address_id INT")
    address = spark.createDataFrame(
        [(10, "st", "d", "p", "t", 20)],
        "address_id INT, address STRING, district STRING, postal_code STRING, phone STRING, city_id INT",
    )
    city = spark.createDataFrame([(20, "Salta", 30)], "city_id INT, city STRING, country_id INT")
    country = spark.createDataFrame([(30, "Argentina")], "country_id INT, country STRING")
    home = rental.customers(customer, address, city, country)
    assert rows(home, "customer_id", "city", "country") == [(1, "Salta", "Argentina")]


def rental_tables(spark):
    films = spark.createDataFrame(
        [(1, "A", "Action", 2.99), (2, "B", "Drama", 0.99)],
        "film_id INT, title STRING, category STRING, rental_rate DOUBLE",
    )
    customers = spark.createDataFrame(
        [(148, "Ann", "a@x", "Argentina"), (2, "Bob", "b@x", "Chile")],
        "customer_id INT, first_name STRING, email STRING, country STRING",
    )
    at = datetime
    rentals = spark.createDataFrame(
        [
            (148, 1, at(2005, 5, 1), at(2005, 5, 2)), (148, 2, at(2005, 5, 9), None),
            (148, 1, at(2005, 6, 1), at(2005, 6, 2)), (148, 1, at(2006, 2, 1), None),
            (2, 1, at(2005, 5, 1), None), (2, 3, at(2005, 5, 1), None),
        ],
        "customer_id INT, film_id INT, rental_date TIMESTAMP, return_date TIMESTAMP",
    )
    return rentals, customers, films


def test_rentals(spark, rows):
    rentals, customers, films = rental_tables(spark)
    assert [tuple(r) for r in rental.category_rentals(rentals, customers, films).collect()] == [
        ("Action", 3), ("Drama", 1),
    ]
    assert rows(rental.unreturned(rentals, customers, films), "first_name", "title") == [
        ("Ann", "A"), ("Ann", "B"), ("Bob", "A"),
    ]
    assert [tuple(r) for r in rental.accumulated_spend(rentals, films).collect()] == [
        (2005, 5, 3.98, 3.98), (2005, 6, 2.99, 6.97), (2006, 2, 2.99, 2.99),
    ]
    top = rental.top_films_by_month(rentals, films, k=1)
    assert rows(top) == [(1, 2005, 5, 2), (1, 2005, 6, 1), (1, 2006, 2, 1)]
    assert rows(rental.repeat_toppers(top)) == [(1, 3)]
    assert rows(rental.films_per_category(films)) == [("Action", 1), ("Drama", 1)]


def test_monthly_tops_are_counted_in_parts_that_follow_the_rows(spark, rows, plan, monkeypatch):
    """A hot film, rentals without film, without date and of unknown films, a repeated film; ties."""
    monkeypatch.setattr(aggregates, "PART_ROWS", 40)
    made = [(k % 7, datetime(2005, 1 + k % 3, 1 + k % 28, k % 24)) for k in range(300)]
    made += [(1, datetime(2005, 2, 3))] * 90 + [(None, datetime(2005, 1, 1))] * 50 + [(2, None)] * 9 + [(1, None)] * 9
    rentals = spark.createDataFrame(made, "film_id INT, rental_date TIMESTAMP")
    films = spark.createDataFrame([(k,) for k in (1, 2, 3, 4, 4, 5, None, 99)], "film_id INT")
    counts = Counter((f, d and d.year, d and d.month) for f, d in made if f in range(1, 6))
    expected = []
    for month in {key[1:] for key in counts}:
        best = sorted((-n, key[0]) for key, n in counts.items() if key[1:] == month)[:3]
        expected += [(film, *month, -n) for n, film in best]
    top = rental.top_films_by_month(rentals, films, k=3)
    assert rows(top) == sorted(expected, key=repr)
    often = Counter(film for film, *_ in expected)
    assert rows(rental.repeat_toppers(top)) == sorted(((f, n) for f, n in often.items() if n > 1), key=repr)
    text = plan(top)
    assert text.count("REPARTITION_BY_NUM") >= 3 and text.count(", 12), REPARTITION_BY_NUM") >= 3
    assert "LeftSemi" not in text


def rented_films(spark):
    """Film 1 is rented three times, 2 once, 3 and 4 never; one rental has no film, one no known film."""
    films = spark.createDataFrame(
        [(1, "Trailers,Commentaries", 3, 1.0), (2, "Trailers", 5, 1.0), (3, None, 5, 1.0), (4, "Other", None, 1.0)],
        "film_id INT, special_features STRING, rental_duration INT, rental_rate DOUBLE",
    )
    return spark.createDataFrame([(f,) for f in (1, 1, 1, 2, None, 9)], "film_id INT"), films


def test_rentals_per_feature(spark, rows, plan):
    rentals, films = rented_films(spark)
    got = rental.rentals_per_feature(rentals, films)
    assert rows(got, "feature", "has_feature", "films", "rentals", "rentals_per_film") == [
        ("feature_behind_the_scenes", 0, 4, 4, 1.0),
        ("feature_commentaries", 0, 3, 1, 1 / 3),
        ("feature_commentaries", 1, 1, 3, 3.0),
        ("feature_deleted_scenes", 0, 4, 4, 1.0),
        ("feature_trailers", 0, 2, 0, 0.0),
        ("feature_trailers", 1, 2, 4, 2.0),
    ]
    # Films are summed before they are taken apart by feature.
    below = plan(got).split("Expand")[1]
    assert "HashAggregate" in below.split("Join")[0]
    assert rental.rentals_per_feature(rentals, films.limit(0)).count() == 0
    assert {r[1] for r in rows(rental.rentals_per_feature(rentals.limit(0), films), "films", "rentals")} == {0}


def test_rentals_per_value_and_trends(spark, rows):
    rentals, films = rented_films(spark)
    assert rows(rental.rentals_per_value(rentals, films)) == [(3, 1, 3, 3.0), (5, 2, 1, 0.5), (None, 1, 0, 0.0)]
    trends = rental.rental_trends(rentals, films, ["rental_duration", "rental_rate"])
    assert rows(trends) == [("rental_duration", 3, -0.944911, -1.25), ("rental_rate", 4, None, None)]
    empty = rental.rental_trends(rentals, films.limit(0), ["rental_duration"])
    assert rows(empty) == [("rental_duration", 0, None, None)]


def test_rentals_through_inventory(spark, rows):
    rentals, customers, films = rental_tables(spark)
    by_copy = rentals.withColumnRenamed("film_id", "inventory_id")
    copies = spark.createDataFrame([(i, i, 1) for i in (1, 2, 3)], "inventory_id INT, film_id INT, store_id INT")
    assert rows(rental.rentals(by_copy, copies), "customer_id", "film_id", "store_id")[0] == (148, 1, 1)
    assert rows(rental.category_rentals(by_copy, customers, films, inventory=copies)) == rows(
        rental.category_rentals(rentals, customers, films)
    )
    assert rows(rental.unreturned(by_copy, customers, films, copies)) == rows(
        rental.unreturned(rentals, customers, films)
    )


def test_film_catalogue(spark):
    raw = spark.createDataFrame(
        [(1, "d", "Trailers,Commentaries", "PG"), (2, "d", None, "?")],
        "film_id INT, description STRING, special_features STRING, rating STRING",
    )
    first, second = rental.catalogue(raw).orderBy("film_id").collect()
    assert first["rating"] == "PARENTAL_GUIDANCE" and first["feature_commentaries"] == 1
    assert second["rating"] is None and second["feature_trailers"] is None
    assert "description" not in first and "special_features" not in first


def test_schools(spark, rows, tmp_path):
    path = tmp_path / "attendance.csv"
    path.write_text(
        "School DBN,Date,SchoolYear,Enrolled,Absent,Present,Released\n"
        "A,20190101,20182019,10,1,9,0\nA,20190102,20182019,11,2,9,0\n"
        "B,20190101,20182019,21,3,18,0\nC,20200101,20192020,,5,1,0\n"
    )
    df = schools.load_attendance(spark, str(path))
    assert rows(schools.school_count(df)) == [(3,)]
    assert rows(schools.average_enrolment(df)) == [("20182019", 14.0), ("20192020", None)]
    assert rows(schools.enrolment_rank(df)) == [
        ("20182019", "A", 21, 1), ("20182019", "B", 21, 2), ("20192020", "C", None, 1),
    ]
    assert rows(schools.absence_rank(df)) == [
        ("20182019", "A", 3, 1), ("20182019", "B", 3, 2), ("20192020", "C", 5, 1),
    ]


def test_consular_folder(spark, rows, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"x": 1}, {"x": 2}], indent=1))
    (tmp_path / "b.json").write_text(json.dumps({"x": 3}, indent=1))
    (tmp_path / "below").mkdir()
    (tmp_path / "below" / "c.json").write_text('{"x": 4}')
    folder = str(tmp_path)
    assert rows(consular.record_count(consular.load_documents(spark, folder))) == [(3,)]
    assert rows(consular.load_documents(spark, folder, "x INT")) == [(1,), (2,), (3,)]


def test_census(spark, rows, tmp_path):
    years = ",".join(f"respop7201{y}" for y in range(8))
    path = tmp_path / "census.csv"
    path.write_text(
        f"GEO.id,GEO.id2,GEO.display-label,rescen42010,resbase42010,{years}\n"
        '0500000US01001,01001,"Autauga County, Alabama",54571,54571,' + ",".join("1" * 8) + "\n"
        '0500000US37135,37135,"Orange County, North Carolina",1,1,' + ",".join("2" * 8) + "\n"
        "x,5,United States,1,1," + ",".join("3" * 8) + "\n"
    )
    counties = census.counties(census.load_census(spark, str(path)))
    assert counties.columns == [
        "id", "label", "real2010", *(f"est201{y}" for y in range(8)), "stateId", "countyId", "state", "county",
    ]
    assert rows(counties, "id", "stateId", "countyId", "state", "county") == [
        (1001, 1, 1, "Alabama", "Autauga County"),
        (37135, 37, 135, "North Carolina", "Orange County"),
        (5, 0, 5, None, "United States"),
    ]
    campuses = spark.createDataFrame(
        [("UNC", "Institution", "1 South Rd, Chapel Hill, NC 27514-0001"), ("B", "Additional Location", "x 27514"),
         ("C", "Institution", None), ("D", "Institution", "2 Main St 36003"), ("E", "Institution", "3 St 99999")],
        "LocationName STRING, LocationType STRING, Address STRING",
    )
    zips = spark.createDataFrame([("27514", 37135), ("27514", 1001), ("36003", 1001)], "zip STRING, county INT")
    located = census.institutions_by_county(census.institutions(campuses), zips, counties)
    assert located.columns == [*counties.columns, "zip", "institution"]
    assert rows(located, "id", "zip", "institution") == [
        (1001, "27514", "UNC"), (1001, "36003", "D"), (37135, "27514", "UNC"),
    ]
    assert census.sample_counties(counties, 1.0).count() <= 3
    assert census.sample_counties(counties, 0.5, 1).count() == census.sample_counties(counties, 0.5, 1).count()


def test_cities(spark, rows, tmp_path):
    path = tmp_path / "cities.csv"
    path.write_text(
        "CITY;STATE;AREA;IBGE_RES_POP;IBGE_POP;MAC\n"
        "Altamira;PA;159.533,33;99075;77193;\nSao Paulo;SP;1.521,11;11253503;10463636;130\n"
        "Zero;X;;5;10;0\nBad;X;n/a;;;\n"
    )
    cities = brazil.load_cities(spark, str(path))
    assert rows(brazil.most_populous(cities)) == [("Sao Paulo", 11253503)]
    assert rows(brazil.widest(cities)) == [("Altamira", 159533.33)]
    density = rows(brazil.people_per_outlet(cities))
    assert density[0][:3] == ("Sao Paulo", 10463636, 130)
    assert density[0][3] == pytest.approx(10463636 / 130)
    assert density[1] == ("Zero", 10, 0, None)


def test_grocery(spark, rows, tmp_path):
    path = tmp_path / "grocery.csv"
    path.write_text(
        "date,value,main-category,sub-category\n"
        '30/12/2024,"10,5",market,\n31/12/2024,"20,25",meal,\n01/01/2025,"9,75",meal,\n'
        '02/01/2025,"99,9",meal,dinner\n08/01/2025,"1,5",market,fruit\nbad,"3",market,\n'
    )
    spending = grocery.load_spending(spark, str(path))
    assert rows(grocery.market_and_meals(spending)) == [(1, 30.0, 15.0, 20.25, 10.5)]
    assert rows(grocery.market_and_meals(spending, by_year=True)) == [(2025, 1, 30.0, 15.0, 20.25, 10.5)]
    assert rows(grocery.spending_by_category(spending), "week", "expending", "category") == [
        (1, 10.5, "market "), (1, 30.0, "meal "), (1, 99.9, "meal dinner"), (2, 1.5, "market fruit"),
        (None, 3.0, "market "),
    ]
    assert spending.where("date IS NULL").count() == 1


def test_zip_of_numbers(spark, rows):
    df = spark.createDataFrame([(601,)], "z INT").select(text.zip5("z"))
    assert rows(df) == [("00601",)]

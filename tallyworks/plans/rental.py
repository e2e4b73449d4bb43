"""Film rentals: catalogue, rentals per country, open rentals, spending, monthly tops."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.functions import money, rules
from tallyworks.operators import aggregates, joins, windows
from tallyworks.sources import jdbc


def load_table(
    spark: SparkSession,
    connection: Mapping[str, str],
    table: str,
    split: jdbc.Split | None = None,
    key: str | None = None,
    parts: int = 16,
) -> DataFrame:
    """A table of the database, read by several tasks if a split or a numeric key is named."""
    if split is None and key is not None:
        split = jdbc.find_split(spark, connection, f"SELECT * FROM {table}", key, parts)
    return jdbc.read_table(spark, connection, table, split)


def films(film: DataFrame, film_category: DataFrame, category: DataFrame) -> DataFrame:
    """Films with their category name; films without a category drop out."""
    names = category.select("category_id", F.col("name").alias("category"))
    of_film = joins.lookup(
        film_category.select("film_id", "category_id"), names, "category_id"
    ).drop("category_id")
    return joins.lookup(film, of_film, "film_id")


def customers(
    customer: DataFrame, address: DataFrame, city: DataFrame, country: DataFrame
) -> DataFrame:
    """Customers with address, city and country."""
    cities = joins.lookup(
        city.select("city_id", "city", "country_id"),
        country.select("country_id", "country"),
        "country_id",
    )
    addresses = joins.lookup(
        address.select("address_id", "address", "district", "postal_code", "phone", "city_id"),
        cities,
        "city_id",
    )
    return joins.lookup(customer, addresses, "address_id")


def rentals(rental: DataFrame, inventory: DataFrame) -> DataFrame:
    """Rentals with the film and store of the rented copy.

    The rentals may be filtered, before or after this, to one customer or country;
    so the planner decides from the sizes it measures.
    """
    copies = inventory.select("inventory_id", "film_id", "store_id")
    return joins.lookup(rental, copies, "inventory_id")


def catalogue(film: DataFrame) -> DataFrame:
    """Films with feature flags and a coarse rating, without their long texts."""
    unused = ("special_features", "description")
    return film.select(
        *(name for name in film.columns if name not in unused),
        *rules.feature_flags("special_features", rules.FILM_FEATURES),
    ).withColumn("rating", rules.mapped("rating", rules.RATING_CLASS))


def films_per_category(film: DataFrame, ordered: bool = True) -> DataFrame:
    counted = aggregates.count_by(film, "category")
    return counted.orderBy(F.desc("count"), "category") if ordered else counted


def category_rentals(
    rental: DataFrame,
    customer: DataFrame,
    film: DataFrame,
    country: str = "Argentina",
    inventory: DataFrame | None = None,
    ordered: bool = True,
) -> DataFrame:
    """Rentals per category by customers of one country.

    Rentals that do not name their film yet get it from ``inventory``, after
    those of other countries are gone. They are counted per film before the
    film list is joined.
    """
    local = customer.where(F.col("country") == country).select("customer_id")
    chosen = joins.lookup(rental, local, "customer_id")
    if inventory is not None:
        chosen = rentals(chosen, inventory)
    totals = aggregates.sums_through(
        chosen, film, "film_id", ["category"], {"count": F.count("*")}
    )
    return totals.orderBy(F.desc("count"), "category") if ordered else totals


def times_rented(rental: DataFrame, film: DataFrame) -> DataFrame:
    """Every film with its ``rentals``, 0 for one that was never rented.

    Rentals are counted per film before the join, so a film that is rented much is one row.
    """
    counted = aggregates.count_by(rental.where(F.col("film_id").isNotNull()), "film_id", into="rentals")
    return film.join(counted, "film_id", "left").withColumn("rentals", F.coalesce("rentals", F.lit(0)))


def _per_film(totals: DataFrame) -> DataFrame:
    return totals.withColumn("rentals_per_film", F.col("rentals") / F.col("films"))


def rentals_per_feature(
    rental: DataFrame,
    film: DataFrame,
    features: Sequence[str] = rules.FILM_FEATURES,
    column: str = "special_features",
    separator: str = ",",
) -> DataFrame:
    """Do films with a feature rent more? Films, rentals and rentals per film, with and without each.

    A film without a list has none of the features. Films are first summed per set of
    features, of which there are few, and only these sums are counted once per feature.
    """
    flags = rules.feature_flags(column, features, separator)
    flagged = times_rented(rental, film).select("rentals", *flags).na.fill(0)
    names = flagged.columns[1:]
    sets = flagged.groupBy(*names).agg(F.count("*").alias("films"), F.sum("rentals").alias("rentals"))
    return _per_film(
        sets.unpivot(["films", "rentals"], names, "feature", "has_feature")
        .groupBy("feature", "has_feature")
        .agg(F.sum("films").alias("films"), F.sum("rentals").alias("rentals"))
    )


def rentals_per_value(rental: DataFrame, film: DataFrame, column: str = "rental_duration") -> DataFrame:
    """Films, rentals and rentals per film for each value of a film's column; null is a value."""
    return _per_film(
        times_rented(rental, film.select("film_id", column))
        .groupBy(column)
        .agg(F.count("*").alias("films"), F.sum("rentals").alias("rentals"))
    )


def rental_trends(rental: DataFrame, film: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    """Do films with a larger value rent more? Per numeric column, over all films that have one:
    how many, the correlation with the number of rentals, and by how many rentals one more
    of it goes along with. Both are null where the column does not vary.
    """
    known = times_rented(rental, film.select("film_id", *columns))
    trends = [
        F.struct(
            F.lit(name).alias("measure"),
            F.count(name).alias("films"),
            F.round(aggregates.correlation(name, "rentals"), digits).alias("correlation"),
            F.round(F.regr_slope("rentals", name), digits).alias("slope"),
        )
        for name in columns
    ]
    return known.agg(F.array(*trends).alias("trends")).select(F.inline("trends"))


def unreturned(
    rental: DataFrame,
    customer: DataFrame,
    film: DataFrame,
    inventory: DataFrame | None = None,
) -> DataFrame:
    """Who still holds which film, and since when; ``inventory`` as in ``category_rentals``."""
    named = joins.lookup(
        rental.where(F.col("return_date").isNull()),
        customer.select("customer_id", "first_name", "email"),
        "customer_id",
    )
    if inventory is not None:
        named = rentals(named, inventory)
    return joins.lookup(named, film.select("film_id", "title"), "film_id").select(
        "first_name", "email", "title", "rental_date"
    )


def accumulated_spend(
    rental: DataFrame, film: DataFrame, customer_id: int = 148, ordered: bool = True
) -> DataFrame:
    """One customer's spending per month, accumulated within each year."""
    date = F.col("rental_date")
    monthly = (
        joins.lookup(
            rental.where(F.col("customer_id") == customer_id).select("film_id", "rental_date"),
            film.select("film_id", "rental_rate"),
            "film_id",
        )
        .groupBy(F.year(date).alias("rental_year"), F.month(date).alias("rental_month"))
        .agg(money.exact_sum("rental_rate").alias("expending"))
    )
    accumulated = windows.running_total(
        monthly,
        "expending",
        ["rental_year"],
        ["rental_month"],
        "expending_accumulated",
        frame="range",
    ).withColumns(
        {
            "expending": F.col("expending").cast("double"),
            "expending_accumulated": F.col("expending_accumulated").cast("double"),
        }
    )
    return accumulated.orderBy("rental_year", "rental_month") if ordered else accumulated


def top_films_by_month(rental: DataFrame, film: DataFrame, k: int = 10) -> DataFrame:
    """The k most rented films of each month; of equals, the smaller id.

    Rentals of films outside the catalogue do not count, so the film list is
    joined to the counts. Most films of a month may be rented once, so there may be as many
    counts as rentals: they are dealt out to as many parts as the tables need, and what one
    task counts, joins and sorts does not grow with them. Days are counted first, so that
    a film that is rented much is not one task's.
    """
    parts = max(aggregates.parts_for(rental), aggregates.parts_for(film))
    daily = (
        rental.where(F.col("film_id").isNotNull())
        .select("film_id", F.to_date("rental_date").alias("day"))
        .repartition(parts, "film_id", "day")
        .groupBy("film_id", "day")
        .agg(F.count("*").alias("count"))
    )
    date = F.col("day")
    counted = (
        daily.select("film_id", F.year(date).alias("rental_year"), F.month(date).alias("rental_month"), "count")
        .repartition(parts, "film_id")
        .groupBy("film_id", "rental_year", "rental_month")
        .agg(F.sum("count").alias("count"))
    )
    # An inner join: a semi join is moved below the counts, where every rental would be sorted.
    known = counted.join(film.select("film_id").repartition(parts, "film_id").distinct(), "film_id")
    return windows.top_k(
        known, ["rental_year", "rental_month"], [F.desc("count"), F.asc("film_id")], k
    ).select("film_id", "rental_year", "rental_month", "count")


def repeat_toppers(top: DataFrame, ordered: bool = True) -> DataFrame:
    """Films that are among the tops of more than one month."""
    counted = aggregates.count_by(top, "film_id").where(F.col("count") > 1)
    return counted.orderBy(F.desc("count"), "film_id") if ordered else counted

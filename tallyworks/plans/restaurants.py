"""Restaurant registries of two counties, and inspections nested under businesses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks import schemas, sinks
from tallyworks.functions import dates, text
from tallyworks.operators import aggregates, shaping
from tallyworks.sources import files

# Source columns and the shared names.
WAKE_NAMES = {
    "HSISID": "datasetId",
    "NAME": "name",
    "ADDRESS1": "address1",
    "ADDRESS2": "address2",
    "CITY": "city",
    "STATE": "state",
    "POSTALCODE": "zip",
    "PHONENUMBER": "tel",
    "RESTAURANTOPENDATE": "dateStart",
    "FACILITYTYPE": "type",
    "X": "geoX",
    "Y": "geoY",
}
DURHAM_NAMES = {
    "fields.id": "datasetId",
    "fields.premise_name": "name",
    "fields.premise_address1": "address1",
    "fields.premise_address2": "address2",
    "fields.premise_city": "city",
    "fields.premise_state": "state",
    "fields.premise_zip": "zip",
    "fields.premise_phone": "tel",
    "fields.opening_date": "dateStart",
    "fields.closing_date": "dateEnd",
}
BUSINESS = tuple(schemas.BUSINESSES)
INSPECTION = ("score", "date", "type")


def load_wake(spark: SparkSession, path: str) -> DataFrame:
    return files.csv_text(spark, path)


def load_durham(spark: SparkSession, path: str) -> DataFrame:
    return files.json_lines(spark, path, schemas.DURHAM_REGISTRY)


def wake_registry(raw: DataFrame) -> DataFrame:
    """The first county's table in the shared shape, dates still as text."""
    return _registered(
        shaping.pick(raw, WAKE_NAMES).withColumn("dateEnd", F.lit(None).cast("string")), "Wake"
    )


def durham_registry(raw: DataFrame) -> DataFrame:
    """The second county's documents in the shared shape, dates still as text."""
    place = F.col("fields.geolocation")
    return _registered(
        raw.select(
            *(F.col(path).alias(name) for path, name in DURHAM_NAMES.items()),
            text.part("fields.type_description", " - ", 1).alias("type"),
            F.get(place, F.lit(0)).cast("string").alias("geoX"),
            F.get(place, F.lit(1)).cast("string").alias("geoY"),
        ),
        "Durham",
    )


def _registered(shaped: DataFrame, county: str) -> DataFrame:
    return shaped.withColumn("county", F.lit(county)).withColumn(
        "id", text.registry_id("state", "county", "datasetId")
    )


def all_restaurants(wake: DataFrame, durham: DataFrame) -> DataFrame:
    """Both registries in one table, with real dates."""
    return shaping.united(wake_registry(wake), durham_registry(durham)).withColumns(
        {
            "dateStart": dates.parsed_date("dateStart", "yyyy-MM-dd"),
            "dateEnd": dates.parsed_date("dateEnd", "yyyy-MM-dd"),
        }
    )


def load_businesses(spark: SparkSession, path: str) -> DataFrame:
    return files.csv_typed(spark, path, schemas.BUSINESSES)


def load_inspections(spark: SparkSession, path: str) -> DataFrame:
    return files.csv_typed(spark, path, schemas.INSPECTIONS)


def inspected_businesses(
    businesses: DataFrame, inspections: DataFrame, pass_mark: float = 92
) -> DataFrame:
    """Each business with its nested inspections and whether it may open.

    It may if it has no score or a mean score above ``pass_mark``. The mean is
    aggregated over all rows of a business, not over an array. There is one row per
    business and year of inspection, told apart by ``part`` (0 for dates without a
    year); a business without any has one with a single empty inspection.
    """
    kinds = {field.name: field.dataType for field in inspections.schema.fields}
    empty = F.array(F.struct(*(F.lit(None).cast(kinds[name]).alias(name) for name in INSPECTION)))
    return aggregates.nested_under(
        businesses.select(*BUSINESS).distinct(),
        inspections,
        ["business_id"],
        INSPECTION,
        "inspections",
        summary=[F.avg("score").alias("_mean")],
        part_by=F.substring("date", 1, 4).try_cast("int"),
    ).select(
        *BUSINESS,
        "part",
        F.coalesce("inspections", empty).alias("inspections"),
        F.coalesce(F.col("_mean") > pass_mark, F.lit(True)).alias("can_be_opened"),
    )


def may_not_open(inspected: DataFrame) -> DataFrame:
    return inspected.where(~F.col("can_be_opened"))


def write_inspected(inspected: DataFrame, path: str) -> None:
    sinks.write_json(inspected, path)

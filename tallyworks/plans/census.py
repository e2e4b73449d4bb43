"""Census counties and the higher education institutions in them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks import schemas
from tallyworks.functions import text
from tallyworks.operators import joins, shaping
from tallyworks.sources import files

# Census headers and the names used from here on.
CENSUS_NAMES = {
    "GEO.id2": "id",
    "GEO.display-label": "label",
    "rescen42010": "real2010",
    "respop72010": "est2010",
    "respop72011": "est2011",
    "respop72012": "est2012",
    "respop72013": "est2013",
    "respop72014": "est2014",
    "respop72015": "est2015",
    "respop72016": "est2016",
    "respop72017": "est2017",
}


def load_census(spark: SparkSession, path: str) -> DataFrame:
    return files.csv_typed(spark, path, schemas.CENSUS)


def load_campuses(spark: SparkSession, path: str) -> DataFrame:
    return files.csv_typed(spark, path, schemas.CAMPUSES)


def load_county_zips(spark: SparkSession, path: str) -> DataFrame:
    return files.csv_typed(spark, path, schemas.COUNTY_ZIP)


def counties(raw: DataFrame) -> DataFrame:
    """Census rows with state and county, as names and as codes.

    A label without a comma has no state.
    """
    unused = ("GEO.id", "resbase42010")
    named = raw.drop(*unused).withColumnsRenamed(CENSUS_NAMES)
    return named.withColumns(
        {
            "stateId": F.expr("int(id div 1000)"),
            "countyId": F.expr("id % 1000"),
            "state": F.trim(text.part("label", ",", 1)),
            "county": F.trim(text.part("label", ",", 0)),
        }
    )


def sample_counties(census: DataFrame, fraction: float = 0.01, seed: int = 42) -> DataFrame:
    """A random sample; which rows it holds depends on the partitioning."""
    return census.sample(fraction, seed)


def sample_by_key(df: DataFrame, key: str, fraction: float = 0.01, seed: int = 42) -> DataFrame:
    """A sample by a hash of the key: the same rows however the table is partitioned."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")).cast("binary"))
    place = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return df.where(place < int(fraction * 2**32))


def institutions(campuses: DataFrame) -> DataFrame:
    """Main campuses with the postal code at the end of their address."""
    return (
        campuses.where(F.col("LocationType") == "Institution")
        .where(F.col("Address").isNotNull())
        .withColumn("zip", text.zip5(text.last_part("Address", " ")))
    )


def institutions_by_county(
    campus: DataFrame, county_zips: DataFrame, census: DataFrame
) -> DataFrame:
    """Census rows of the counties that a campus's postal code lies in.

    The full county code of the postal code table is the ``id`` of the census
    table; codes are compared as text. A postal code may lie in more than one
    county and gives a row for each.
    """
    counties_of_zip = county_zips.select(
        text.zip5(F.col("zip").cast("string")).alias("zip"),
        F.col("county").cast("string").alias("_code"),
    )
    located = joins.lookup(
        campus.select("zip", F.col("LocationName").alias("institution")), counties_of_zip, "zip"
    )
    coded = census.withColumn("_code", F.col("id").cast("string"))
    return joins.lookup(located, coded, "_code").select(
        *(shaping.raw(name) for name in census.columns), "zip", "institution"
    )

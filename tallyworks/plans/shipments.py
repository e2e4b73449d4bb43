"""Nested shipment documents flattened to one row per book."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyworks import schemas
from tallyworks.operators import shaping
from tallyworks.sources import files

PARTY = ("name", "city", "state", "country")


def load_shipments(spark: SparkSession, path: str) -> DataFrame:
    return files.json_documents(spark, path, schemas.SHIPMENT)


def flatten_shipments(shipments: DataFrame) -> DataFrame:
    nested = {"supplier", "customer", "books"}
    rest = [shaping.raw(name) for name in shipments.columns if name not in nested]
    lifted = shipments.select(
        *rest,
        *shaping.lifted("supplier", PARTY),
        *shaping.lifted("customer", PARTY),
        "books",
    )
    return shaping.unnested(lifted, "books", ("qty", "title"))

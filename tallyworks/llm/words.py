"""What the text operators share: words, shingles, inputs."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WHITE = " \t\n\x0b\x0c\r"
#: A word is a run of characters other than the six ASCII white spaces.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """The words of a text, as an array without empty strings."""
    return F.filter(F.split(text, SPACE), lambda w: w != F.lit(""))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def unused(purpose: str) -> str:
    """A column name that no input can have by chance."""
    return f"__{purpose}_{uuid.uuid4().hex[:12]}"


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept away from fitting: one in five, by its id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0

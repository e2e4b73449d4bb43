"""Classification rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The rating classes and special features of the film catalogue.
RATING_CLASS = {
    "NC-17": "ADULTS_ONLY",
    "R": "ADULTS_ONLY",
    "PG-13": "PARENTAL_GUIDANCE",
    "PG": "PARENTAL_GUIDANCE",
    "G": "GENERAL",
}
FILM_FEATURES = ("Trailers", "Commentaries", "Deleted Scenes", "Behind the Scenes")


def good_store(count: str, above: int = 150) -> Column:
    return F.col(count) > above


def spending_tier(amount: str, normal: float = 100, prime: float = 250) -> Column:
    """Above ``prime``, strictly between the two, or basic (the bounds and null are basic)."""
    value = F.col(amount)
    return (
        F.when(value > prime, "prime")
        .when((value > normal) & (value < prime), "normal")
        .otherwise("basic")
    )


def mapped(code: str, classes: dict[str, str]) -> Column:
    """The class of a code; a code outside the map gives null."""
    branches = None
    for known, name in classes.items():
        source = F if branches is None else branches
        branches = source.when(F.col(code) == known, name)
    return branches


def feature_flags(
    text: str, features: Sequence[str], separator: str = ",", prefix: str = "feature_"
) -> list[Column]:
    """One 0/1 column per feature, telling whether the separated list names it."""
    listed = F.split(F.trim(F.col(text)), separator)
    return [
        F.array_contains(listed, feature)
        .cast("int")
        .alias(prefix + feature.lower().replace(" ", "_"))
        for feature in features
    ]

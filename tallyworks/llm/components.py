"""Connected components of a list of links, as DataFrame steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.session import pin


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b); the label is the smallest node reachable.

    Each round a node takes the smallest label next to it, and a label the smallest
    that any of its nodes has taken; the rounds grow with the logarithm of the
    longest path. Minima are combined before every shuffle, so a node with very
    many links costs one row a task. Each round is written to the shared folder.
    Links without an end or to the node itself are left out.
    """
    links = links.where("a <> b").select("a", "b")
    both = pin(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = pin(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("label")))
    while True:
        near = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        taken = labels.join(near, "node").select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("new")
        )
        taken = pin(taken)
        # A label is itself a node, so what it was given is what its nodes may take.
        jump = taken.groupBy(F.col("old").alias("root")).agg(F.min("new").alias("jump"))
        again = taken.select(F.col("node").alias("root"), F.col("new").alias("of_root"))
        moved = (
            taken.join(jump, taken["old"] == jump["root"])
            .drop("root")
            .join(again, F.col("jump") == again["root"])
            .select("node", "old", F.least("new", "jump", "of_root").alias("label"))
        )
        moved = pin(moved)
        labels = moved.select("node", "label")
        if moved.where("label <> old").isEmpty():
            return labels

"""Merkle manifest of a dataset: a content-addressed DAG and proofs by descending it.

Every row is a leaf, the SHA-256 of its fields. The leaves of a tree (of one source) stand
in the order of their ids; every 16 consecutive nodes become the hash of their digests,
level by level, until one is left, the tree's subroot. The subroots, in the order of their
trees, become the root in the same way.

Each level is a stored table of digest-to-children records. Requests for leaves start at the
root and descend by the base-16 digits of a rank, from the highest: a node's record is looked
up by its digest, the child that the digit names is taken, the digests left and right of it
are collected. Requests that agree in their upper digits are one row until they part, so the
siblings of a whole subtree travel once. At the leaves the collected segments are reversed:
they then lead from the leaf to the root, for a proof or for folding a leaf up again.

Nothing gathers a tree: ranks come from sorted slices (``windows.ranked``), a group holds at
most 16 nodes, and each level is a sixteenth of the one below. The driver sees one number
per level, whether more than one node is left in any tree.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.operators import windows
from tallyworks.session import pin

#: Nodes below one node; one hexadecimal digit of a rank.
FAN, DIGIT = 16, 4
SEGMENTS = "array<struct<left:string,right:string>>"


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def field(value: Column) -> Column:
    """A value as it enters a leaf: ``-`` if null, else its UTF-8 length, a colon and itself."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: Sequence[Column]) -> Column:
    return digest(F.concat(*map(field, values)))


@dataclass
class Forest:
    """The stored levels of trees that stand side by side.

    ``tops``: tree, rank 0, digest, height. ``levels[i]``: the nodes of level i + 1 with
    the digests of their children, for trees at least that high.
    """

    tops: DataFrame
    levels: list[DataFrame]


def grow(nodes: DataFrame) -> Forest:
    """The trees over nodes (``tree`` not null, ``rank`` from 0 without gaps, ``digest``)."""
    level = nodes.select("tree", "rank", "digest", F.lit(0).alias("height"))
    levels: list[DataFrame] = []
    while True:
        runs = level.groupBy("tree", F.shiftright("rank", DIGIT).alias("rank")).agg(
            F.sort_array(F.collect_list(F.struct("rank", "digest", "height"))).alias("run")
        )
        # Ranks have no gaps: a first run of one node is all that its tree has.
        alone = (F.col("rank") == 0) & (F.size("run") == 1)
        grown = runs.select(
            "tree",
            "rank",
            F.when(alone, F.col("run")[0]["digest"])
            .otherwise(digest(F.array_join("run.digest", "")))
            .alias("digest"),
            F.when(alone, F.col("run")[0]["height"]).otherwise(F.lit(len(levels) + 1)).alias("height"),
            F.when(~alone, F.col("run.digest")).alias("children"),
        )
        level = pin(grown)
        levels.append(level)
        if not level.agg(F.max("rank")).first()[0]:
            return Forest(level.drop("children"), levels)


def records(level: DataFrame) -> DataFrame:
    """The digest-to-children records of a level; equal subtrees share one."""
    kept = level.where("children IS NOT NULL")
    return kept.groupBy(F.col("digest").alias("_key")).agg(F.any_value("children").alias("_children"))


def enter(frontier: DataFrame, forest: Forest, at: int) -> DataFrame:
    """The frontier with the children of its nodes of level ``at``, null where a tree is lower."""
    # Those that are lower get keys that match nothing, each its own.
    key = F.when(F.col("height") >= at, F.col("digest")).otherwise(F.concat(F.lit("-"), F.col("digest")))
    keyed = frontier.withColumn("_at", key)
    return keyed.join(records(forest.levels[at - 1]), F.col("_at") == F.col("_key"), "left")


def descend(frontier: DataFrame, forest: Forest, down_to: int, asked: DataFrame | None = None) -> DataFrame:
    """Moves a frontier (tree, rank, digest, height, path, what else) from the tops to a level.

    A tree that is not as high as a level waits there. ``asked`` (tree, rank of leaves):
    only subtrees that hold one of them are entered.
    """
    fixed = ("tree", "rank", "digest", "height", "path")
    others = [c for c in frontier.columns if c not in fixed]
    for at in range(len(forest.levels), down_to, -1):
        children = F.coalesce("_children", F.array("digest"))
        split = enter(frontier, forest, at).select("*", F.posexplode(children))
        entered = F.col("_children").isNotNull()
        frontier = split.select(
            "tree",
            F.when(entered, F.col("rank") * FAN + F.col("pos")).otherwise(F.col("rank")).alias("rank"),
            F.col("col").alias("digest"),
            "height",
            extended(F.col("pos")).alias("path"),
            *others,
        )
        if asked is not None:
            upper = asked.select("tree", F.shiftright("rank", DIGIT * (at - 1)).alias("rank"))
            frontier = frontier.join(upper.distinct(), ["tree", "rank"], "left_semi")
    return frontier


def extended(place: Column) -> Column:
    """The path with the digests beside a child, if a node was entered."""
    left = F.slice("_children", F.lit(1), place)
    right = F.slice("_children", place + 2, F.lit(FAN))
    beside = F.struct(F.array_join(left, "").alias("left"), F.array_join(right, "").alias("right"))
    return F.when(F.col("_children").isNotNull(), F.array_append("path", beside)).otherwise(F.col("path"))


def above(path: Column) -> Column:
    """All digests beside the way from a leaf to the root, left to right in each run."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")


def fold(start: Column, path: Column) -> Column:
    """The root that follows from a leaf digest and the segments above it."""
    return F.aggregate(
        path, start, lambda below, s: digest(F.concat(s["left"], below, s["right"]))
    )


@dataclass
class Manifest:
    """A forest with a tree per name, and the tree over its tops.

    ``leaves``: tree, rank from 0, digest and the rows' further columns. ``order``: the
    trees' tops with their rank among the trees.
    """

    leaves: DataFrame
    trees: Forest
    order: DataFrame
    whole: Forest


def build(rows: DataFrame, tree: Column, order: Sequence[Column], kept: Sequence[Column]) -> Manifest:
    """The manifest of rows that have a ``digest``.

    ``tree``: the text column whose values have a tree each; null is the first tree, the
    others follow bytewise. ``order``: the order in a tree, then the digest decides; rows
    equal in both are leaves of their own and interchangeable. Of an empty table there is
    no root. ``kept``: further columns of ``leaves``.
    """
    # Null sorts before all others, an empty name next.
    named = F.coalesce(F.concat(F.lit("="), tree.cast("string")), F.lit(""))
    leaves = pin(rows.select(named.alias("tree"), "digest", *kept))
    placed = windows.ranked(leaves, ["tree"], [*order, F.asc("digest")], "rank")
    placed = pin(placed.withColumn("rank", F.col("rank") - 1))
    trees = grow(placed)
    tops = trees.tops.select("tree", "digest", "height", F.lit("").alias("all"))
    numbered = windows.ranked(tops, ["all"], [F.asc("tree")], "rank")
    ordered = pin(numbered.select("tree", (F.col("rank") - 1).alias("rank"), "digest", "height"))
    whole = ordered.withColumn("tree", F.lit(""))
    return Manifest(placed, trees, ordered, grow(whole))


def prove(manifest: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """The requested leaves with their ``subroot``, ``root`` and ``path``.

    ``requests``: rows of ``manifest.leaves`` with whatever columns, ``tree`` and ``rank``
    among them; all leaves if None. A path's segments (``left``, ``right``) lead from the
    leaf to the root; there is none for a level where a tree has one node only.
    """
    wanted = manifest.leaves if requests is None else requests
    start = manifest.whole.tops.select(
        "*", F.array().cast(SEGMENTS).alias("path"), F.col("digest").alias("root")
    )
    found = descend(start, manifest.whole, 0).select("rank", "path", "root")
    tops = found.join(manifest.order, "rank").select(
        "tree", F.lit(0).cast("long").alias("rank"), "digest", "height", "path",
        F.col("digest").alias("subroot"), "root",
    )
    runs = enter(descend(tops, manifest.trees, 1, requests), manifest.trees, 1).select(
        "tree", F.col("rank").alias("_run"), "path", "_children", "subroot", "root"
    )
    asked = wanted.groupBy("tree", F.shiftright("rank", DIGIT).alias("_run")).agg(
        F.collect_list(F.struct(*(c for c in wanted.columns if c != "tree"))).alias("_asked")
    )
    leaves = runs.join(asked, ["tree", "_run"]).select("*", F.explode("_asked").alias("_leaf"))
    digit = F.col("_leaf.rank").bitwiseAND(FAN - 1).cast("int")
    return leaves.select(
        "tree", "_leaf.*", "subroot", "root", F.reverse(extended(digit)).alias("path")
    )


def manifest_documents(docs: DataFrame, altered: Column | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, leaf, subroot, root, path, altered, folded_root.

    A leaf is made of doc_id, source, lang, n_chars and text; there is a tree per source,
    in the order of doc_id (null first). ``altered``: a leaf digest to fold up instead of
    the stored one, null where it is the stored one; ``folded_root`` is what the original
    siblings make of it. Repeated rows are leaves of their own; an empty table gives no rows;
    further columns are left behind.
    """
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    changed = F.lit(None).cast("string") if altered is None else altered
    rows = docs.select("doc_id", "source", leaf(fields).alias("digest"), changed.alias("altered"))
    manifest = build(rows, F.col("source"), [F.asc("doc_id")], ["doc_id", "altered"])
    proved = prove(manifest)
    return proved.select(
        "doc_id", F.col("digest").alias("leaf"), "subroot", "root", "path", "altered",
        fold(F.coalesce("altered", "digest"), F.col("path")).alias("folded_root"),
    )

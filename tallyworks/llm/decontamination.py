"""Benchmark decontamination, in DataFrame operations only.

A document is looked at through windows as long as a benchmark item. Items and
windows get a 64-bit SimHash of their weighted word shingles; fingerprints cut
into ``radius + 1`` blocks must agree in a whole block if they differ in at most
``radius`` bits (multi-index Hamming search), so the join on blocks finds every
fingerprint within the radius. Exact weighted-shingle similarity then decides.

Only windows that share a shingle with some item are made: without one the
similarity is zero. They start where that shingle puts the item's first word, one
window for each run of matching shingles, however many items have it there. The join on
blocks holds to that anchor: a window meets the items that have its first matching
shingle at that place, not all items of its length, so what items with a common
beginning cost grows with their number, not with its square.

Shingles are ``width`` lower-cased words, in items with fewer words all of them;
the weight of a shingle is its number of letters. The similarity of a window and
an item is the sum of the smaller weights over the sum of the larger ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.llm import words
from tallyworks.session import pin

#: More different anchors than this are joined by a shuffle instead of a broadcast.
MOST_BROADCAST = 200_000
BITS = 64


def lower_words(text: Column) -> Column:
    return words.words(F.lower(text))


def grams(array: Column, width: Column | int) -> Column:
    """Hashes of all runs of ``width`` words; none if there are fewer words."""
    width = width if isinstance(width, Column) else F.lit(width)
    made = F.transform(
        F.sequence(F.lit(1), F.size(array) - width + 1), lambda i: F.xxhash64(F.slice(array, i, width))
    )
    return F.when(F.size(array) >= width, made).otherwise(F.array().cast("array<bigint>"))


def weighted(array: Column, width: Column) -> Column:
    """The shingles of a window with their weights: array of (h, w), repeated ones repeated."""
    return F.when(
        F.size(array) >= width,
        F.transform(
            F.sequence(F.lit(1), F.size(array) - width + 1),
            lambda i: F.struct(
                F.xxhash64(F.slice(array, i, width)).alias("h"),
                F.length(F.array_join(F.slice(array, i, width), "")).cast("long").alias("w"),
            ),
        ),
    ).otherwise(F.array().cast("array<struct<h:bigint,w:bigint>>"))


def simhash(shingles: Column) -> Column:
    """64 bits: whether the weights of shingles with that bit set reach those without."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(BITS - 1)),
        lambda b: F.aggregate(
            shingles,
            F.lit(0).cast("long"),
            lambda acc, s: acc + F.when(F.getbit(s["h"], b) == 1, s["w"]).otherwise(-s["w"]),
        )
        >= 0,
    )


def blocks(bits: Column, count: int) -> Column:
    """The fingerprint cut into ``count`` blocks, each as a text of its bits."""
    edges = [BITS * k // count for k in range(count + 1)]
    return F.array(
        *(
            F.array_join(F.transform(F.slice(bits, a + 1, b - a), lambda x: x.cast("int").cast("string")), "")
            for a, b in zip(edges, edges[1:])
        )
    )


def distance(a: Column, b: Column) -> Column:
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x != y), lambda x: x))


def overlap(a: Column, b: Column) -> Column:
    """Sum over the different shingles of ``a`` of the smaller of its weights on both sides."""

    def total(side: Column, h: Column) -> Column:
        return F.aggregate(
            side, F.lit(0).cast("long"), lambda acc, s: acc + F.when(s["h"] == h, s["w"]).otherwise(0)
        )

    different = F.array_distinct(F.transform(a, lambda s: s["h"]))
    return F.aggregate(
        different, F.lit(0).cast("long"), lambda acc, h: acc + F.least(total(a, h), total(b, h))
    )


def weight(shingles: Column) -> Column:
    return F.aggregate(shingles, F.lit(0).cast("long"), lambda acc, s: acc + s["w"])


def item_table(benchmark: DataFrame, width: int) -> DataFrame:
    """item_id, its words w, their number n, shingle width k, fingerprint and weighted shingles."""
    items = benchmark.select("item_id", lower_words(words.text_or_empty("text")).alias("w"))
    items = items.where(F.size("w") > 0).withColumn("n", F.size("w"))
    items = items.withColumn("k", F.least(F.lit(width), F.col("n")))
    return items.withColumn("shingles", weighted(F.col("w"), F.col("k")))


#: What a window shares with the items that it is compared with.
ANCHOR = ["n", "k", "q", "h", "before"]


def anchors(items: DataFrame) -> DataFrame:
    """Every shingle h of every item: its place q and the word before it, empty for the first."""
    placed = F.posexplode_outer(grams(F.col("w"), F.col("k"))).alias("q", "h")
    before = F.coalesce(F.get("w", F.col("q") - 1), F.lit("")).alias("before")
    return items.select("*", placed).select("*", before)


def windows(docs: DataFrame, items: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame | None:
    """doc_id, start, the anchor and the words of each window that shares a shingle with an item."""
    keys = anchors(items).select(*ANCHOR).distinct()
    # At most ``width`` shingle widths, nearly always one.
    sizes = sorted(r.k for r in items.select("k").distinct().collect())
    small = keys.count() <= MOST_BROADCAST
    parts = []
    # The outer form of explode: the plain one adds a filter on the array's size, which
    # is moved below and there computed anew for every element.
    texts = docs.select(F.col(id_col).alias("doc_id"), words.text_or_empty(text_col).alias("t"))
    # Where a text is joined back, null and repeated ids are told apart by a hash of the row.
    texts = texts.select("doc_id", lower_words(F.col("t")).alias("d"), F.xxhash64("doc_id", "t").alias("row"))
    for k in sizes:
        of_width = keys.where(F.col("k") == k)
        made = texts.select("doc_id", "row", "d", grams(F.col("d"), k).alias("g"))
        if small:
            found = made.select("doc_id", "d", F.posexplode_outer("g").alias("p", "h")).join(
                F.broadcast(of_width), "h"
            )
        else:
            found = made.select("row", F.posexplode_outer("g").alias("p", "h")).join(of_width, "h")
            found = found.join(texts.dropDuplicates(["row"]), "row").drop("row")
        parts.append(found)
    if not parts:
        return None
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    # A run of matching shingles gives one window: its first match.
    inside = (F.col("q") > 0) & (F.col("p") > 0) & F.get("d", F.col("p") - 1).eqNullSafe(F.col("before"))
    start = F.col("p") - F.col("q")
    return found.where(~inside).select(
        "doc_id",
        start.alias("start"),
        *ANCHOR,
        F.slice("d", F.greatest(start, F.lit(0)) + 1, F.col("n") + F.least(start, F.lit(0))).alias("w"),
    )


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    width: int = 5,
    percent: int = 80,
    radius: int = 20,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document and item found in it: doc_id, item_id, similarity, start, distance.

    Of several windows the most similar counts, of equal ones the first. ``start`` is a
    word position and negative if the text begins inside the item. At the
    similarity of ``percent`` fingerprints differ in 10 bits on average; ``radius`` lies
    more than three standard deviations above.

    Null and empty texts and items hold nothing; repeated rows give one row, and so do all
    rows without id; further columns are left behind. The different anchors are broadcast
    if there are at most ``MOST_BROADCAST``; beyond that they are joined by a shuffle, with
    the same result.
    """
    items = pin(item_table(benchmark, width))
    views = windows(docs, items, width, id_col, text_col)
    if views is None:
        return docs.sparkSession.createDataFrame(
            [], "doc_id long, item_id long, similarity double, start int, distance int"
        )
    count = radius + 1
    # Few rows are left here; written, no later condition can move below the scan.
    views = pin(views.withColumn("view", F.monotonically_increasing_id()))
    views = views.withColumn("shingles", weighted(F.col("w"), F.col("k")))
    signed = views.select("view", "doc_id", "start", *ANCHOR, "shingles", simhash(F.col("shingles")).alias("bits"))
    signed = pin(signed.withColumn("blocks", blocks(F.col("bits"), count)))
    known = items.select("item_id", "n", "k", "w", F.col("shingles").alias("s"), simhash(F.col("shingles")).alias("b"))
    known = known.withColumn("item_blocks", blocks(F.col("b"), count))
    # Written, so that fingerprints are made once per item, not once per anchor.
    known = pin(known.withColumn("item", F.monotonically_increasing_id()))
    # Only numbers meet on the blocks; each pair once, whatever blocks it meets in.
    ours = signed.select("view", *ANCHOR, F.posexplode_outer("blocks").alias("block", "value"))
    theirs = anchors(known.select("item", "n", "k", "w", "item_blocks")).select(
        "item", *ANCHOR, F.posexplode_outer("item_blocks").alias("block", "value")
    )
    met = ours.join(theirs, [*ANCHOR, "block", "value"]).select("view", "item").distinct()
    pairs = met.join(signed.select("view", "doc_id", "start", "shingles", "bits"), "view")
    pairs = pairs.join(known.select("item", "item_id", "s", "b"), "item")
    pairs = pairs.withColumn("distance", distance(F.col("bits"), F.col("b"))).where(
        F.col("distance") <= radius
    )
    both = overlap(F.col("s"), F.col("shingles"))
    pairs = pairs.select(
        "doc_id",
        "item_id",
        "start",
        "distance",
        both.alias("both"),
        (weight(F.col("s")) + weight(F.col("shingles"))).alias("total"),
    ).where(100 * F.col("both") >= percent * (F.col("total") - F.col("both")))
    similarity = F.col("both") / (F.col("total") - F.col("both"))
    best = F.max(F.struct(similarity.alias("similarity"), (-F.col("start")).alias("back"), (-F.col("distance")).alias("near")))
    return (
        pairs.groupBy("doc_id", "item_id")
        .agg(best.alias("best"))
        .select(
            "doc_id",
            "item_id",
            "best.similarity",
            (-F.col("best.back")).alias("start"),
            (-F.col("best.near")).alias("distance"),
        )
    )

"""N-gram Jaccard join: link classes, or all links, of similar word-shingle sets, by universe partition.

Sets that differ in at most H shingles agree in at least one of H + 1 parts of the
hash universe (pigeonhole). For a similarity of t, sets of r and s shingles differ
in at most H = (1 - t) / (1 + t) * (r + s). Sizes fall into bands, and a band has
one number of parts, somewhat over its largest H + 1; a set also takes part in
the band below if a partner there can be that much smaller.

*Cost-based allocation*: of its filled parts a set needs only the H + 1 that are
cheapest, in an order that is the same for every set (how many sets hold the very
same part, then the part's hash). A part no other set holds costs nothing and
yields no candidate; common passages make parts dear, and these are left out.
*One-deletion neighbourhoods*: a set with fewer than H + 1 filled parts (small sets
only) allows one difference in each part; it indexes each part and the part
without each of its shingles. Two such sets find each other there, and such a set
and another one find each other by a whole part.

Every link is verified on the sets themselves. Sets that are equal count once.
Candidates go from each member of a bucket to its most central members first;
components of these links leave only the pairs of different components to try, so
groups of many near copies are not paired with one another. That gives the classes;
``all_links`` tries every pair of a bucket instead, so its work grows with the number
of links, the square of a group of near copies.

*Hot keys*: a part that very many sets hold is dealt out by the sets, not by the part,
and sets of very many copies are told by a broadcast. Both are the keys above a fixed
share of all rows, so there are fewer than ``HOT`` of them in a table of any size, and
the answer is the same whichever way a key goes. A parity sketch (one
bit for each of ``CELLS`` cells: whether an odd number of shingles falls there) goes
before the sets: sets differ in at least as many shingles as their sketches in bits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.llm import hashing, lean
from tallyworks.llm.components import components
from tallyworks.session import pin

_U = np.uint64
PERCENT = 80
#: Bits of the filter that tells which sets a later pass must send; its size is fixed.
FILTER_WORDS = 1 << 17
#: Words and bits of a parity sketch.
SKETCH = 16
CELLS = 64 * SKETCH
#: The rows that take part.
NAMED = "n > 0 AND doc_id IS NOT NULL"
#: How many central members of a bucket all its members are tried with first.
CENTRES = 1
#: A key with more than one in so many rows is hot, so fewer than this many are.
HOT = 10_000
#: One row in so many tells which parts are hot; it decides nothing else.
SEEN_FOR_HOT = 64


def most_differences(total: np.ndarray | int, percent: int = PERCENT):
    """The most differences between sets of ``total`` shingles together that may link."""
    return (100 - percent) * total // (100 + percent)


def band_of(sizes: np.ndarray) -> np.ndarray:
    """Bands double: band b holds sizes from 2**b to 2**(b+1) - 1."""
    return np.floor(np.log2(np.maximum(sizes, 1))).astype(np.int64)


def parts_of(band: np.ndarray, percent: int) -> np.ndarray:
    """Parts of the universe for a band: an eighth and four more than its largest H + 1."""
    largest = 2 ** (band + 1) - 1
    need = most_differences(largest + largest * 100 // percent, percent) + 1
    return need + need // 8 + 4


class Roles:
    """The partitions a set takes part in: that of its band, and perhaps of the one below."""

    def __init__(self, size: int, percent: int):
        own = int(band_of(np.array([size]))[0])
        self.all = [(own, 0, most_differences(size + size * 100 // percent, percent) + 1)]
        below = 2**own - 1  # the largest size of the band below
        if own and percent * size <= 100 * below:
            self.all.append((own - 1, 1, most_differences(size + below, percent) + 1))


def signatures(own: np.ndarray, band: int, need: int, percent: int) -> tuple[np.ndarray, int, np.ndarray]:
    """Hashes of the filled parts, how many of them may be left out, and deletion keys.

    If there are fewer than ``need`` parts, none may be left out and the deletion
    keys are given; with fewer than half, one key that all such sets share.
    """
    parts = int(parts_of(np.array(band), percent))
    place = ((own >> _U(32)) * _U(parts)) >> _U(32)
    starts = np.concatenate([[0], np.flatnonzero(place[1:] != place[:-1]) + 1])
    values = hashing.mix(own, 7)
    sums = np.add.reduceat(values, starts)
    label = place[starts] * _U(0x2545F4914F6CDD1D) + _U(band + 1)
    whole = hashing.mix(sums + label, 11)
    none = np.empty(0, dtype=_U)
    if len(whole) >= need:
        return whole, len(whole) - need, none
    near = [hashing.mix(sums + label, 13)]
    ends = np.concatenate([starts[1:], [len(own)]])
    for k in range(len(starts)):
        near.append(hashing.mix(sums[k] - values[starts[k] : ends[k]] + label[k], 13))
    if 2 * len(whole) < need:
        near.append(hashing.mix(np.array([band], dtype=_U), 17))
    return whole, 0, np.unique(np.concatenate(near))


def fingerprints(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each whole set."""
    a = np.array([hashing.mix(s, 1).sum(dtype=_U) for s in sets], dtype=_U)
    b = np.array([hashing.mix(s, 2).sum(dtype=_U) for s in sets], dtype=_U)
    return hashing.mix(a, 3), hashing.mix(b, 4)


def sketch(own: np.ndarray) -> np.ndarray:
    """The parity sketch of a set, as ``SKETCH`` words."""
    odd = np.bincount((own & _U(CELLS - 1)).astype(np.int64), minlength=CELLS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _long(values) -> pa.Array:
    return pa.array(np.asarray(values, dtype=_U).view(np.int64))


DESCRIBED = ["doc_id", "n", "f", "g", "spare_own", "spare_below", *(f"s{k}" for k in range(SKETCH))]


SKETCHES = DESCRIBED[-SKETCH:]


def _described(width: int, percent: int) -> Callable:
    """Per document: id, size of its set, its two hashes, and what it may leave out by role."""

    @lean.released
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, sets in hashing.shingle_sets(batch.column(1), width):
                f, g = fingerprints(sets)
                spare = np.zeros((len(sets), 2), dtype=np.int64)
                for k, own in enumerate(sets):
                    if len(own):
                        for band, role, need in Roles(len(own), percent).all:
                            spare[k, role] = signatures(own, band, need, percent)[1]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(row, len(sets)),
                        pa.array([len(s) for s in sets], type=pa.int64()),
                        _long(f),
                        _long(g),
                        pa.array(spare[:, 0]),
                        pa.array(spare[:, 1]),
                        *(pa.array(odd) for odd in np.array([sketch(s) for s in sets]).T.copy()),
                    ],
                    names=DESCRIBED,
                )

    return describe


def _signed(width: int, percent: int) -> Callable:
    """Signature rows of every different set a task meets: (sig, node), the role in node's last bit."""

    @lean.released
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = lean.Recent()
        for batch in batches:
            for _, sets in hashing.shingle_sets(batch.column(1), width):
                f, g = fingerprints(sets)
                sigs, nodes = [], []
                for own, node, new in zip(sets, f.tolist(), seen.new(f, g).tolist()):
                    if not len(own) or not new:
                        continue
                    for band, role, need in Roles(len(own), percent).all:
                        whole, _, near = signatures(own, band, need, percent)
                        both = np.concatenate([whole, near]) if len(near) else whole
                        sigs.append(both)
                        nodes.append(np.full(len(both), (node & ~1) | role, dtype=_U))
                if sigs:
                    yield pa.RecordBatch.from_arrays(
                        [_long(np.concatenate(sigs)), _long(np.concatenate(nodes))], names=["sig", "node"]
                    )

    return sign


def _sent(width: int, bits: np.ndarray) -> Callable:
    """The sets whose hash the filter knows, each once a task: (f, g, shingles)."""

    @lean.released
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = lean.Recent()
        kind = pa.list_(pa.int64())
        for batch in batches:
            for _, sets in hashing.shingle_sets(batch.column(1), width):
                f, g = fingerprints(sets)
                key = f >> _U(1)
                at = (key % _U(FILTER_WORDS * 64)).astype(np.int64)
                known = (bits[at >> 6] >> (at & 63).astype(_U)) & _U(1)
                at = np.array([k for k in np.flatnonzero(known) if len(sets[k])], dtype=np.int64)
                out = at[seen.new(f[at], g[at])].tolist()
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [
                            _long(f[out]),
                            _long(g[out]),
                            pa.array([sets[k].view(np.int64) for k in out], type=kind),
                        ],
                        names=["f", "g", "shingles"],
                    )

    return send


def _filter_bits(nodes: DataFrame) -> np.ndarray:
    """A filter of fixed size over node hashes; 1 MB at the driver however many there are."""
    place = F.pmod(F.col("node"), F.lit(FILTER_WORDS * 64))
    rows = (
        nodes.select(place.alias("p"))
        .groupBy(F.shiftright("p", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("bits"))
        .collect()
    )
    bits = np.zeros(FILTER_WORDS, dtype=np.int64)
    for r in rows:
        bits[r.word] = r.bits
    return bits.view(_U)


def _hot_parts(texts: DataFrame, width: int, percent: int) -> DataFrame:
    """(sig, about): parts that a share of all sets holds, and about how many; fewer than ``HOT``.

    Counted on the rows that a hash picks, so copies are picked one by one.
    """
    picked = texts.where(F.pmod(F.xxhash64(*texts.columns), F.lit(SEEN_FOR_HOT)) == 0)
    signed = picked.mapInArrow(_signed(width, percent), "sig long, node long")
    counted = pin(signed.groupBy("sig").agg(F.count("*").alias("seen")))
    rows = counted.agg(F.coalesce(F.sum("seen"), F.lit(0))).first()[0]
    # Seen twice, a part is shared for certain.
    hot = counted.where((F.col("seen") > 1) & (F.col("seen") * HOT > rows))
    return pin(hot.select("sig", (F.col("seen") * SEEN_FOR_HOT).alias("about")))


def _buckets(texts: DataFrame, described: DataFrame, width: int, percent: int) -> DataFrame:
    """(sig, node, weight): the cheapest parts each set needs, as far as another set holds them too.

    ``weight`` sums over a set's shared parts how many sets hold them: how central it is.
    The order of the parts may be any that is the same for every set, so a hot part goes
    by the number it was estimated at, and its rows need not meet to be counted.
    """
    hot = F.broadcast(_hot_parts(texts, width, percent))
    signed = texts.mapInArrow(_signed(width, percent), "sig long, node long").join(hot, "sig", "left")
    dealt = signed.select("sig", "node", F.when(F.col("about").isNotNull(), F.col("node")).alias("spread"))
    held = F.count("*").over(Window.partitionBy("sig", "spread"))
    counted = dealt.withColumn("held", held).where("held > 1 OR spread IS NOT NULL")
    shared = counted.join(hot, "sig", "left").select("sig", "node", F.coalesce("about", "held").alias("held"))
    spare = described.where("n > 0").groupBy("f").agg(
        F.max("spare_own").alias("own"), F.max("spare_below").alias("below")
    )
    role = F.explode(F.array(F.struct(F.lit(0).alias("r"), "own"), F.struct(F.lit(1).alias("r"), F.col("below").alias("own"))))
    spare = spare.select("f", role.alias("x")).select(
        F.expr("(f & -2L) | x.r").alias("node"), F.col("x.own").alias("spare")
    )
    spare = spare.groupBy("node").agg(F.max("spare").alias("spare"))
    of_node = Window.partitionBy("node")
    ranked = shared.select(
        "sig",
        "node",
        F.row_number().over(of_node.orderBy("held", "sig")).alias("rank"),
        F.count("*").over(of_node).alias("shared"),
        F.sum("held").over(of_node).alias("weight"),
    )
    # Parts nobody shares come first in the order, so of the shared ones a set
    # needs all but as many as it may leave out, the dearest.
    return (
        ranked.join(spare, "node")
        .where("rank <= shared - spare")
        .groupBy("sig", F.expr("shiftright(node, 1)").alias("node"))
        .agg(F.max("weight").alias("weight"))
    )


def _may_link(percent: int) -> Column:
    """Whether sizes and sketches of the sides a and b leave a link possible."""
    a, b = F.col("na"), F.col("nb")
    apart = F.bit_count(F.col("a0").bitwiseXOR(F.col("b0")))
    for k in range(1, SKETCH):
        apart = apart + F.bit_count(F.col(f"a{k}").bitwiseXOR(F.col(f"b{k}")))
    near = 100 * F.least(a, b) >= percent * F.greatest(a, b)
    return near & (apart * (100 + percent) <= (100 - percent) * (a + b))


def _side(sketches: DataFrame, side: str) -> DataFrame:
    """The sketches with column names of one side of a pair."""
    return sketches.select(
        F.col("node").alias(side),
        F.col("n").alias(f"n{side}"),
        *(F.col(f"s{k}").alias(f"{side}{k}") for k in range(SKETCH)),
    )


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sets link, as representatives (a, b) and as nodes (node_a, node_b)."""
    left = sets.select(F.col("node").alias("b"), F.col("rep").alias("rb"), F.col("shingles").alias("sb"))
    right = sets.select(F.col("node").alias("a"), F.col("rep").alias("ra"), F.col("shingles").alias("sa"))
    size = F.size
    joined = pairs.join(left, "b").join(right, "a").where(
        100 * F.least(size("sa"), size("sb")) >= percent * F.greatest(size("sa"), size("sb"))
    )
    common = size(F.array_intersect("sa", "sb"))
    linked = joined.select("ra", "rb", "a", "b", common.alias("i"), (size("sa") + size("sb")).alias("n"))
    return linked.where(100 * F.col("i") >= percent * (F.col("n") - F.col("i"))).select(
        F.col("ra").alias("a"), F.col("rb").alias("b"), F.col("a").alias("node_a"), F.col("b").alias("node_b")
    )


def _verified(
    texts: DataFrame, pairs: DataFrame, reps: DataFrame, width: int, percent: int
) -> tuple[DataFrame, DataFrame]:
    """The pairs that link, as ``_links`` gives them, and the sets they were verified on."""
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    bits = _filter_bits(nodes)
    sent = texts.mapInArrow(_sent(width, bits), "f long, g long, shingles array<long>")
    sets = pin(
        sent.groupBy("f", "g")
        .agg(F.first("shingles").alias("shingles"))
        .join(reps, ["f", "g"])
        .select(F.shiftright("f", 1).alias("node"), "rep", "shingles")
    )
    return pin(_links(pairs, sets, percent)), sets


def _prepared(docs: DataFrame, width: int, percent: int, id_col: str, text_col: str) -> tuple[DataFrame, ...]:
    """The texts, their descriptions, representatives of the different sets, buckets and sketches."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string"))
    described = pin(
        texts.mapInArrow(
            _described(width, percent), ", ".join(f"{name} long" for name in DESCRIBED)
        )
    )
    named = described.where(NAMED)
    reps = named.groupBy("f", "g").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n_copies"))
    buckets = pin(_buckets(texts.where("doc_id IS NOT NULL"), named, width, percent))
    sketches = named.groupBy(F.shiftright("f", 1).alias("node")).agg(
        F.max("n").alias("n"), *(F.max(f"s{k}").alias(f"s{k}") for k in range(SKETCH))
    )
    sketches = pin(sketches.join(buckets.select("node").distinct(), "node", "left_semi"))
    return texts, described, reps, buckets, sketches


def _pairs_in_buckets(held: DataFrame, percent: int, further: Column | None = None) -> DataFrame:
    """Each pair of different nodes that share a bucket and may link, once.

    ``held``: (sig, label, node, n, sketch); ``further`` is a condition on the labels la and lb.
    """
    left = _side(held, "a").columns
    one = held.select("sig", F.col("label").alias("la"), *(held[c].alias(x) for c, x in zip(["node", "n", *SKETCHES], left)))
    right = _side(held, "b").columns
    two = held.select("sig", F.col("label").alias("lb"), *(held[c].alias(x) for c, x in zip(["node", "n", *SKETCHES], right)))
    on = (one["sig"] == two["sig"]) & (F.col("a") < F.col("b")) & _may_link(percent)
    return one.join(two, on if further is None else on & further).select("a", "b").distinct()


def all_links(
    docs: DataFrame, width: int = 5, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Every link between two different sets, once: a and b, the smallest doc_ids that have them, node_a and node_b.

    The nodes are hashes of the sets. Copies of one set are no link. A bucket that
    many sets hold is joined with itself, which AQE may split; a pair meets its
    sketches before its sets.
    """
    texts, _, reps, buckets, sketches = _prepared(docs, width, percent, id_col, text_col)
    held = pin(buckets.select("sig", "node", F.lit(0).alias("label")).join(sketches, "node"))
    return _verified(texts, pin(_pairs_in_buckets(held, percent)), reps, width, percent)[0]


def link_numbers(
    docs: DataFrame, width: int = 5, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_links, how many different sets link with the row's set.

    Unlike ``n_connecting`` of ``similarity_join`` this is the whole number. Rows without
    id or without a word have none.
    """
    texts, described, reps, buckets, sketches = _prepared(docs, width, percent, id_col, text_col)
    held = pin(buckets.select("sig", "node", F.lit(0).alias("label")).join(sketches, "node"))
    links, _ = _verified(texts, pin(_pairs_in_buckets(held, percent)), reps, width, percent)
    ends = links.select(F.col("node_a").alias("node")).union(links.select("node_b"))
    degree = ends.groupBy("node").agg(F.count("*").alias("n_links"))
    told = described.withColumn("node", F.when(F.expr(NAMED), F.shiftright("f", 1)))
    return told.join(degree, "node", "left").select("doc_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))


def similarity_join(
    docs: DataFrame, width: int = 5, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, n_connecting, n_copies.

    ``component_id`` is the smallest doc_id reachable by links, ``n_copies`` how many rows
    have the same set (itself included), ``n_connecting`` how many links of that set to
    other sets were found on the way to the classes; it is not the number of its links,
    which ``link_numbers`` gives. Texts without a word, null ones included,
    link with nothing and are their own component. Rows without id take no part:
    their component is null. Repeated rows are copies; further columns are left
    behind.
    """
    texts, described, reps, buckets, sketches = _prepared(docs, width, percent, id_col, text_col)
    named = described.where(NAMED)
    # The centres are picked per task before the shuffle, and the join may split a large bucket.
    central = F.row_number().over(Window.partitionBy("sig").orderBy(F.desc("weight"), "node"))
    centres = buckets.withColumn("place", central).where(F.col("place") <= CENTRES)
    tried = (
        buckets.select("sig", F.col("node").alias("b"))
        .join(centres.select("sig", F.col("node").alias("a")), "sig")
        .where("a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )
    tried = tried.join(_side(sketches, "a"), "a").join(_side(sketches, "b"), "b").where(_may_link(percent))
    pairs = pin(tried.select("a", "b"))
    star = _verified(texts, pairs, reps, width, percent)[0].select("a", "b")
    labels = components(star)
    # Members of one bucket in different components: the pairs still to try.
    named_nodes = reps.select(F.shiftright("f", 1).alias("node"), "rep")
    of_node = (
        named_nodes.join(sketches, "node")
        .join(labels.withColumnRenamed("node", "rep"), "rep", "left")
        .withColumn("label", F.coalesce("label", "rep"))
        .drop("rep")
    )
    held = buckets.select("sig", "node").join(of_node.select("node", "label"), "node")
    mixed = held.groupBy("sig").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
    held = pin(held.join(mixed.select("sig"), "sig", "left_semi").join(sketches, "node"))
    more = _pairs_in_buckets(held, percent, F.col("la") != F.col("lb"))
    more = pin(more.join(pairs, ["a", "b"], "left_anti"))
    rest, _ = _verified(texts, more, reps, width, percent)
    links = star
    if not rest.isEmpty():
        links = pin(star.unionByName(rest.select("a", "b")).distinct())
        labels = components(links)
    ends = links.select(F.col("a").alias("rep")).union(links.select("b"))
    degree = ends.groupBy("rep").agg(F.count("*").alias("n_connecting"))
    told = pin(
        reps.join(labels.withColumnRenamed("node", "rep"), "rep", "left")
        .join(degree, "rep", "left")
        .select(
            "f", "g", F.coalesce("label", "rep").alias("label"), "n_copies",
            F.coalesce("n_connecting", F.lit(0)).alias("n_connecting"),
        )
    )
    full = _told(named, told).select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("label").alias("component_id"), "n_connecting", "n_copies"
    )
    alone = described.where("n = 0 OR doc_id IS NULL").select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"),
        F.lit(0).cast("long").alias("n_connecting"), F.lit(1).cast("long").alias("n_copies"),
    )
    return full.unionByName(alone)


def _told(named: DataFrame, told: DataFrame) -> DataFrame:
    """Every row with what ``told`` says of its set; rows of sets with very many copies are not shuffled."""
    rows = named.select("doc_id", "n", "f", "g")
    many = F.col("n_copies") * HOT > rows.count()
    hot = F.broadcast(told.where(many))
    rare = rows.join(hot, ["f", "g"], "left_anti").join(told.where(~many), ["f", "g"])
    return rows.join(hot, ["f", "g"]).unionByName(rare)

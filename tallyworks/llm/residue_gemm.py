"""Hard negatives by matrix products in a residue number system.

Vectors become integers, and their inner products are needed exactly: thresholds compare
them, and ties are broken by id. A float32 product of whole components would round. So
the components are reduced modulo several small primes, to residues around zero so small
that a float32 matrix product of them stays below 2 ** 24 and is exact; each prime has one
product, and the signed scores follow from their residues by the Chinese remainder theorem
(mixed radix, in 64-bit integers). Primes are added until their product exceeds twice the
largest score that the components allow.

Anchors meet all rows in tiles: rows are dealt into tiles of about ``TILE_ROWS`` by their
place in the table, anchors into blocks of about ``TILE_ANCHORS``, and every pair of a tile
and a block is one group of a cogroup, whatever the size of the table. A tile gives only the
first few rows of each anchor, which a top-k over the tiles joins together. A first pass
finds the positives; with their scores as windows a second one finds the negatives.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.operators import windows
from tallyworks.session import pin

TILE_ROWS, TILE_ANCHORS = 8192, 4096
#: Anchors whose scores with a tile are in memory at once.
AT_ONCE = 128
#: float32 holds every whole number up to here.
EXACT = 1 << 24
LOWEST = np.iinfo(np.int64).min


def primes_for(dims: int, largest: int) -> list[int]:
    """Odd primes, the largest first, whose residues give exact float32 products over ``dims``
    components and whose product tells all scores of components up to ``largest`` apart."""
    bound = 2 * dims * largest * largest
    half = int((EXACT / max(dims, 1)) ** 0.5)
    primes, product = [], 1
    for p in range(2 * half + 1, 2, -1):
        if product > bound:
            break
        if (p // 2) ** 2 * dims <= EXACT and all(p % q for q in range(2, int(p**0.5) + 1)):
            primes.append(p)
            product *= p
    if product <= bound or bound >= 1 << 55:
        raise ValueError(f"scores of {dims} components up to {largest} do not fit 55 bits")
    return primes


def residues(vectors: np.ndarray, primes: list[int]) -> list[np.ndarray]:
    """The vectors modulo each prime, as float32 around zero."""
    return [((vectors + p // 2) % p - p // 2).astype(np.float32) for p in primes]


def exact_scores(left: list[np.ndarray], right: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Inner products of all rows of ``left`` with all of ``right``, from their residues.

    Mixed radix: the score is d0 + p0 * (d1 + p1 * (d2 + ...)), each digit around zero.
    """
    shape = len(left[0]), len(right[0])
    score, digits = np.zeros(shape, dtype=np.int64), []
    radix = 1
    for k, p in enumerate(primes):
        digit = (left[k] @ right[k].T).astype(np.int64)
        for q, earlier in zip(primes, digits):
            digit = (digit - earlier) % p * pow(q, -1, p)
        digit = (digit + p // 2) % p - p // 2
        digits.append(digit)
        score += digit * radix
        radix *= p
    return score


def first(scores: np.ndarray, eligible: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k highest eligible scores of each row, of ties the leftmost."""
    masked = np.where(eligible, scores, LOWEST)
    width = masked.shape[1]
    if width > k:
        least = np.partition(masked, width - k, axis=1)[:, width - k]
        eligible = eligible & (masked >= least[:, None])
    row, column = np.nonzero(eligible)
    order = np.lexsort((column, -masked[row, column], row))
    row, column = row[order], column[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    return row[place < k], column[place < k]


def _vectors(table: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The rows of each vector length, and their vectors."""
    column = table.column("vector").combine_chunks()
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.values.to_numpy(zero_copy_only=False)
    starts = column.offsets.to_numpy()[:-1]
    for n in np.unique(lengths):
        rows = np.flatnonzero(lengths == n)
        yield rows, flat[starts[rows][:, None] + np.arange(n)]


#: Gets scores (anchors x rows, rows in the order of their ids) and the columns of both sides;
#: gives places of anchors and of rows, with further columns.
Select = Callable[
    [np.ndarray, dict[str, np.ndarray], pa.Table], Iterator[tuple[np.ndarray, np.ndarray, dict]]
]


def score_tiles(
    rows: DataFrame, anchors: DataFrame, sizes: tuple[int, int], largest: int, schema: str, select: Select
) -> DataFrame:
    """What ``select`` finds in the scores of all anchors with all rows, tile by tile.

    ``schema``: anchor_id, id, score, then the columns that ``select`` adds.
    """
    tiles = max(1, -(-sizes[0] // TILE_ROWS))
    blocks = max(1, -(-sizes[1] // TILE_ANCHORS))

    def dealt(df: DataFrame, own: str, parts: int, other: str, copies: int) -> DataFrame:
        # New columns of the old names: both sides may come from one table.
        spread = df.toDF(*df.columns).withColumn(own, F.pmod(F.xxhash64("place"), F.lit(parts)).cast("int"))
        return spread.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))

    names = [part.split()[0] for part in schema.split(", ")]

    def tile(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        found: list[dict] = []
        rows = rows.sort_by("id")
        held = {v.shape[1]: (at, v) for at, v in vectors_of(rows)}
        for at, vectors in vectors_of(anchors):
            dims = vectors.shape[1]
            if dims not in held:
                continue
            primes = primes_for(dims, largest)
            theirs, ours = residues(held[dims][1], primes), residues(vectors, primes)
            columns = {c: rows.column(c).to_numpy()[held[dims][0]] for c in ("id", "label")}
            for low in range(0, len(at), AT_ONCE):
                some = anchors.take(pa.array(at[low : low + AT_ONCE]))
                scores = exact_scores([r[low : low + AT_ONCE] for r in ours], theirs, primes)
                ids = some.column("id").to_numpy()
                for a, r, more in select(scores, columns, some):
                    found.append(dict(anchor_id=ids[a], id=columns["id"][r], score=scores[a, r], **more))
        none = np.empty(0, dtype=np.int64)
        return pa.table({c: np.concatenate([none, *(f[c] for f in found)]) for c in names})

    keys = ("_block", "_tile")
    left = dealt(rows, "_tile", tiles, "_block", blocks).groupBy(*keys)
    right = dealt(anchors, "_block", blocks, "_tile", tiles).groupBy(*keys)
    return left.cogroup(right).applyInArrow(tile, schema)


def vectors_of(table: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length of vector the rows that have it, and their vectors."""
    if not table.num_rows:
        return
    column = table.column("vector").combine_chunks()
    starts = column.offsets.to_numpy()
    lengths, flat = np.diff(starts), column.values.to_numpy()
    for dims in np.unique(lengths):
        at = np.flatnonzero(lengths == dims)
        yield at, flat[starts[at][:, None] + np.arange(dims)]


def hard_negatives(
    df: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    scale: int = 256,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
) -> DataFrame:
    """For each anchor and each of its first ``positives`` rows of the same label, the first
    ``negatives`` rows of another label that score ``low`` to ``high`` percent of that positive.

    Components become floor(scale * x). Scores are inner products; higher ones come first,
    ties by smaller id. Rows with a null id, label or vector, or with a null or non-finite
    component, take no part. Vectors of different lengths have no score. Repeated rows each
    count, but a row with the anchor's own id is neither its positive nor its negative, and
    of anchors that share an id the first by label and vector stands for them. An empty
    table gives no rows; scores beyond 55 bits are an error; further columns are left behind.
    """
    value = F.col("vector")
    wild = F.exists(value, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = pin(
        df.select(
            F.col(id_col).cast("long").alias("id"),
            F.col(label_col).cast("long").alias("label"),
            F.col(vector_col).cast("array<double>").alias("vector"),
            F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
            F.monotonically_increasing_id().alias("place"),
        )
        .where(F.col("id").isNotNull() & F.col("label").isNotNull() & value.isNotNull())
        .where(~wild)
        .withColumn("vector", F.transform(value, lambda x: F.floor(scale * x)))
    )
    size = rows.agg(
        F.count("*").alias("rows"),
        F.count_if("anchor").alias("anchors"),
        F.max(F.array_max("vector")).alias("most"),
        F.min(F.array_min("vector")).alias("least"),
    ).first()
    sizes, largest = (size.rows, size.anchors), max(size.most or 0, -(size.least or 0))
    others = rows.select("id", "label", "vector", "place")
    anchors = windows.top_k(
        rows.where("anchor").drop("anchor"), ["id"], [F.asc("label"), F.asc("vector")], 1, "_first"
    ).drop("_first")

    def alike(scores, held, asked):
        same = asked.column("label").to_numpy()[:, None] == held["label"]
        other = asked.column("id").to_numpy()[:, None] != held["id"]
        yield *first(scores, same & other, positives), {}

    near = score_tiles(others, anchors, sizes, largest, "anchor_id long, id long, score long", alike)
    best = [F.desc("score"), F.asc("id")]
    chosen = windows.top_k(near, ["anchor_id"], best, positives, "place").groupBy("anchor_id").agg(
        F.sort_array(F.collect_list(F.struct("place", "id", "score"))).alias("p")
    )
    windowed = anchors.join(
        chosen.select(F.col("anchor_id").alias("id"), F.col("p.id").alias("p_id"), F.col("p.score").alias("p_score")), "id"
    )

    def between(scores, held, asked):
        differs = asked.column("label").to_numpy()[:, None] != held["label"]
        differs &= asked.column("id").to_numpy()[:, None] != held["id"]
        ids, bounds = (asked.column(c).to_pylist() for c in ("p_id", "p_score"))
        for k in range(positives):
            has = np.flatnonzero([len(p) > k for p in ids])
            at = np.array([bounds[i][k] for i in has], dtype=np.int64)
            floor, top = -(-low * at // 100), high * at // 100
            some = scores[has]
            inside = differs[has] & (some >= floor[:, None]) & (some <= top[:, None])
            a, r = first(some, inside, negatives)
            whose = np.array([ids[i][k] for i in has], dtype=np.int64)
            yield has[a], r, {"place": np.full(len(a), k), "positive_id": whose[a], "positive_score": at[a]}

    schema = "anchor_id long, id long, score long, place long, positive_id long, positive_score long"
    far = score_tiles(others, windowed, sizes, largest, schema, between)
    return windows.top_k(far, ["anchor_id", "place"], best, negatives, "rank").select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"),
    )

"""Token counts: byte-pair merging with a heap and a linked list.

The vocabulary file is the JSON form of a word-end BPE: NFC, white space runs to
one space, lower case, then letters, single digits and symbol runs, each coded
as bytes with a word-end mark on the last symbol. The count of a piece is its
number of byte symbols minus the merges made; no identifier is produced.

A merge is applied to the leftmost pair of the lowest rank, popped from a heap;
neighbours live in two index arrays, so a merge costs O(log n) and a piece of n
symbols O(n log n), whatever its length.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tallyworks.llm import words

PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
# What Python's split takes for white space and the pattern above does not.
SEPARATORS = re.compile("[\x1c-\x1f]")
WORD_END = "</w>"
#: Pieces and white-space-free chunks remembered by one worker; then it starts anew.
REMEMBERED = 500_000
#: Longer ones are not remembered.
LONGEST = 64


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in vocabulary files.

    Visible Latin-1 characters stand for themselves, the other bytes in order
    for the characters from U+0100 on.
    """
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in visible else chr(next(spare)) for b in range(256)]


def merge_count(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """How many merges byte-pair coding makes in these symbols."""
    n = len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        rank = ranks.get((symbols[i], symbols[i + 1]))
        if rank is not None:
            heap.append((rank, i, symbols[i], symbols[i + 1]))
    heapq.heapify(heap)
    merges = 0
    while heap:
        _, i, left, right = heapq.heappop(heap)
        j = after[i]
        # Either half may have been merged since the pair was pushed.
        if symbols[i] != left or j >= n or symbols[j] != right:
            continue
        symbols[i], symbols[j] = left + right, ""
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            rank = ranks.get((symbols[i], symbols[k]))
            if rank is not None:
                heapq.heappush(heap, (rank, i, symbols[i], symbols[k]))
        h = before[i]
        if h >= 0:
            rank = ranks.get((symbols[h], symbols[i]))
            if rank is not None:
                heapq.heappush(heap, (rank, h, symbols[h], symbols[i]))
        merges += 1
    return merges


class Counter:
    """Counts tokens of texts by one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        merges = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
        self.ranks = {(a, b): rank for rank, (a, b) in enumerate(merges)}
        specials = [t["content"] for t in spec["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, specials))) if specials else None
        self.symbols = byte_symbols()
        self.pieces: dict[str, int] = {}
        self.chunks: dict[str, int] = {}

    def piece(self, piece: str) -> int:
        count = self.pieces.get(piece)
        if count is None:
            symbols = [self.symbols[b] for b in piece.encode()]
            symbols[-1] += WORD_END
            count = len(symbols) - merge_count(symbols, self.ranks)
            if len(self.pieces) >= REMEMBERED:
                self.pieces.clear()
            if len(piece) <= LONGEST:
                self.pieces[piece] = count
        return count

    def chunk(self, chunk: str) -> int:
        count = self.piece(chunk) if chunk.isalpha() else sum(map(self.piece, PIECE.findall(chunk)))
        if len(self.chunks) >= REMEMBERED:
            self.chunks.clear()
        if len(chunk) <= LONGEST:
            self.chunks[chunk] = count
        return count

    def plain(self, text: str) -> int:
        """Tokens of a text without special strings."""
        if not text.isascii():
            # Lower-casing here is by character: a final sigma is a sigma.
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        if SEPARATORS.search(text):
            return sum(map(self.piece, PIECE.findall(text)))
        known, total = self.chunks, 0
        for chunk in text.split():
            count = known.get(chunk)
            total += self.chunk(chunk) if count is None else count
        return total

    def text(self, text: str) -> int:
        if self.special is None or "<" not in text:
            return self.plain(text)
        found = len(self.special.findall(text))
        return found + sum(map(self.plain, self.special.split(text))) if found else self.plain(text)


def token_count(text: Column, vocabulary: str) -> Column:
    """Tokens of a text column; null counts as empty. ``vocabulary``: a path on every machine."""

    @F.pandas_udf(LongType())
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = Counter(vocabulary)
        for texts in batches:
            yield pd.Series([counter.text(t or "") for t in texts], dtype="int64")

    return count(text)


def count_tokens(
    docs: DataFrame, vocabulary: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: id, UTF-8 bytes, tokens, whether over ``limit``.

    A null text counts as empty (0 bytes, 0 tokens); repeated rows and null ids
    stay, each with its own row; further columns are left behind. No shuffle.
    """
    text = words.text_or_empty(text_col)
    counted = docs.select(
        F.col(id_col),
        F.octet_length(text).cast("long").alias("n_bytes"),
        token_count(text, vocabulary).alias("n_tokens"),
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)

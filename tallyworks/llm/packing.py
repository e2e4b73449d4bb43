"""Packing documents into fixed windows by the sum-of-squares rule.

A document's tokens plus one end token fill whole windows first; what remains is
one item. An online packer keeps, in an array indexed by fill level, how many
windows are open at that level, and puts each item where the sum of the squared
counts grows least. Each task packs the rows it reads, so nothing is shuffled
and sequence ids carry the task's number. At the end of a task, or when
``max_open`` windows are open, the open windows are poured together: their
pieces are cut freely and fill whole windows, so at most one window per task
stays short.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from tallyworks.llm import lean

# Fixed value: how texts are cut before byte pairs are merged.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
END_OF_TEXT = "<|endoftext|>"

Piece = tuple[object, int, np.ndarray, int]  # document, start, ids, tokens of the document


def encoder(ranks_path: str):
    """Text to ids; the end-of-text string inside a text is its one special id."""
    import tiktoken

    with open(ranks_path, "rb") as file:
        pairs = [line.split() for line in file if line.strip()]
    ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
    coding = tiktoken.Encoding(
        "packing", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={END_OF_TEXT: len(ranks)}
    )
    return lambda text: coding.encode(text, allowed_special="all")


class Packer:
    """Windows of ``capacity`` ids, filled by the sum-of-squares rule."""

    def __init__(self, capacity: int, max_open: int = 4096):
        self.capacity, self.max_open = capacity, max_open
        self.count = np.zeros(capacity + 1, dtype=np.int64)  # open windows by fill level
        self.at: list[list[list[Piece]]] = [[] for _ in range(capacity + 1)]
        self.open = 0

    def level_for(self, size: int) -> int:
        """The level whose window takes an item of this size; 0 stands for a new window."""
        count, top = self.count, self.capacity
        # Growth of the sum of squares, halved, when a window goes from level h to h + size.
        growth = (count[size + 1 : top + 1] - count[1 : top - size + 1] + 1).astype(np.float64)
        if len(growth):
            growth[-1] = 0.5 - count[top - size]  # a full window is counted no longer
            growth[count[1 : top - size + 1] == 0] = np.inf
            best = len(growth) - 1 - int(np.argmin(growth[::-1]))  # of ties the fullest
            if growth[best] <= count[size] + 0.5:
                return best + 1
        return 0

    def add(self, piece: Piece) -> list[list[Piece]]:
        """Places an item shorter than a window; gives the windows that are done."""
        size = len(piece[2])
        level = self.level_for(size)
        if level:
            window = self.at[level].pop()
            self.count[level] -= 1
        else:
            window = []
            self.open += 1
        window.append(piece)
        if level + size == self.capacity:
            self.open -= 1
            return [window]
        self.at[level + size].append(window)
        self.count[level + size] += 1
        return self.pour(last=False) if self.open >= self.max_open else []

    def pour(self, last: bool = True) -> list[list[Piece]]:
        """Pours all open windows together, cutting pieces at window ends."""
        done, window, room = [], [], self.capacity
        for level in range(self.capacity - 1, 0, -1):
            for source in self.at[level]:
                for doc, start, ids, tokens in source:
                    while len(ids):
                        window.append((doc, start, ids[:room], tokens))
                        start, taken, ids = start + room, len(ids[:room]), ids[room:]
                        room -= taken
                        if room == 0:
                            done.append(window)
                            window, room = [], self.capacity
            self.at[level] = []
        self.count[:] = 0
        self.open = 0
        if window and last:
            done.append(window)
        elif window:
            level = self.capacity - room
            self.at[level], self.open = [window], 1
            self.count[level] = 1
        return done


def pack_documents(
    docs: DataFrame,
    ranks_path: str,
    capacity: int = 2048,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: document, start, length, ids, doc_tokens, sequence_id, offset.

    ``ids`` are little-endian unsigned 32-bit numbers. Every id of every row lies in
    exactly one piece; offsets in a sequence have no gap. A null text counts as
    empty and becomes one piece of the end id; repeated rows and null ids are
    packed like any other row; further columns are left behind. ``ranks_path``: a
    path on every machine.
    """
    id_field = docs.schema[id_col]
    schema = StructType(
        [
            StructField("doc_id", id_field.dataType),
            StructField("start", LongType()),
            StructField("length", LongType()),
            StructField("ids", BinaryType()),
            StructField("doc_tokens", LongType()),
            StructField("sequence_id", LongType()),
            StructField("offset", LongType()),
        ]
    )

    @lean.released
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer = encoder(ranks_path), Packer(capacity)
        sequence = (TaskContext.get().partitionId() << 33) - 1
        id_type = pa.null()
        rows: list[list] = [[] for _ in schema]

        def put(window: list[Piece]) -> None:
            nonlocal sequence
            sequence += 1
            offset = 0
            for doc, start, ids, tokens in window:
                values = (doc, start, len(ids), ids.tobytes(), tokens, sequence, offset)
                for column, value in zip(rows, values):
                    column.append(value)
                offset += len(ids)

        def batch() -> pa.RecordBatch:
            types = (id_type, *(pa.int64(),) * 2, pa.binary(), *(pa.int64(),) * 3)
            made = [pa.array(c, type=t) for c, t in zip(rows, types)]
            for column in rows:
                column.clear()
            return pa.RecordBatch.from_arrays(made, names=schema.names)

        for incoming in batches:
            id_type = incoming.schema.field(0).type
            # Texts become Python strings a few at a time.
            parts = lean.sliced(incoming)
            pairs = (zip(p.column(0).to_pylist(), p.column(1).to_pylist()) for p in parts)
            for doc, text in chain.from_iterable(pairs):
                coded = encode(text) if text else []
                coded.append(end_id)
                ids = np.array(coded, dtype="<u4")
                whole = len(ids) - len(ids) % capacity
                for start in range(0, whole, capacity):
                    put([(doc, start, ids[start : start + capacity], len(ids))])
                if whole < len(ids):
                    for window in packer.add((doc, whole, ids[whole:].copy(), len(ids))):
                        put(window)
                if len(rows[0]) >= 1000:
                    yield batch()
        for window in packer.pour():
            put(window)
        if rows[0]:
            yield batch()

    chosen = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    return chosen.mapInArrow(pack, schema)

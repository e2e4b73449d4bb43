"""Byte-level BPE: texts cut at certain boundaries, fragments encoded on their own.

A pair of bytes that occurs inside no token of the vocabulary can never be merged, so
between two such bytes every encoding has a boundary. All texts are cut there first, by
one table of 256 x 256 pairs; what remains are short fragments, about a word each, that
repeat a lot and are encoded independently of each other.

The vocabulary's pattern, which cuts a text into pieces before merging, is applied to each
fragment and must give the pieces of the whole text again, or parts of them that end at
certain boundaries. It reads from left to right and never looks back, but it looks one
character ahead after white space, and an apostrophe begins a piece only in some places.
So no cut is made right after a byte that may end a white-space character, nor before an
apostrophe, nor inside a character. Any other piece is a run of one class of characters
(with one space before it), of which a cut makes two runs of that class.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from tallyworks.llm import words
from tallyworks.llm.bpe_counts import byte_symbols

# Fixed value: how texts are cut before byte pairs are merged.
PIECE = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
WHITE = "\t\n\x0b\x0c\r \x85\xa0 " + "".join(map(chr, range(0x2000, 0x200B))) + "    　"
#: A byte of no UTF-8 text, put where a text is cut.
MARK = 0xFF
#: Fragments remembered by one worker; then it starts anew. Longer ones are not remembered.
REMEMBERED = 400_000
LONGEST = 48
#: Pieces of fewer bytes are merged by trying all their pairs each time, without a heap.
SHORT = 24
#: Above every rank.
NEVER = 1 << 63
#: An id in the encoded form: little-endian, unsigned, 32 bits.
ID = np.dtype("<u4")


class Codec(dict):
    """Ids of fragments by one vocabulary file; a fragment not seen before is encoded."""

    def __init__(self, path: str):
        super().__init__()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        byte_of = {symbol: byte for byte, symbol in enumerate(byte_symbols())}
        vocabulary = spec["model"]["vocab"]
        spelled = {token: bytes(byte_of[c] for c in token) for token in vocabulary}
        self.specials = {t["content"].encode(): t["id"] for t in spec["added_tokens"]}
        self.special = re.compile(b"|".join(map(re.escape, self.specials))) if self.specials else None
        self.tokens = [b""] * (1 + max([*vocabulary.values(), *self.specials.values()]))
        for token, number in vocabulary.items():
            self.tokens[number] = spelled[token]
        for content, number in self.specials.items():
            self.tokens[number] = content
        self.byte_ids = [vocabulary[symbol] for symbol in byte_symbols()]
        # For each pair that merges: its rank in the upper bits, the id it becomes in the lower 32.
        self.ranks: dict[tuple[int, int], int] = {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            self.ranks[vocabulary[left], vocabulary[right]] = rank << 32 | vocabulary[left + right]
        self.certain = self._certain(spelled.values())

    @staticmethod
    def _certain(tokens) -> np.ndarray:
        """Whether a cut is made between two bytes, at 256 times the first plus the second."""
        cut = np.ones((256, 256), dtype=bool)
        for token in tokens:
            for a, b in zip(token, token[1:]):
                cut[a, b] = False
        cut[:, 0x80:0xC0] = False  # inside a character
        cut[:, ord("'")] = False
        cut[[c.encode()[-1] for c in WHITE]] = False
        return cut.ravel()

    def __missing__(self, fragment: bytes) -> bytes:
        if fragment.isalpha() or fragment[:1] == b" " and fragment[1:].isalpha():
            ids = self.merged(fragment)  # ASCII letters are one piece
        else:
            ids = []
            for piece in PIECE.findall(fragment.decode("utf-8", "replace")):
                ids += self.merged(piece.encode())
        coded = np.array(ids, dtype=ID).tobytes()
        if len(fragment) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.clear()
            self[fragment] = coded
        return coded

    def merged(self, piece: bytes) -> list[int]:
        """Ids of a piece: of all adjacent pairs the one of lowest rank is merged, leftmost first."""
        ids = [self.byte_ids[b] for b in piece]
        return self._merged_short(ids) if len(ids) < SHORT else self._merged_long(ids)

    def _merged_short(self, ids: list[int]) -> list[int]:
        def rank(pair: tuple[int, int]) -> int:
            return ranks.get(pair, NEVER)

        ranks = self.ranks
        order = [rank(pair) for pair in zip(ids, ids[1:])]
        while order and (best := min(order)) < NEVER:
            i = order.index(best)
            ids[i : i + 2] = [best & 0xFFFFFFFF]
            del order[i]
            if i:
                order[i - 1] = rank((ids[i - 1], ids[i]))
            if i < len(order):
                order[i] = rank((ids[i], ids[i + 1]))
        return ids

    def _merged_long(self, ids: list[int | None]) -> list[int]:
        n, ranks = len(ids), self.ranks
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pairs = enumerate(zip(ids, ids[1:]))
        waiting = [(ranks[pair], i, pair) for i, pair in pairs if pair in ranks]
        heapq.heapify(waiting)
        while waiting:
            best, i, pair = heapq.heappop(waiting)
            j = after[i]
            if j >= n or (ids[i], ids[j]) != pair:
                continue  # one of the two has been merged since
            ids[i], ids[j] = best & 0xFFFFFFFF, None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
            for left, right in ((before[i], i), (i, k)):
                if left >= 0 and right < n and (pair := (ids[left], ids[right])) in ranks:
                    heapq.heappush(waiting, (ranks[pair], left, pair))
        return [i for i in ids if i is not None]

    def fragments(self, text: bytes) -> list[bytes]:
        """The text, cut at every certain boundary."""
        data = np.frombuffer(text, dtype=np.uint8)
        pairs = data[:-1].astype(np.uint16)
        pairs <<= 8
        pairs |= data[1:]
        cuts = np.flatnonzero(self.certain[pairs])
        return np.insert(data, cuts + 1, MARK).tobytes().split(bytes([MARK]))

    def plain(self, text: bytes) -> bytes:
        """Ids of a text without special strings."""
        return b"".join(map(self.__getitem__, self.fragments(text))) if text else b""

    def encode(self, text: bytes) -> bytes:
        """Ids of a text; a special string inside it is its one id."""
        if self.special is None or not (found := self.special.findall(text)):
            return self.plain(text)
        parts = map(self.plain, self.special.split(text))
        marks = [*(np.array([self.specials[f]], dtype=ID).tobytes() for f in found), b""]
        return b"".join(part + mark for part, mark in zip(parts, marks))

    def decode(self, ids: bytes) -> str:
        """The text of these ids; unknown ids are left out, bytes that are no text replaced."""
        numbers = np.frombuffer(ids, dtype=ID)
        known = numbers[numbers < len(self.tokens)].tolist()
        return b"".join(map(self.tokens.__getitem__, known)).decode("utf-8", "replace")


@functools.lru_cache(maxsize=1)
def codec(path: str) -> Codec:
    """The codec of this worker, which keeps what it remembers from task to task."""
    return Codec(path)


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 250) -> Iterator[pa.RecordBatch]:
    """The batches a few rows at a time, which bounds what is in memory beside them."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def encode_documents(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, ``n_tokens``, ``ids``, and ``decoded`` from the ids.

    ``ids`` are little-endian unsigned 32-bit numbers. ``vocabulary``: the JSON file of a
    byte-level BPE, at a path on every machine. A null or empty text has no ids and the empty
    text; repeated rows and null ids stay, each with its own row; further columns are left
    behind. No shuffle. A text of n bytes takes O(n log n), also if it is one fragment.
    """
    id_type = docs.schema[id_col].dataType
    schema = StructType(
        [
            StructField("doc_id", id_type),
            StructField("n_tokens", LongType()),
            StructField("ids", BinaryType()),
            StructField("decoded", StringType()),
        ]
    )

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(vocabulary)
        for some in sliced(batches):
            ids = [coder.encode(text.as_py()) for text in some.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    some.column(0),
                    pa.array([len(i) // ID.itemsize for i in ids], type=pa.int64()),
                    pa.array(ids, type=pa.binary()),
                    pa.array(map(coder.decode, ids), type=pa.string()),
                ],
                names=schema.names,
            )

    text = words.text_or_empty(text_col).cast("binary")
    return docs.select(F.col(id_col), text.alias("text")).mapInArrow(code, schema)


def decode_documents(
    coded: DataFrame, vocabulary: str, id_col: str = "doc_id", ids_col: str = "ids"
) -> DataFrame:
    """doc_id and ``text`` of every row of encoded documents, as ``encode_documents`` gives them.

    Null ids give the empty text; special ids are spelled out, unknown ones left out.
    """
    schema = StructType([StructField("doc_id", coded.schema[id_col].dataType), StructField("text", StringType())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(vocabulary)
        for some in sliced(batches):
            texts = [coder.decode(ids.as_py() or b"") for ids in some.column(1)]
            yield pa.RecordBatch.from_arrays([some.column(0), pa.array(texts, type=pa.string())], names=schema.names)

    return coded.select(id_col, ids_col).mapInArrow(read, schema)

"""Vectorised hashes of words and word shingles over the bytes of many texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from tallyworks.llm import lean

_U = np.uint64
#: Texts hashed together; bounds the working arrays unless one text alone is larger.
CHUNK_BYTES = 1 << 20

_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTES = _rng.integers(0, 2**64, 256, dtype=_U)
_BYTES[ord("A") : ord("Z") + 1] = _BYTES[ord("a") : ord("z") + 1]  # A-Z count as a-z
_PLACES = _rng.integers(0, 2**64, 8, dtype=_U) | _U(1)
_LENGTHS = _rng.integers(0, 2**64, 8, dtype=_U)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, *range(9, 14)]] = True
_BASE, _MASK = 0x9E3779B97F4A7C15 | 1, 2**64 - 1


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """Spreads 64-bit values: every input bit reaches every output bit."""
    x = x + _U((0x9E3779B97F4A7C15 * (salt + 1)) & _MASK)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Powers:
    """Powers of the base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self):
        self.forget()

    def forget(self) -> None:
        self.up = self.down = np.ones(1, dtype=_U)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = max(n, 2 * len(self.up))
            self.up = self._made(_BASE, size)
            self.down = self._made(pow(_BASE, -1, 2**64), size)
        return self.up, self.down

    @staticmethod
    def _made(base: int, size: int) -> np.ndarray:
        steps = np.full(size, base & _MASK, dtype=_U)
        steps[0] = 1
        return np.cumprod(steps, dtype=_U)


_powers = Powers()
# They fill 16 bytes for each byte of the longest run; workers live on after their last use.
lean.at_release(_powers.forget)


def word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and the number of words of each text.

    ``data``: the bytes of the texts in a row, ``bounds``: where each begins, and the end.
    """
    n = len(data)
    if n == 0:
        return np.empty(0, dtype=_U), np.zeros(len(bounds) - 1, dtype=np.int64)
    filled = ~_SPACE[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[bounds] = True
    first = filled.copy()
    first[1:] &= ~filled[:-1] | edge[1:n]
    last = filled.copy()
    last[:-1] &= ~filled[1:] | edge[1:n]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last)
    up, down = _powers.get(n)
    sums = np.cumsum(_BYTES[data] * up[:n], dtype=_U)
    before = np.where(starts > 0, sums[starts - 1], _U(0))
    hashes = mix((sums[ends] - before) * down[starts] + (ends - starts).astype(_U))
    counts = np.searchsorted(starts, bounds[1:]) - np.searchsorted(starts, bounds[:-1])
    return hashes, counts


def shingles(hashes: np.ndarray, counts: np.ndarray, width: int = 5) -> list[np.ndarray]:
    """The distinct shingle hashes of each text, sorted; a short text is one shingle."""
    total = len(hashes)
    if total >= width:
        joined = np.zeros(total - width + 1, dtype=_U)
        for k in range(width):
            joined += hashes[k : total - width + 1 + k] * _PLACES[k]
        joined = mix(joined)
    sets, at = [], 0
    for n in counts.tolist():
        if n >= width:
            sets.append(np.unique(joined[at : at + n - width + 1]))
        elif n:
            whole = (hashes[at : at + n] * _PLACES[:n]).sum(keepdims=True, dtype=_U) + _LENGTHS[n : n + 1]
            sets.append(mix(whole))
        else:
            sets.append(np.empty(0, dtype=_U))
        at += n
    return sets


def texts_of(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, bounds) of runs of texts of about ``CHUNK_BYTES``; null is empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
    row = 0
    while row < len(column):
        end = int(np.searchsorted(offsets, offsets[row] + CHUNK_BYTES, side="right")) - 1
        end = min(max(end, row + 1), len(column))
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def shingle_sets(column: pa.Array, width: int = 5) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, sets) for runs of rows of a text column."""
    for row, _, data, bounds in texts_of(column):
        yield row, shingles(*word_hashes(data, bounds), width)

"""Bounded memory in Python workers, which live on from stage to stage."""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable, Iterator
from typing import TypeVar

import numpy as np
import pyarrow as pa

T = TypeVar("T")
#: Rows that become Python objects at once.
ROWS = 250


def sliced(batch: pa.RecordBatch | pa.Array, rows: int = ROWS) -> Iterator:
    """A batch or array a few rows at a time, without a copy."""
    for at in range(0, len(batch), rows):
        yield batch.slice(at, rows)


#: What modules remember from task to task and forget when one ends.
_FORGET: list[Callable[[], None]] = []


def at_release(forget: Callable[[], None]) -> None:
    """``forget`` is called whenever a task of this worker ends."""
    _FORGET.append(forget)


def release() -> None:
    """Gives back what this worker has freed, so that the next stage finds it free."""
    for forget in _FORGET:
        forget()
    gc.collect()
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):  # glibc only
        libc.malloc_trim(0)


def released(work: Callable[[Iterator[T]], Iterator[T]]) -> Callable[[Iterator[T]], Iterator[T]]:
    """A function over the batches of a task, after which the worker gives its memory back."""

    @functools.wraps(work)
    def run(batches: Iterator[T]) -> Iterator[T]:
        try:
            yield from work(batches)
        finally:
            release()

    return run


class Recent:
    """Remembers 64-bit keys in an array of fixed size; a key may be forgotten, never invented."""

    def __init__(self, bits: int = 17):
        self.keys = np.zeros((1 << bits, 2), dtype=np.uint64)
        self.mask = np.uint64((1 << bits) - 1)

    def new(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Which of these pairs of hashes are not remembered, one after the other; they are from now on."""
        place = ((first ^ (first >> np.uint64(32))) & self.mask).astype(np.int64)
        fresh = np.ones(len(first), dtype=bool)
        for k, at in enumerate(place.tolist()):
            held = self.keys[at]
            if held[0] == first[k] and held[1] == second[k]:
                fresh[k] = False
            else:
                held[0], held[1] = first[k], second[k]
        return fresh

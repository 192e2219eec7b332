"""Helpers for Arrow batches inside tasks."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that a task works on at once; a longer text is worked on alone.
GROUP_BYTES = 1 << 20


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the row borders in them; NULL is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def groups(at: np.ndarray, limit: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes each."""
    lo, n = 0, len(at) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + limit, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def text_groups(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of about ``GROUP_BYTES`` each; NULL is empty."""
    _, at = utf8(column)
    for lo, hi in groups(at):
        yield lo, [t or "" for t in column.slice(lo, hi - lo).to_pylist()]


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


_HELD: dict = {}


def held(key, make: Callable):
    """The worker's own ``make()`` for ``key``. What it held for another key is let go: a
    worker that goes from job to job remembers the words of one at a time."""
    if key not in _HELD:
        let_go()
        _HELD[key] = make()
    return _HELD[key]


def let_go() -> None:
    """Free what the worker holds for another job."""
    if _HELD:
        _HELD.clear()
        release()


def release() -> None:
    """Give memory that is free inside the worker back to the machine."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)


def tidy(task: Callable) -> Callable:
    """A function over Arrow batches that gives free memory back when its task ends."""

    @wraps(task)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from task(batches)
        release()

    return run


class Recent:
    """What a worker remembers of the words it has seen: at most ``limit`` of the latest
    and as many of those before them, so frequent ones stay."""

    def __init__(self, limit: int):
        self.limit, self.old, self.new = limit, {}, {}

    def missing(self, keys: set[str]) -> list[str]:
        """The keys to be put into ``new``; all others are in there."""
        if len(self.new) + len(keys) > self.limit:
            self.old, self.new = self.new, {}
        fresh = keys.difference(self.new)
        known = self.old.keys() & fresh
        self.new.update(zip(known, map(self.old.__getitem__, known), strict=True))
        return list(fresh - known)

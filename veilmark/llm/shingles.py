"""Hashed word shingles of texts, in numpy.

A word is a run of bytes other than space and 0x09-0x0D, with A-Z in lower case. A
shingle is ``width`` words in a row; a text of fewer words has its whole sequence as one.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa

from veilmark.llm.arrow import utf8

#: Bytes hashed at once; longer words are hashed at one go.
WINDOW = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint64)
_SPACE = np.array([b == 32 or 9 <= b <= 13 for b in range(256)])


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    inverse = pow(int(_BASE), -1, 1 << 64)
    out = []
    for base in (int(_BASE), inverse):
        p = np.ones(n, np.uint64)
        p[1:] = base
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the words at these places of ``data``, with A-Z in lower case."""
    out = np.empty(len(starts), np.uint64)
    lo = 0
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + WINDOW, "right")))
        first, last = starts[lo], ends[hi - 1]
        size = max(WINDOW, 1 << int(last - first).bit_length())
        power, inverse = _powers(size)
        total = np.zeros(last - first + 1, np.uint64)
        np.cumsum((_LOWER[data[first:last]] + np.uint64(1)) * power[: last - first], out=total[1:])
        s, e = starts[lo:hi] - first, ends[lo:hi] - first
        out[lo:hi] = mix((total[e] - total[s]) * inverse[s] + (e - s).astype(np.uint64))
        lo = hi
    return out


def runs(inside: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes that are ``inside`` words; rows end at ``at``."""
    edge = np.zeros(len(inside) + 1, bool)
    edge[at] = True
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    before = np.append(True, ~inside[:-1]) | edge[:-1]
    after = np.append(~inside[1:], True) | edge[1:]
    return np.flatnonzero(inside & before), np.flatnonzero(inside & after) + 1


def words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a string column, and the row borders in them."""
    data, at = utf8(column)
    starts, ends = runs(~_SPACE[data], at)
    return hashes(data, starts, ends), np.searchsorted(starts, at)


def sets(column: pa.Array, width: int) -> list[np.ndarray]:
    """The distinct shingles of each row, in order of their hash."""
    word, at = words(column)
    n = max(len(word) - width + 1, 0)
    rolled = np.zeros(n, np.uint64)
    factors = [mix(np.array([k + 1], np.uint64))[0] | np.uint64(1) for k in range(width)]
    for k in range(width):
        rolled += word[k : k + n] * factors[k]
    rolled = mix(rolled)
    out = []
    for lo, hi in zip(at[:-1], at[1:], strict=True):
        if hi - lo >= width:
            out.append(np.unique(rolled[lo : hi - width + 1]))
        elif hi > lo:
            few = word[lo:hi]
            total = sum(int(w) * int(f) for w, f in zip(few, factors, strict=False)) + len(few)
            out.append(mix(np.array([total % (1 << 64)], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out

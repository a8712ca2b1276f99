"""Word shingles of whole texts as 64-bit hashes, computed for a batch of texts at once.

Words are runs of bytes other than ASCII white space, A-Z lower-cased. A shingle is five words in a
row; a shorter text is one shingle. A word's hash is a polynomial over its bytes, taken from
running sums, so no text is cut into Python strings.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from riskweave.llm.chunks import SPACE
from riskweave.llm.common import byte_view

WIDTH = 5
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
SOURCE = np.random.default_rng(20_240_601)
BYTES = SOURCE.integers(1, 1 << 63, 256, np.uint64)
BYTES[65:91] = BYTES[97:123]
PLACES = SOURCE.integers(1, 1 << 63, WIDTH, np.uint64) | np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every bit over the whole number."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets of each text's words, hash of every word)."""
    bounds, data = byte_view(column)
    word = ~SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    begins = word.copy()
    begins[1:] &= ~word[:-1] | edge[1:-1]
    ends = word.copy()
    ends[:-1] &= ~word[1:] | edge[1:-1]
    begins, ends = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTES[data] * powers(BASE, len(data)), out=sums[1:])
    hashes = (sums[ends] - sums[begins]) * powers(INVERSE, len(data))[begins]
    return np.searchsorted(begins, bounds), mixed(hashes + (ends - begins).astype(np.uint64))


def shingle_sets(column: pa.Array) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    offsets, hashes = words(column)
    rows = np.zeros(max(len(hashes) - WIDTH + 1, 0), np.uint64)
    for k in range(WIDTH):
        rows += hashes[k : k + len(rows)] * PLACES[k]
    rows = mixed(rows)
    out = []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        if b - a >= WIDTH:
            out.append(np.unique(rows[a : b - WIDTH + 1]))
        elif b > a:
            short = (hashes[a:b] * PLACES[: b - a]).sum(dtype=np.uint64)
            out.append(mixed(np.array([short + np.uint64(b - a)])))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum()) if len(b) else 0

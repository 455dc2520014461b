"""Word shingles of whole texts as sets of 64-bit hashes, an Arrow batch at a time.

Words are runs of bytes other than ASCII white space, with A-Z lower-cased. A word's hash is a
polynomial in its bytes, taken from one running sum over the batch, so no text is cut into Python
objects. Equal shingles have equal hashes on every machine; unequal ones agree with a chance of 2^-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from dimflow.llm.common import slices, text_buffer

_BASE = 0x9E3779B97F4A7C15
_ODD = np.random.default_rng(20).integers(1, 1 << 62, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers: tuple[np.ndarray, np.ndarray] = (np.ones(0, np.uint64), np.ones(0, np.uint64))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    global _powers
    if len(_powers[0]) < n:
        inverse = pow(_BASE, -1, 1 << 64)
        tables = []
        for factor in (_BASE, inverse):
            factors = np.full(n, factor, np.uint64)
            factors[0] = 1
            tables.append(np.cumprod(factors, dtype=np.uint64))
        _powers = (tables[0], tables[1])
    return _powers


def word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of consecutive texts, and where each text's words begin among them."""
    data, bounds = _LOWER[data[bounds[0] : bounds[-1]]], bounds - bounds[0]
    n = len(data)
    if not n:
        return np.empty(0, np.uint64), np.zeros(len(bounds), np.int64)
    up, down = _power_tables(n + 1)
    space = _SPACE[data]
    before, after = np.ones(n, bool), np.ones(n, bool)
    before[1:], after[:-1] = space[:-1], space[1:]
    inner = bounds[(bounds > 0) & (bounds < n)]
    before[inner], after[inner - 1] = True, True
    starts, ends = np.flatnonzero(~space & before), np.flatnonzero(~space & after) + 1
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:])
    hashes = (total[ends] - total[starts]) * down[starts]
    return mix(hashes + (ends - starts).astype(np.uint64) * _ODD[0]), np.searchsorted(starts, bounds)


def shingle_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its shingles of ``size`` words.

    A text of fewer words has its whole sequence as its only shingle; one without words, or null, has
    the empty set.
    """
    if not 1 <= size < len(_ODD) - 1:
        raise ValueError(f"a shingle has 1 to {len(_ODD) - 2} words")
    data, bounds = text_buffer(texts)
    for at, end in slices(np.diff(bounds)):
        hashes, first = word_hashes(data, bounds[at : end + 1])
        rolled = np.zeros(max(0, len(hashes) - size + 1), np.uint64)
        for j in range(size):
            rolled += hashes[j : len(hashes) - size + 1 + j] * _ODD[j + 1]
        rolled = mix(rolled)
        for i in range(end - at):
            a, b = first[i], first[i + 1]
            if b - a >= size:
                yield np.unique(rolled[a : b - size + 1])
            else:
                short = hashes[a:b] * _ODD[1 : b - a + 1]
                yield mix(short.sum(dtype=np.uint64, keepdims=True) + np.uint64(b - a)) if b > a else short

"""Canonical length-limited Huffman codes for token ids, coded and decoded with numpy.

A block is coded by itself: bits are packed from the high end of 32-bit words, and every ``EVERY`` ids the bit
offset is kept. Decoding starts at all these checkpoints at once; one table lookup of ``limit`` bits gives an
id and its length.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

EVERY = 64
LIMIT = 18


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """The lengths of a best prefix code of at most ``limit`` bits; 0 for symbols that never occur.

    Package-merge: in each of ``limit`` rounds the cheapest pairs of the round before become packages beside
    the single symbols; going back from the cheapest 2n - 2 entries, each symbol gets a bit per round it is in.
    """
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} symbols do not fit codes of {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    weights = counts[order].astype(np.float64)
    row, singles = weights, [np.ones(len(weights), bool)]
    for _ in range(limit - 1):
        pairs = row[: len(row) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([weights, pairs])
        at = np.argsort(both, kind="stable")
        row = both[at]
        singles.append(at < len(weights))
    take, depth = 2 * len(weights) - 2, np.zeros(len(weights), np.int64)
    for single in reversed(singles):
        own = int(single[:take].sum())
        depth[:own] += 1
        take = 2 * (take - own)
    lengths[order] = depth
    return lengths


@dataclass(frozen=True)
class Code:
    """Codes by id, and ids by the next ``limit`` bits, all from the lengths alone."""

    lengths: np.ndarray
    codes: np.ndarray
    limit: int
    symbol_of: np.ndarray
    length_of: np.ndarray

    @classmethod
    def of(cls, lengths: np.ndarray) -> Code:
        used = np.flatnonzero(lengths)
        limit = int(lengths.max(initial=0)) or 1
        order = used[np.lexsort((used, lengths[used]))]
        spans = np.left_shift(np.uint64(1), (limit - lengths[order].astype(np.int64)).astype(np.uint64))
        firsts = np.concatenate([[0], np.cumsum(spans, dtype=np.uint64)[:-1]]).astype(np.uint64) if len(order) else spans
        codes = np.zeros(len(lengths), np.uint64)
        codes[order] = firsts >> (limit - lengths[order].astype(np.int64)).astype(np.uint64)
        symbol_of, length_of = np.zeros(1 << limit, np.uint32), np.ones(1 << limit, np.uint8)
        symbol_of[: int(spans.sum())] = np.repeat(order.astype(np.uint32), spans.astype(np.int64))
        length_of[: int(spans.sum())] = np.repeat(lengths[order], spans.astype(np.int64))
        return cls(lengths, codes, limit, symbol_of, length_of)

    def encode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The words of a block (32 bits each) and the bit offsets of its checkpoints."""
        lengths = self.lengths[ids].astype(np.int64)
        if len(ids) and not lengths.all():
            raise ValueError("an id without a code")
        ends = np.cumsum(lengths)
        starts = ends - lengths
        total = int(ends[-1]) if len(ends) else 0
        at, inside = starts >> 5, starts & 31
        wide = self.codes[ids] << (64 - lengths - inside).astype(np.uint64)
        n = (total + 31) // 32 + 1
        # Bits of different codes never meet, so sums are unions, and exact below 2^53.
        words = np.bincount(at, (wide >> np.uint64(32)).astype(np.float64), n)
        words += np.bincount(at + 1, (wide & np.uint64(0xFFFFFFFF)).astype(np.float64), n + 1)[:n]
        return words.astype("<u4"), starts[::EVERY].astype("<u4")

    def decode(self, words: np.ndarray, checkpoints: np.ndarray, n_ids: int) -> np.ndarray:
        """The ids of a block, all stretches between checkpoints at the same time."""
        words = np.concatenate([words, np.zeros(2, "<u4")]).astype(np.uint64)
        pairs = words[:-1] << np.uint64(32) | words[1:]
        at, last = checkpoints.astype(np.int64), len(pairs) - 1
        out = np.empty((len(checkpoints), EVERY), np.uint32)
        shift = np.uint64(64 - self.limit)
        for step in range(EVERY):
            peek = (pairs[np.minimum(at >> 5, last)] << (at & 31).astype(np.uint64)) >> shift
            out[:, step] = self.symbol_of[peek]
            at = at + self.length_of[peek]
        return out.reshape(-1)[:n_ids]

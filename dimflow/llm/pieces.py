"""Cutting texts where a tokenizer may be run on the parts, and remembering what the parts gave.

Byte-level BPE patterns never let a token reach from a character that is no white space into white space
after it: all their branches take white space either alone or as one space before something else, and they
look ahead at white space only. So a text may be cut before every blank, tab or line break whose
predecessor is no white space, and its tokens are those of the parts in order. Parts are mostly single words,
which repeat, so each is encoded once and looked up afterwards; long texts never reach the tokenizer whole.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from itertools import filterfalse
from typing import Generic, TypeVar

import numpy as np

Value = TypeVar("Value")

_CUT = re.compile(r"(?<=\S)(?=[ \t\n\r])")
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True
_SECOND_LAST = np.zeros(256, bool)  # of the UTF-8 form of any white space beyond ASCII
_SECOND_LAST[[0xC2, 0x9A, 0x80, 0x81]] = True


class Memo(Generic[Value]):
    """Values by piece, made in batches. It starts anew when its keys hold more than ``most`` bytes."""

    def __init__(self, make: Callable[[list[bytes]], Iterable[Value]], most: int = 24 << 20) -> None:
        self.make, self.most, self.known, self.held = make, most, {}, 0

    def learn(self, pieces: Iterable[bytes]) -> None:
        """Make sure that all ``pieces`` are known; those of one call stay known until the next."""
        if self.held > self.most:
            self.known.clear()
            self.held = 0
        fresh = list(set(filterfalse(self.known.__contains__, pieces)))
        if fresh:
            self.known.update(zip(fresh, self.make(fresh)))
            self.held += sum(map(len, fresh)) + 24 * len(fresh)


def uneven_blanks(data: np.ndarray, byte: int = 32) -> np.ndarray:
    """Places of blanks, or of another byte, that may follow white space."""
    at = np.flatnonzero(data == byte)
    at = at[at > 0]
    before = data[at - 1]
    return at[_BLANK[before] | ((before >= 128) & _SECOND_LAST[data[at - 2]])]


def spaced_pieces(data: np.ndarray, bounds: np.ndarray) -> Iterable[tuple[list[bytes], list[bytes]]]:
    """For each text the pieces as they are, and after them the pieces given without the blank before them."""
    odd = uneven_blanks(data[bounds[0] : bounds[-1]]) + bounds[0]
    counts = np.searchsorted(odd, bounds)
    for i in range(len(bounds) - 1):
        text = data[bounds[i] : bounds[i + 1]].tobytes()
        if counts[i + 1] > counts[i]:
            yield [p.encode() for p in _CUT.split(text.decode())], []
        else:
            head, *rest = text.split(b" ")
            yield [head], rest

"""Words of many documents at once, as numpy arrays of 64-bit hashes.

A word is a run of bytes other than space and the controls 0x09 to 0x0D. Hashes are polynomials modulo
2**64 over random values of the bytes (of words: over their hashes), mixed at the end. The value of any
stretch follows from two prefix sums, so n-grams of every length cost the same.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np

from tallybook.llm.scratch import SLICE_BYTES

_U = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Spaces, controls and ASCII punctuation part plain words.
PUNCTUATION = np.array([b < 0x80 and not chr(b).isalnum() for b in range(256)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_BYTE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
#: Powers that a worker keeps; longer sequences make theirs anew.
_KEPT = 1 << 20


def mix(h: np.ndarray, salt: int = 0) -> np.ndarray:
    """A well mixed copy of 64-bit values; another salt gives an independent one."""
    h = h ^ _U(salt * 0xD6E8FEB86659FD93 % 2**64)
    h = (h ^ (h >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> _U(33))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    made = []
    for base in (_BASE, _INVERSE):
        steps = np.full(n, base, np.uint64)
        steps[:1] = 1
        made.append(np.cumprod(steps, out=steps))
    return made[0], made[1]


@lru_cache(maxsize=1)
def _kept() -> tuple[np.ndarray, np.ndarray]:
    return _powers(_KEPT)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse; 16 MB of them are kept."""
    up, down = _kept() if n <= _KEPT else _powers(n)
    return up[:n], down[:n]


class Stretches:
    """Hashes of any stretch of a sequence of 64-bit values."""

    def __init__(self, values: np.ndarray):
        up, self._down = powers(len(values) + 1)
        self._sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[:-1], out=self._sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray, salt: int = 0) -> np.ndarray:
        return mix((self._sums[end] - self._sums[start]) * self._down[start] + (end - start).astype(np.uint64), salt)


@dataclass
class Words:
    """The words of a slice of documents: byte spans, hashes, and each document's run of them."""

    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    first: np.ndarray
    hashes: np.ndarray

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions at which n words of one document begin, and the hashes of those n words."""
        at = np.arange(max(0, len(self.doc) - n + 1))
        at = at[self.doc[at] == self.doc[at + n - 1]]
        return at, Stretches(self.hashes)(at, at + n)


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = False, gaps: np.ndarray = SPACE) -> Words:
    """The words of the documents that ``offsets`` cut out of ``data``; ``gaps`` says which bytes part them."""
    n = len(offsets) - 1
    if lower:
        data = LOWER[data]
    if not len(data):
        none = np.zeros(0, np.int64)
        return Words(none, none, none, np.zeros(n + 1, np.int64), np.zeros(0, np.uint64))
    gap = gaps[data]
    before = np.empty(len(data), bool)
    before[0], before[1:] = True, gap[:-1]
    before[offsets[:-1][offsets[:-1] < len(data)]] = True
    after = np.empty(len(data), bool)
    after[-1], after[:-1] = True, gap[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = True
    start, end = np.flatnonzero(~gap & before), np.flatnonzero(~gap & after) + 1
    doc = np.searchsorted(offsets[:-1], start, "right") - 1
    first = np.zeros(n + 1, np.int64)
    np.cumsum(np.bincount(doc, minlength=n), out=first[1:])
    return Words(start, end, doc, first, _hashed(data, start, end))


def _hashed(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of byte spans in ascending order, a few megabytes of a very long text at a time."""
    out = np.empty(len(start), np.uint64)
    low = 0
    while low < len(start):
        base = start[low]
        high = max(low + 1, int(np.searchsorted(end, base + SLICE_BYTES, "right")))
        values = Stretches(_BYTE[data[base : end[high - 1]]])
        out[low:high] = values(start[low:high] - base, end[low:high] - base)
        low = high
    return out

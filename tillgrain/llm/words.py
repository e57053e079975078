"""Words of a text as 64-bit hashes, computed on whole arrays of bytes.

A word is a maximal run of bytes other than space and the controls 09 to 0D, which
are the bytes of the code points of the same number in UTF-8.
"""

from __future__ import annotations

import numpy as np

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)

BREAKS = np.zeros(256, dtype=bool)
BREAKS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_VALUES = np.arange(1, 257, dtype=np.uint64)
_LOWER_VALUES = _VALUES.copy()
_LOWER_VALUES[ord("A") : ord("Z") + 1] = _VALUES[ord("a") : ord("z") + 1]

_powers: dict[int, np.ndarray] = {}


def powers(base: int, size: int) -> np.ndarray:
    """base ** 0, 1, ... modulo 2**64; the table grows with the longest text seen."""
    known = _powers.get(base)
    if known is None or known.size < size:
        total = max(1 << 16, 1 << (size - 1).bit_length())
        known = np.full(total, base & _MASK, dtype=np.uint64)
        known[0] = 1
        known = np.multiply.accumulate(known)
        _powers[base] = known
    return known[:size]


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """Spread every input bit over the word (a bijection for a given salt)."""
    x = x ^ np.uint64(salt & _MASK)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte, and byte after the last, of each word."""
    inside = np.zeros(data.size + 2, dtype=np.int8)
    inside[1:-1] = ~BREAKS[data]
    edges = np.diff(inside)
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = _BASE) -> np.ndarray:
    """A hash of values[start:end] for each pair, from one running sum.

    sum(v[i] * base**i) over the run, times base**-start, is the polynomial of the
    run alone, wherever it stands.
    """
    inverse = _INVERSE if base == _BASE else pow(base, -1, 1 << 64)
    sums = np.zeros(values.size + 1, dtype=np.uint64)
    np.cumsum(values * powers(base, max(1, values.size))[: values.size], out=sums[1:])
    shift = powers(inverse, values.size + 1)[starts]
    return mix((sums[ends] - sums[starts]) * shift + (ends - starts).astype(np.uint64))


def word_hashes(text: bytes, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word starts and ends in bytes, and a hash of each word (A-Z as a-z if ``lower``)."""
    data = np.frombuffer(text, dtype=np.uint8)
    starts, ends = word_bounds(data)
    values = (_LOWER_VALUES if lower else _VALUES)[data]
    return starts, ends, run_hashes(values, starts, ends)


def shingles(text: bytes, size: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``size`` words, A-Z as a-z.

    A text of fewer words has its whole word sequence as the only one; a text
    without words has none.
    """
    _, _, words = word_hashes(text, lower=True)
    if words.size == 0:
        return words
    width = min(size, words.size)
    starts = np.arange(words.size - width + 1)
    return np.unique(run_hashes(words, starts, starts + width))

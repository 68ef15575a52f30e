"""Hashes of the words of a text, for a whole text at once with numpy.

Words are runs of bytes other than the ASCII white space ``\\x20 \\x09-\\x0D``.
"""

from __future__ import annotations

import numpy as np

_FACTOR = 0x9E3779B97F4A7C15
_INVERSE = pow(_FACTOR, -1, 1 << 64)
_BYTES = np.random.default_rng(2024).integers(1, 1 << 63, 256, dtype=np.uint64)
_IS_WORD = np.ones(256, bool)
_IS_WORD[[32, 9, 10, 11, 12, 13]] = False
_powers = {1: np.ones(1, np.uint64), -1: np.ones(1, np.uint64)}


def _power(sign: int, n: int) -> np.ndarray:
    """The first n powers of the factor (sign 1) or of its inverse modulo 2**64."""
    if len(_powers[sign]) < n:
        base = np.full(max(n, 1 << 14), _FACTOR if sign > 0 else _INVERSE, np.uint64)
        base[0] = 1
        if n > 1 << 22:
            return np.multiply.accumulate(base)
        _powers[sign] = np.multiply.accumulate(base)
    return _powers[sign][:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A well spread permutation of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word of the UTF-8 bytes, in order; equal for equal words."""
    inside = _IS_WORD[data]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * _power(1, len(data)), out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * _power(-1, len(data) + 1)[starts])


def shingles(data: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``size`` words; a shorter text is one run, an
    empty one none."""
    hashes = word_hashes(data)
    if not len(hashes):
        return hashes
    width = min(size, len(hashes))
    total = np.zeros(len(hashes) - width + 1, np.uint64)
    for k in range(width):
        total = mixed(total + hashes[k:len(hashes) - width + 1 + k])
    return np.unique(total)

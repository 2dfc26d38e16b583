"""Polynomial hashes of byte ranges, for all ranges of a buffer at once."""

from __future__ import annotations

import numpy as np

# Odd constants: powers have inverses modulo 2^64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def _extended(table: np.ndarray, base: int, size: int) -> np.ndarray:
    steps = np.full(size, np.uint64(base))
    steps[0] = 1
    return np.multiply.accumulate(steps)


def _tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverses
    if len(_powers) < size:
        size = 1 << (size - 1).bit_length()
        _powers, _inverses = _extended(_powers, _BASE, size), _extended(_inverses, _INVERSE, size)
    return _powers, _inverses


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


class Prefixes:
    """Prefix sums of a buffer; hashes(starts, ends) are equal for equal ranges wherever they stand."""

    def __init__(self, buffer: np.ndarray):
        powers, self.inverses = _tables(len(buffer) + 1)
        self.sums = np.zeros(len(buffer) + 1, np.uint64)
        np.cumsum(_BYTES[buffer] * powers[:len(buffer)], out=self.sums[1:])

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * self.inverses[starts])

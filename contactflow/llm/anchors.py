"""Content-defined anchors: what two equal windows of a sequence are sure to have in common."""

from __future__ import annotations

import numpy as np

#: Odd multiplier of the rolling hash and its inverse modulo 2**64.
MULTIPLIER = 0x5851F42D4C957F2D
INVERSE = pow(MULTIPLIER, -1, 1 << 64)
PLACE_BITS = 24
PLACE = np.uint64((1 << PLACE_BITS) - 1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Powers:
    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) <= n:
            size = max(n, 1 << 16)
            self.up, self.down = _powers(MULTIPLIER, size), _powers(INVERSE, size)
        return self.up, self.down


POWERS = _Powers()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _sums(units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = len(units)
    up, down = POWERS.get(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(units * up[:n], out=sums[1:])
    return sums, down


def gram_hashes(units: np.ndarray, k: int) -> np.ndarray:
    """64-bit hash of each run of k units, from 64-bit hashes of the units."""
    sums, down = _sums(units)
    n = len(units)
    return _mix((sums[k:] - sums[: n - k + 1]) * down[: n - k + 1])


def stretch_hashes(units: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of the units from each begin to its end."""
    sums, down = _sums(units)
    return _mix((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64))


def find(units: np.ndarray, k: int, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(place, hash, first, last) of each anchor; windows first..last start there and hold the anchor.

    The anchor of a window is its smallest k-gram, the leftmost of equals, so equal windows have
    equal anchors at equal places, and each window has exactly one.
    """
    if len(units) < window:
        empty = np.empty(0, np.int64)
        return empty, empty.astype(np.uint64), empty, empty
    grams = gram_hashes(units, k)
    places = np.arange(len(grams), dtype=np.uint64) & PLACE
    low = (grams & ~PLACE) | places
    width = window - k + 1
    step = 1
    while 2 * step <= width:
        low = np.minimum(low[:-step], low[step:])
        step *= 2
    if step < width:
        low = np.minimum(low[: len(low) - (width - step)], low[width - step :])
    start = np.arange(len(low), dtype=np.uint64)
    place = (start + (((low & PLACE) - start) & PLACE)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    last = np.append(first[1:], len(place)) - 1
    place = place[first]
    return place, grams[place], first, last

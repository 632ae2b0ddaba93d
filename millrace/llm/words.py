"""Word hashes of many texts at once, as numpy arrays.

Words are maximal runs of anything but the six ASCII white-space characters.
A word's hash is a polynomial in table-mapped bytes modulo 2**64, taken from
prefix sums over the whole block, then mixed.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import lru_cache

import numpy as np

_SPACES = (0x20, *range(0x09, 0x0E))
_BASE = 0x9E3779B97F4A7C15
_U64 = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (splitmix64)."""
    x = x ^ (x >> _U64(30))
    x = x * _U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U64(27))
    x = x * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per byte: whether it is white space, its number, and its number in lower case."""
    space = np.zeros(256, bool)
    space[list(_SPACES)] = True
    number = mix(np.arange(1, 257, dtype=_U64) * _U64(_BASE))
    lower = number.copy()
    lower[65:91] = number[97:123]
    return space, number, lower


_powers: list[np.ndarray] = []


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse; kept between blocks."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, 1 << 16)
        inverse = pow(_BASE, -1, 1 << 64)
        made = []
        for base in (_BASE, inverse):
            factors = np.full(size, base, _U64)
            factors[0] = 1
            made.append(np.cumprod(factors))
        _powers[:] = made if size <= 1 << 24 else []
        return made[0], made[1]
    return _powers[0], _powers[1]


class Words:
    """The words of a block of texts.

    ``hash``, ``start`` and ``end`` (bytes in ``data``) are per word; the words of
    text ``i`` are ``first[i]:first[i + 1]``; its bytes begin at ``begin[i]``.
    """

    def __init__(self, texts: Sequence[str | None], lower: bool = False) -> None:
        parts = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        lengths = np.fromiter((len(p) + 1 for p in parts), np.int64, len(parts))
        self.begin = np.concatenate([[0], np.cumsum(lengths)])
        self.bytes = b"\n".join([*parts, b""])
        self.data = np.frombuffer(self.bytes, np.uint8)
        space, number, lowered = _tables()
        inside = np.zeros(len(self.data) + 2, np.int8)
        inside[1:-1] = ~space[self.data]
        steps = np.diff(inside)
        self.start = np.flatnonzero(steps == 1)
        self.end = np.flatnonzero(steps == -1)
        powers, inverse = _powers_to(len(self.data) + 1)
        values = (lowered if lower else number)[self.data]
        values *= powers[: len(values)]
        sums = np.zeros(len(values) + 1, _U64)
        np.cumsum(values, out=sums[1:])
        raw = (sums[self.end] - sums[self.start]) * inverse[self.start]
        self.hash = mix(raw + (self.end - self.start).astype(_U64) * _U64(_BASE))
        self.first = np.searchsorted(self.start, self.begin)


_STEP = _U64(0xD6E8FEB86659FD93)


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` consecutive words (none if there are fewer)."""
    count = len(hashes) - size + 1
    if count <= 0:
        return np.zeros(0, _U64)
    total = np.zeros(count, _U64)
    for i in range(size):
        total *= _STEP
        total += hashes[i : i + count]
    return mix(total + _U64(size))

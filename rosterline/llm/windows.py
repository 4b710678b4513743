"""Hashes of word windows, for all windows of a text at once.

Words joined by single blanks are one byte string. With prefix sums of its bytes times the powers
of an odd number, the hash of any stretch is one subtraction and one product (all modulo 2**64),
so windows of every size cost the same.
"""

from __future__ import annotations

import numpy as np

_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


class _Powers:
    """Powers of a base and of its inverse, as long as any text so far."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    @staticmethod
    def _filled(base: int, size: int) -> np.ndarray:
        out = np.full(size, base, np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)

    def to(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < size:
            size = max(size, 1 << 16)
            self.up, self.down = (self._filled(b, size) for b in (self.base, self.inverse))
        return self.up, self.down


_POWERS = tuple(_Powers(base) for base in _BASES)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


class Words:
    """The words of one text, given as bytes with single blanks between them."""

    def __init__(self, joined: bytes):
        self.bytes = np.frombuffer(joined, np.uint8)
        gaps = np.flatnonzero(self.bytes == 32)
        some = len(joined) > 0
        self.starts = np.concatenate([[0], gaps + 1]).astype(np.int64)[: len(gaps) + some]
        self.ends = np.concatenate([gaps, [len(joined)]]).astype(np.int64)[: len(gaps) + some]

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self, size: int, which: int = 0) -> np.ndarray:
        """A hash of each window of ``size`` words; none if there are fewer words."""
        count = len(self) - size + 1
        if count < 1:
            return np.zeros(0, np.uint64)
        up, down = _POWERS[which].to(len(self.bytes) + 1)
        sums = np.zeros(len(self.bytes) + 1, np.uint64)
        np.cumsum((self.bytes + np.uint64(1)) * up[: len(self.bytes)], out=sums[1:])
        first, last = self.starts[:count], self.ends[size - 1 :]
        return mixed((sums[last] - sums[first]) * down[first] + (last - first).astype(np.uint64))

"""A compressed FM-index over integer sequences: a wavelet matrix with packed bits and block counts.

Searches run in lockstep: one backward step for all queries still alive is a few array operations.
"""

from __future__ import annotations

import numpy as np

#: Patterns that are searched for together; bounds the memory of a search.
LOCKSTEP = 1 << 16


class Bits:
    """A bit vector of n bits with rank in constant time: n bits packed in words, one count a word."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        packed = np.concatenate([packed, np.zeros(-len(packed) % 8 + 8, np.uint8)]).view(np.uint64)
        self.words = packed
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(packed))[:-1]]).astype(np.int32)

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        word = at >> 6
        low = self.words[word] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1))
        return self.before[word] + np.bitwise_count(low)


class FMIndex:
    """Over text, an array of symbols 0..sigma-1. Suffixes are sorted by their first depth symbols, which serves patterns up to that length."""

    def __init__(self, text: np.ndarray, sigma: int, depth: int):
        n = len(text)
        rank, size = text.astype(np.int64), 1
        while size < depth:  # prefix doubling
            after = np.full(n, -1, np.int64)
            after[: n - size] = rank[size:] if size < n else after[:0]
            _, rank = np.unique((rank + 1) * (max(n, sigma) + 2) + after + 1, return_inverse=True)
            size *= 2
        self.order = np.argsort(rank, kind="stable")
        bwt = text[self.order - 1]  # of the first suffix: the last symbol, as if the text were a ring
        self.n, self.levels = n, max(1, int(sigma - 1).bit_length())
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=sigma))])
        self.planes, self.zeros = [], []
        now = bwt
        for level in range(self.levels - 1, -1, -1):
            bit = (now >> level) & 1 == 1
            self.planes.append(Bits(bit))
            self.zeros.append(int(n - bit.sum()))
            now = np.concatenate([now[~bit], now[bit]])
        # Where each symbol's run begins in the last order: ranks within it count from there.
        self.run = np.searchsorted(_reversed_key(now, self.levels), _reversed_key(np.arange(sigma), self.levels))

    def ranks(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol in the BWT before each position."""
        for level, (plane, zeros) in enumerate(zip(self.planes, self.zeros, strict=True)):
            ones = plane.rank(at)
            at = np.where((symbol >> (self.levels - 1 - level)) & 1 == 1, zeros + ones, at - ones)
        return at - self.run[symbol]

    def step(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of symbol followed by what lo..hi stand for."""
        both = self.ranks(np.concatenate([symbol, symbol]), np.concatenate([lo, hi]))
        start = self.first[symbol]
        return start + both[: len(lo)], start + both[len(lo) :]

    def repeated(self, text: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
        """Which of the patterns text[s : s + length] occur at least twice, by matching statistics cut at length.

        A pattern's search ends at the first suffix of it that occurs once. LOCKSTEP patterns are searched
        for at a time.
        """
        if len(starts) > LOCKSTEP:
            return np.concatenate([self.repeated(text, starts[i : i + LOCKSTEP], length) for i in range(0, len(starts), LOCKSTEP)])
        alive = np.arange(len(starts))
        lo, hi = np.zeros(len(starts), np.int64), np.full(len(starts), self.n, np.int64)
        for k in range(length - 1, -1, -1):
            lo, hi = self.step(text[starts[alive] + k], lo, hi)
            stay = hi - lo >= 2
            alive, lo, hi = alive[stay], lo[stay], hi[stay]
        out = np.zeros(len(starts), bool)
        out[alive] = True
        return out


def _reversed_key(symbols: np.ndarray, levels: int) -> np.ndarray:
    """The wavelet matrix's last order: by the bits from the lowest to the highest."""
    out = np.zeros(len(symbols), np.int64)
    for k in range(levels):
        out |= ((symbols >> k) & 1) << (levels - 1 - k)
    return out

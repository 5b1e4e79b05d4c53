"""Vectorised words and word n-grams as 64-bit hashes, over the bytes of Arrow string columns.

A word's hash is a polynomial over a table of random 64-bit values, one per byte, taken from prefix
sums; no Python object is made per word. Work goes in pieces of about PIECE bytes, so memory doesn't
follow a batch's or a text's length (but for 8 bytes a word).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

PIECE = 1 << 20
U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def separators(*spans: tuple[int, int]) -> np.ndarray:
    """Which bytes belong to words: all but those of the spans."""
    word = np.ones(256, bool)
    for lo, hi in spans:
        word[lo : hi + 1] = False
    return word


#: `[^\x20\x09-\x0D]+`
BLANK = separators((0x20, 0x20), (0x09, 0x0D))
#: `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` once A-Z are lower-cased: letters, digits and all beyond ASCII
ALNUM = separators((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))


class Hasher:
    """prefix: words are hashed twice, whole and by so many bytes of their beginning; arrays of them have two rows then."""

    def __init__(self, word_bytes: np.ndarray, lower: bool, prefix: int = 0):
        self.is_word, self.prefix = word_bytes, prefix
        values = mix(np.arange(1, 257, dtype=U) * U(0x9E3779B97F4A7C15))
        self.fold = np.arange(256, dtype=np.uint8)
        if lower:
            self.fold[65:91] += 32
        self.values = values[self.fold]
        base = U(0xD6E8FEB86659FD93)
        inverse = U(pow(int(base), -1, 1 << 64))
        n = PIECE + 2
        self.power, self.unpower = np.full(n, base, U), np.full(n, inverse, U)
        self.power[0] = self.unpower[0] = U(1)
        self.power, self.unpower = np.cumprod(self.power), np.cumprod(self.unpower)

    def piece(self, buf: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashes, starts and ends of the words of at most PIECE bytes; words end at cuts."""
        n = len(buf)
        word = self.is_word[buf]
        before, after = np.zeros(n, bool), np.zeros(n, bool)
        before[1:], after[:-1] = word[:-1], word[1:]
        cuts = cuts[(cuts > 0) & (cuts < n)]
        before[cuts] = False
        after[cuts - 1] = False
        starts, ends = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
        sums = np.zeros(n + 1, U)
        np.cumsum(self.values[buf] * self.power[:n], out=sums[1:])
        words = mix((sums[ends] - sums[starts]) * self.unpower[starts])
        if self.prefix:
            words = np.stack([words, mix((sums[np.minimum(ends, starts + self.prefix)] - sums[starts]) * self.unpower[starts])])
        return words, starts, ends

    def long_text(self, buf: np.ndarray) -> np.ndarray:
        """Hashes of the words of one text of any length."""
        found, at = [], 0
        while at < len(buf):
            part = buf[at : at + PIECE]
            end = at + len(part)
            if end < len(buf) and self.is_word[buf[end]] and self.is_word[part[-1]]:  # the cut is inside a word
                gaps = np.flatnonzero(~self.is_word[part])
                if len(gaps):
                    end = at + int(gaps[-1]) + 1
                    part = buf[at:end]
                else:  # a word longer than a piece
                    while end < len(buf) and self.is_word[buf[end]]:
                        rest = np.flatnonzero(~self.is_word[buf[end : end + PIECE]])
                        end = end + int(rest[0]) if len(rest) else min(len(buf), end + PIECE)
                    found.append(np.array([xxhash.xxh64_intdigest(self.fold[buf[at:end]].tobytes())], U))
                    if self.prefix:
                        found[-1] = np.stack([found[-1], self.piece(buf[at : at + self.prefix], np.zeros(0, np.int64))[0][0]])
                    at = end
                    continue
            found.append(self.piece(part, np.zeros(0, np.int64))[0])
            at = end
        return np.concatenate(found, axis=-1) if found else np.zeros((2, 0) if self.prefix else 0, U)

    def rows(self, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """Groups of rows lo..hi: their words' hashes in order, and for each row where its words start (one more at the end)."""
        offsets, data = buffers(column)
        lo, n = 0, len(offsets) - 1
        while lo < n:
            hi = int(np.searchsorted(offsets, offsets[lo] + PIECE, side="right")) - 1
            if hi <= lo:  # one text longer than a piece
                words = self.long_text(data[offsets[lo] : offsets[lo + 1]])
                yield lo, lo + 1, words, np.array([0, words.shape[-1]])
                lo += 1
                continue
            hi = min(hi, n)
            cuts = offsets[lo : hi + 1] - offsets[lo]
            words, starts, _ = self.piece(data[offsets[lo] : offsets[hi]], cuts)
            yield lo, hi, words, np.searchsorted(starts, cuts)
            lo = hi


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string column; nulls are empty."""
    column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return offsets, np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)


_SEEDS = mix(np.arange(101, 165, dtype=U) * U(0x9E3779B97F4A7C15)) | U(1)


def grams(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each position on; k - 1 fewer than words."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, U)
    total = words[:n] * _SEEDS[0]
    for j in range(1, k):
        total = total + mix(words[j : n + j] + _SEEDS[j]) * _SEEDS[j]
    return mix(total)

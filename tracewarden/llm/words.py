"""Words of many texts as 64-bit hashes, computed with numpy over whole buffers.

A word is a run of bytes other than the blanks 0x20 and 0x09-0x0D, which are no part of any
longer UTF-8 character. Its hash is a polynomial over its bytes modulo 2^64, taken from prefix
sums, and mixed. Buffers are cut at blanks, so memory is bounded for texts of any length (a
single word longer than a slice is held as a whole).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

SLICE = 1 << 18
BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of a base and of its inverse modulo 2^64, grown on demand."""

    def __init__(self, base: np.uint64):
        self.base, self.inverse = base, np.uint64(pow(int(base), -1, 1 << 64))
        self.up = self.down = np.ones(0, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            ones = [np.full(n, b, np.uint64) for b in (self.base, self.inverse)]
            for x in ones:
                x[0] = 1
            self.up, self.down = (np.cumprod(x, dtype=np.uint64) for x in ones)
        return self.up[:n], self.down[:n]


_POWERS: dict[int, _Powers] = {}


def _powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    if which not in _POWERS:
        _POWERS[which] = _Powers(BASES[which])
    return _POWERS[which].get(n)


def _slice_hashes(data: bytes, lower: bool, which: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of a buffer, and where each starts."""
    raw = np.frombuffer(data, np.uint8)
    solid = np.empty(len(raw) + 2, bool)
    solid[0] = solid[-1] = False
    np.logical_not(_BLANK[raw], out=solid[1:-1])
    edges = np.flatnonzero(solid[1:] != solid[:-1])
    starts, ends = edges[::2], edges[1::2]
    up, down = _powers(which, len(raw))
    values = (_LOWER[raw] if lower else raw).astype(np.uint64) + np.uint64(1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(values * up, out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64)), starts


def _slices(text: bytes) -> Iterator[bytes]:
    at = 0
    while at < len(text):
        end = at + SLICE
        if end < len(text):
            ends = [p for p in (text.find(c, end) for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c")) if p >= 0]
            end = min(ends, default=len(text))
        yield text[at:end]
        at = end


def word_hashes(texts: list[bytes], lower: bool = False, which: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts one after the other, and the offsets of the texts in them (one more than texts).

    ``lower`` folds A-Z first; ``which`` selects one of two independent hash functions.
    """
    hashes, counts = [], np.zeros(len(texts), np.int64)
    group: list[int] = []
    size = 0

    def flush():
        data = b" ".join(texts[n] for n in group)
        found, starts = _slice_hashes(data, lower, which)
        hashes.append(found)
        bounds = np.cumsum([0, *[len(texts[n]) + 1 for n in group]])
        counts[group] = np.diff(np.searchsorted(starts, bounds))
        group.clear()

    for n, text in enumerate(texts):
        if len(text) > SLICE:
            if group:
                flush()
            for part in _slices(text):
                found, _ = _slice_hashes(part, lower, which)
                hashes.append(found)
                counts[n] += len(found)
            size = 0
            continue
        group.append(n)
        size += len(text) + 1
        if size >= SLICE:
            flush()
            size = 0
    if group:
        flush()
    every = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    return every, np.concatenate([[0], np.cumsum(counts)])


_FACTORS = mix(np.arange(1, 65, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of every run of ``width`` words, at its first word; runs do not stop at the end of a text."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, np.uint64(width), np.uint64)
    for k in range(width):
        total += hashes[k : k + n] * _FACTORS[k]
    return mix(total)

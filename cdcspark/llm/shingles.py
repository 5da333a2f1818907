"""Distinct word shingles of texts as 64-bit hashes, straight from UTF-8 buffers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from cdcspark.llm.common import mixed, row_blocks

SHINGLE_WORDS = 5

#: Bytes of text handled at once; a longer text is handled alone.
CHUNK_BYTES = 1 << 20

_SEPARATORS = np.zeros(256, bool)
_SEPARATORS[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

_random = np.random.Generator(np.random.PCG64(20240501))
_BYTE = _random.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_PLACE = _random.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse."""
    if len(_powers.get("up", ())) < n:
        size = max(n, CHUNK_BYTES + 1)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            x = np.full(size, base, np.uint64)
            x[0] = 1
            _powers[name] = np.multiply.accumulate(x)
    return _powers["up"][:n], _powers["down"][:n]


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, A-Z as a-z, and per row the number of words before it ends (with a leading 0)."""
    if not len(raw):
        return np.empty(0, np.uint64), np.zeros(len(offsets), np.int64)
    inside = ~_SEPARATORS[raw]
    borders = offsets[1:-1]
    borders = borders[borders < len(raw)]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    first[borders] |= inside[borders]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    before = borders[borders > 0] - 1
    last[before] |= inside[before]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    up, down = _power(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[_LOWER[raw]] * up[: len(raw)], out=sums[1:])
    words = mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    return words, np.searchsorted(starts, offsets)


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, k: int = SHINGLE_WORDS) -> Iterator[np.ndarray]:
    """Per row the sorted distinct hashes of its k-word shingles; with fewer words, of the whole sequence; none without words."""
    for a, b in row_blocks(offsets, CHUNK_BYTES):
        own = offsets[a : b + 1]
        words, ends = word_hashes(raw[own[0] : own[-1]], own - own[0])
        if len(words) >= k:
            rolled = np.zeros(len(words) - k + 1, np.uint64)
            for i in range(k):
                rolled += words[i : len(words) - k + 1 + i] * _PLACE[i]
            rolled = mixed(rolled)
        for i in range(b - a):
            s, e = ends[i], ends[i + 1]
            if e - s >= k:
                yield np.unique(rolled[s : e - k + 1])
            elif e > s:
                yield mixed((words[s:e] * _PLACE[: e - s]).sum(dtype=np.uint64, keepdims=True) + np.uint64(e - s))
            else:
                yield np.empty(0, np.uint64)

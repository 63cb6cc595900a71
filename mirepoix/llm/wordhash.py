"""Words and word shingles of many texts at once, as 64-bit hashes in numpy."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
WHITE = np.zeros(256, bool)
WHITE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_PLACE = mix(np.arange(1001, 1065, dtype=np.uint64) * np.uint64(_BASE)) | np.uint64(1)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2**64."""
    if not _powers or len(_powers["up"]) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each slice of ``values`` (64-bit symbol codes): the same wherever the slice lies."""
    up, down = powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:len(values)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def lowered(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text numbers of all words: runs of bytes other than blanks and tab to CR."""
    inside = ~WHITE[data]
    breaks = np.zeros(len(data) + 1, bool)
    breaks[offsets] = True
    before = np.ones(len(data) + 1, bool)
    np.logical_not(inside, out=before[1:])
    starts = np.flatnonzero(inside & (before[:-1] | breaks[:-1]))
    after = np.ones(len(data), bool)
    np.logical_not(inside[1:], out=after[:-1])
    ends = np.flatnonzero(inside & (after | breaks[1:])) + 1
    owner = np.searchsorted(offsets, starts, "right") - 1
    return starts, ends, owner


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of each word, A-Z as a-z."""
    starts, ends, owner = word_spans(data, offsets)
    return span_hashes(_BYTE[_LOWER[data]], starts, ends), owner


def shingle_hashes(words: np.ndarray, owner: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of each run of ``size`` words; a shorter text is one run of all its words."""
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64), owner
    padded = np.concatenate([words, np.zeros(size, np.uint64)])
    padded_owner = np.concatenate([owner, np.full(size, -1, owner.dtype)])
    total = np.zeros(n, np.uint64)
    for j in range(size):
        total += np.where(padded_owner[j:n + j] == owner, padded[j:n + j] * _PLACE[j], np.uint64(0))
    whole = padded_owner[size - 1:n + size - 1] == owner
    first = np.ones(n, bool)
    first[1:] = owner[1:] != owner[:-1]
    keep = whole | first
    return mix(total)[keep], owner[keep]


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    hashes, owner = shingle_hashes(*word_hashes(data, offsets), size)
    cuts = np.searchsorted(owner, np.arange(len(offsets)))
    return [unique_sorted(hashes[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def unique_sorted(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    if len(values) < 2:
        return values
    keep = np.ones(len(values), bool)
    np.not_equal(values[1:], values[:-1], out=keep[1:])
    return values[keep]

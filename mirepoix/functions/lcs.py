"""Longest common subsequences of many pairs of texts at once.

One bit per letter of the left text in words of 64 bits; a step takes the next letter of all right
texts together. Pairs of like length go through numpy side by side; where too few pairs share a
length for that to pay, a pair goes alone, with one long integer for its bits. Both ways count the same.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

import numpy as np

BITS = 64
# A numpy step costs as much as this many single steps, per word of bits.
PAIRS_A_WORD = 30
# Pairs side by side, so that a step's rows stay in the processor's cache, and letters of all of them.
SIDE_BY_SIDE, CELLS = 2_048, 1 << 22


def codes(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points in a row, and where each text begins (one entry more than texts)."""
    flat = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32)
    return flat, np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)


def _places(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every letter of the chosen texts: the text's row here, and its place within the text."""
    row = np.repeat(np.arange(len(sizes)), sizes)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _together(left: tuple, right: tuple, chosen: np.ndarray, words: int) -> np.ndarray:
    """LCS lengths of the chosen pairs, whose left texts fit ``words`` words; longest right text first."""
    (a, a_starts), (b, b_starts) = left, right
    a_size = a_starts[chosen + 1] - a_starts[chosen]
    b_size = b_starts[chosen + 1] - b_starts[chosen]
    row, place = _places(a_size)
    keys = row.astype(np.int64) << 21 | a[a_starts[chosen][row] + place]
    letters, slot = np.unique(keys, return_inverse=True)
    bits = np.zeros((len(letters) + 1, words), dtype=np.uint64)
    np.bitwise_or.at(bits, (slot, place // BITS), np.uint64(1) << (place % BITS).astype(np.uint64))

    row, place = _places(b_size)
    keys = row.astype(np.int64) << 21 | b[b_starts[chosen][row] + place]
    at = np.minimum(np.searchsorted(letters, keys), len(letters) - 1)
    steps = np.full((int(b_size.max(initial=0)), len(chosen)), len(letters), dtype=np.int32)
    steps[place, row] = np.where(letters[at] == keys, at, len(letters))

    state = [np.full(len(chosen), ~np.uint64(0)) for _ in range(words)]
    bits = np.ascontiguousarray(bits.T)
    # right texts get shorter along the pairs: those that still have a letter are the first ones
    live = np.searchsorted(-b_size, -np.arange(1, len(steps) + 1), side="right")
    for step, k in zip(steps, live):
        carry = None
        for w in range(words):
            now = state[w][:k]
            hit = now & bits[w][step[:k]]
            total = now + hit
            over = total < now
            if carry is not None:
                total += carry
                over |= total < carry
            carry = over.astype(np.uint64)
            state[w][:k] = total | (now - hit)
    zeros = np.zeros(len(chosen), dtype=np.int64)
    for w in range(words):
        held = np.clip(a_size - w * BITS, 0, BITS)
        used = np.where(held == BITS, ~np.uint64(0), (np.uint64(1) << (held % BITS).astype(np.uint64)) - np.uint64(1))
        zeros += np.bitwise_count(~state[w] & used).astype(np.int64)
    return zeros


def alone(a: str, b: str) -> int:
    """LCS length of one pair."""
    if len(a) > len(b):
        a, b = b, a
    # a common beginning and end belong to some longest common subsequence
    head = len(os.path.commonprefix([a, b]))
    a, b = a[head:], b[head:]
    tail = len(os.path.commonprefix([a[::-1], b[::-1]]))
    a, b = a[:len(a) - tail], b[:len(b) - tail]
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    state = full
    for c in b:
        hit = state & places.get(c, 0)
        state = (state + hit | state - hit) & full
    return head + tail + len(a) - state.bit_count()


def lengths(left: Sequence[str], right: Sequence[str]) -> np.ndarray:
    """LCS length of each pair."""
    pairs = [(a, b) if len(a) <= len(b) else (b, a) for a, b in zip(left, right)]
    left, right = [p[0] for p in pairs], [p[1] for p in pairs]
    found = np.zeros(len(pairs), dtype=np.int64)
    if not pairs:
        return found
    words = np.array([-(-len(a) // BITS) for a in left])
    same = np.array([a == b for a, b in pairs])
    found[same] = [len(a) for a, b in pairs if a == b]
    sizes = np.array([len(b) for b in right])
    coded = codes(left), codes(right)
    for width in np.unique(words[~same & (words > 0)]).tolist():
        chosen = np.flatnonzero(~same & (words == width))
        chosen = chosen[np.argsort(-sizes[chosen], kind="stable")]
        start = 0
        while start < len(chosen):
            fit = max(1, CELLS // int(sizes[chosen[start]]))
            block = chosen[start:start + min(SIDE_BY_SIDE, fit)]
            start += len(block)
            # what the longest right texts have over the others is walked by few pairs
            if sizes[block].sum() >= PAIRS_A_WORD * width * sizes[block].max():
                found[block] = _together(*coded, block, width)
            else:
                found[block] = [alone(left[i], right[i]) for i in block]
    return found


def similarity(left: Sequence[str | None], right: Sequence[str | None]) -> list[float | None]:
    """200 * LCS / summed length of each pair, 100 for two empty texts; None where a text is missing."""
    there = [i for i, (a, b) in enumerate(zip(left, right)) if a is not None and b is not None]
    shared = lengths([left[i] for i in there], [right[i] for i in there])
    out: list[float | None] = [None] * len(left)
    for i, n in zip(there, shared.tolist()):
        size = len(left[i]) + len(right[i])
        out[i] = 200.0 * n / size if size else 100.0
    return out

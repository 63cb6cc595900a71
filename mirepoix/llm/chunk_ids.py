"""Token ids of text chunks, each distinct chunk encoded once per worker."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np


class ChunkIds:
    """A table from 64-bit chunk hashes to token ids, filled by ``encode`` as chunks turn up.

    Holds at most about ``limit`` chunks; beyond that it starts anew.
    """

    def __init__(self, encode: Callable[[list[str]], Sequence[Sequence[int]]], limit: int = 1_000_000):
        self.encode, self.limit = encode, limit
        self.clear()

    def clear(self) -> None:
        self.tables = [(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32)) for _ in range(2)]
        self.flat, self.used = np.zeros(1 << 16, np.int32), 0

    def _find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        found = np.zeros(len(keys), bool)
        starts, sizes = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int32)
        for known, at, n in self.tables:
            if len(known):
                i = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                hit = known[i] == keys
                starts[hit], sizes[hit] = at[i[hit]], n[i[hit]]
                found |= hit
        return found, starts, sizes

    def _add(self, keys: np.ndarray, texts: list[str]) -> None:
        rows = self.encode(texts)
        sizes = np.fromiter((len(r) for r in rows), np.int32, len(rows))
        flat = np.fromiter((i for r in rows for i in r), np.int32, int(sizes.sum()))
        while self.used + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.used:self.used + len(flat)] = flat
        starts = self.used + np.cumsum(sizes, dtype=np.int64) - sizes
        self.used += len(flat)
        main, recent = self.tables
        recent = tuple(map(np.concatenate, zip(recent, (keys, starts, sizes), strict=True)))
        if len(recent[0]) > 20_000 + len(main[0]) // 8:
            main = tuple(map(np.concatenate, zip(main, recent, strict=True)))
            recent = tuple(x[:0] for x in recent)
            order = np.argsort(main[0], kind="stable")
            main = tuple(x[order] for x in main)
        order = np.argsort(recent[0], kind="stable")
        self.tables = [main, tuple(x[order] for x in recent)]

    def ids(self, hashes: np.ndarray, texts: Callable[[np.ndarray], list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the chunks in order, and the number of each chunk's; ``texts`` gives chunks by position."""
        keys, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if sum(len(t[0]) for t in self.tables) > self.limit:
            self.clear()
        found, starts, sizes = self._find(keys)
        if not found.all():
            new = np.flatnonzero(~found)
            self._add(keys[new], texts(first[new]))
            _, starts, sizes = self._find(keys)
        starts, sizes = starts[inverse], sizes[inverse].astype(np.int64)
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.repeat(starts - (ends - sizes), sizes) + np.arange(total)], sizes

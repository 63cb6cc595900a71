"""Words as exact integer codes, and runs of codes as integer keys."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def word_codes(data: np.ndarray, inside: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """A code per word, equal for equal words, and the word of each code; ``inside`` marks the bytes of words."""
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data[inside]))
    coded = words.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def following(codes: np.ndarray, owner: np.ndarray, most: int) -> np.ndarray:
    """Row j: the code j words on, or -1 where ``owner`` (a text, a piece) has ended."""
    n = len(codes)
    out = np.full((most, n), -1, np.int64)
    for j in range(min(most, n)):
        same = owner[j:] == owner[:n - j]
        out[j, :n - j][same] = codes[j:][same]
    return out


def run_keys(columns: np.ndarray) -> np.ndarray:
    """One integer per place, equal exactly where all rows of ``columns`` (codes from -1 on) are."""
    key, span = np.zeros(columns.shape[1], np.int64), 1
    for column in columns:
        base = int(column.max(initial=0)) + 2
        if span * base >= 1 << 62:
            values, key = np.unique(key, return_inverse=True)
            span = len(values)
        key = key * base + (column + 1)
        span *= base
    return key

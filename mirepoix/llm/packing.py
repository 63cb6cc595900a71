"""Packing along a space-filling curve.

A document's vector is the sum of random signed projections of its words, scaled by
the root of their number; three coordinates, squashed to a fixed grid, give its place
on a Hilbert curve. The table is range-sorted by that place (ties, such as copies, by
a hash of the id, so that no place is one task's alone), and each range is cut into
sequences in its order, so neighbours on the curve share sequences.

Each document is its token ids and the end id 0. Pieces are cut at sequence ends.
A range's last tokens, fewer than a full sequence, are cut into sequences whose
lengths are powers of two, which need no padding.

Defined cases: a null or empty text is the end id alone. Repeated rows are packed as
often as they stand. Further columns are not read.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from mirepoix.llm.chunk_ids import ChunkIds
from mirepoix.llm.common import text_chunks, texts
from mirepoix.llm.wordhash import mix, span_hashes, word_hashes

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
LENGTH = 1024
DIMENSIONS, BITS = 3, 16
END_ID = 0

# The white space of the vocabulary's own splitting pattern.
_SPACES = [9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
_OTHER, _LETTER, _NUMBER, _SPACE = range(4)


def hilbert(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of each row of grid coordinates below 2**bits (row-wise Gray-code transform)."""
    x = points.astype(np.int64).copy()
    dims = x.shape[1]
    q = 1 << (bits - 1)
    while q > 1:
        for i in range(dims):
            high = (x[:, i] & q) != 0
            swap = np.where(high, 0, (x[:, 0] ^ x[:, i]) & (q - 1))
            x[:, 0] ^= np.where(high, q - 1, swap)
            x[:, i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[:, i] ^= x[:, i - 1]
    t = np.zeros(len(x), np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        t ^= np.where((x[:, dims - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= t[:, None]
    place = np.zeros(len(x), np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            place = (place << 1) | ((x[:, i] >> b) & 1)
    return place


def curve_places(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The curve place of each text's hashed document vector."""
    hashes, owner = word_hashes(data, offsets)
    cuts = np.searchsorted(owner, np.arange(len(offsets)))
    counts = np.maximum(np.diff(cuts), 1)
    grid = np.zeros((len(offsets) - 1, DIMENSIONS), np.int64)
    for d in range(DIMENSIONS):
        signed = ((hashes >> np.uint64(16 * d)) & np.uint64(0xFFFF)).astype(np.float64) / 32767.5 - 1
        sums = np.append(0.0, np.cumsum(signed))
        spread = np.tanh((sums[cuts[1:]] - sums[cuts[:-1]]) / np.sqrt(counts))
        grid[:, d] = np.minimum((spread + 1) / 2 * (1 << BITS), (1 << BITS) - 1)
    return hilbert(grid)


class ByteTokens:
    """Ids of the byte-level vocabulary: texts are split as its pattern does, each distinct part encoded once."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        library = Tokenizer.from_file(path)
        library.encode_special_tokens = True
        self.parts = ChunkIds(lambda keys: [e.ids for e in library.encode_batch_fast(keys, add_special_tokens=False)])
        self.kinds = np.zeros(0x110000, np.uint8)
        every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
        for kind, pattern in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+")):
            for m in regex.finditer(pattern, every):
                self.kinds[ord(m[0][0]):ord(m[0][-1]) + 1] = kind
        self.kinds[0xD800:0xE000] = _OTHER
        self.kinds[_SPACES] = _SPACE

    def part_starts(self, points: np.ndarray, opens: np.ndarray) -> np.ndarray:
        """Which code points begin a part; ``opens`` marks the first of each text."""
        n = len(points)
        kind = self.kinds[points]
        begin = opens.copy()
        begin[1:] |= kind[1:] != kind[:-1]
        space = kind == _SPACE
        # the last of a run of white space before other text stands alone, or goes with that text if it is a blank
        last = np.zeros(n, bool)
        last[:-1] = space[:-1] & ~space[1:] & ~opens[1:]
        begin |= last
        joined = np.zeros(n, bool)
        joined[1:] = last[:-1] & (points[:-1] == 32)
        begin &= ~joined
        # contractions: an apostrophe that begins a part, and the letters of 's 't 'm 'd 're 've 'll
        at = np.flatnonzero(begin & (points == 39))
        if len(at):
            room = np.searchsorted(np.append(np.flatnonzero(opens), n), at, "right")
            limit = np.append(np.flatnonzero(opens), n)[room]
            padded = np.append(points, [0, 0])
            one, two = np.where(at + 1 < limit, padded[at + 1], 0), np.where(at + 2 < limit, padded[at + 2], 0)
            short = np.isin(one, [ord(c) for c in "stmd"])
            long = np.zeros(len(at), bool)
            for a, b in ("re", "ve", "ll"):
                long |= (one == ord(a)) & (two == ord(b))
            size = np.where(short, 2, np.where(long, 3, 0))
            at, size = at[size > 0], size[size > 0]
            begin[at + 1] = False
            after = at + size
            begin[after[after < n]] = True
        return np.flatnonzero(begin)

    def batch(self, column: pa.Array) -> Iterator[tuple[int, list[np.ndarray]]]:
        """(first row, [ids of each text]) for consecutive parts of a text column."""
        for first, _, data, offsets in text_chunks(column):
            text = data.tobytes().decode()
            points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
            ahead = np.append(0, np.cumsum((data & 0xC0) != 0x80))[offsets]
            opens = np.zeros(len(points) + 1, bool)
            opens[ahead] = True
            starts = self.part_starts(points, opens[:-1])
            ends = np.append(starts[1:], len(points))
            ids, sizes = self.parts.ids(
                span_hashes(mix(points.astype(np.uint64) + np.uint64(1)), starts, ends),
                lambda at, a=starts, b=ends, text=text: [text[a[i]:b[i]] for i in at])
            counts = np.append(0, np.cumsum(sizes))[np.searchsorted(starts, ahead)]
            yield first, [ids[a:b] for a, b in zip(counts[:-1], counts[1:], strict=True)]


@cache
def byte_tokens(path: str) -> ByteTokens:
    return ByteTokens(path)


class Packer:
    """Cuts a stream of documents into sequences; rows are (document number, start, length, crc, tokens, sequence, offset)."""

    def __init__(self, first_sequence: int, length: int = LENGTH):
        self.sequence, self.length, self.filled = first_sequence, length, 0
        self.open: list[tuple[int, int, np.ndarray, int]] = []

    def _rows(self) -> Iterator[tuple]:
        offset = 0
        for doc, start, ids, total in self.open:
            yield doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, self.sequence, offset
            offset += len(ids)
        self.sequence += 1
        self.open, self.filled = [], 0

    def add(self, doc: int, ids: np.ndarray) -> Iterator[tuple]:
        start = 0
        while start < len(ids):
            piece = ids[start:start + self.length - self.filled]
            self.open.append((doc, start, piece, len(ids)))
            self.filled += len(piece)
            start += len(piece)
            if self.filled == self.length:
                yield from self._rows()

    def finish(self) -> Iterator[tuple]:
        """The rest as sequences of decreasing powers of two."""
        rest, left = self.open, self.filled
        self.open, self.filled = [], 0
        while left:
            room = size = 1 << (left.bit_length() - 1)
            while room:
                doc, start, ids, total = rest.pop(0)
                self.open.append((doc, start, ids[:room], total))
                if len(ids) > room:
                    rest.insert(0, (doc, start + room, ids[room:], total))
                room -= min(room, len(ids))
            yield from self._rows()
            left -= size


def pack(docs: DataFrame, vocabulary: str = VOCABULARY, length: int = LENGTH) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A sequence id is the number of its range, times 2**32, plus its number there.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in text_chunks(batch.column("text")):
                yield pa.RecordBatch.from_arrays([
                    *(batch.column(c).slice(a, b - a) for c in ("doc_id", "text")), pa.array(curve_places(data, offsets)),
                ], ["doc_id", "text", "place"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, tokens = Packer(TaskContext.get().partitionId() << 32, length), byte_tokens(vocabulary)
        ids_of, seen, out = {}, 0, []

        def rows(found: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*found, strict=True)) if found else [()] * 7
            return pa.RecordBatch.from_arrays(
                [pa.array([ids_of[i] for i in columns[0]], id_type), *(pa.array(c, pa.int64()) for c in columns[1:])], ["doc_id", *names])

        id_type = None
        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            ids = batch.column("doc_id")
            for first, lists in tokens.batch(batch.column("text")):
                for k, found in enumerate(lists):
                    ids_of[seen] = ids[first + k].as_py()
                    out += packer.add(seen, np.append(found, np.int32(END_ID)))
                    seen += 1
                yield rows(out)
                out = []
                ids_of = {d: ids_of[d] for d, *_ in packer.open}
        if id_type is not None:
            yield rows(list(packer.finish()))

    placed = texts(docs).mapInArrow(place, f"doc_id {kind}, text string, place bigint")
    order = ["place", F.xxhash64("doc_id"), "doc_id"]
    ranged = placed.repartitionByRange(*order).sortWithinPartitions(*order, F.xxhash64("text")).select("doc_id", "text")
    return ranged.mapInArrow(cut, f"doc_id {kind}, " + ", ".join(f"{n} bigint" for n in names))

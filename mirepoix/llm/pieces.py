"""SentencePiece encoding that keeps byte offsets, and decoding.

A text is normalised by the model's compiled character map: at each place the longest
prefix in the map is replaced, and every normalised byte keeps the source byte it came
from. Each piece is projected back to a byte span of the text. Where the map is empty
(identity), whole batches are normalised and aligned in numpy, and text is cut before
each run of blanks - no merge of such a model crosses there - so that each distinct
chunk is encoded by the library once per worker.

Defined cases: a null or empty text gives the end id alone and the empty decoded text.
Spans tile the text: they start at 0, each begins where the last ended, and the end id
is the empty span at the end. Repeated rows give repeated rows; further columns are
not read.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from sentencepiece import sentencepiece_model_pb2

from mirepoix.llm.chunk_ids import ChunkIds
from mirepoix.llm.common import text_chunks, texts
from mirepoix.llm.wordhash import mix, span_hashes

MODEL = public_tokenizers.path("piece_bpe_32k.model")
_MARK = "▁".encode()
_CODE = mix(np.arange(9001, 9257, dtype=np.uint64))


class CharacterMap:
    """Longest-prefix replacement by a compiled map: a double-array trie and its replacement texts."""

    def __init__(self, compiled: bytes):
        size = struct.unpack_from("<I", compiled)[0] if compiled else 0
        self.units = np.frombuffer(compiled, "<u4", size // 4, 4).tolist() if compiled else []
        self.replacements = compiled[4 + size:]

    def prefix(self, data: bytes, at: int) -> tuple[int, bytes]:
        """(bytes taken, replacement) of the longest mapped prefix at ``at``; (0, empty) if none."""
        if not self.units:
            return 0, b""
        best = (0, b"")
        node, unit = 0, self.units[0]
        node ^= (unit >> 10) << ((unit & 0x200) >> 6)
        for i in range(at, len(data)):
            node ^= data[i]
            unit = self.units[node]
            if unit & 0x800000FF != data[i]:
                break
            node ^= (unit >> 10) << ((unit & 0x200) >> 6)
            if unit >> 8 & 1:
                value = self.units[node] & 0x7FFFFFFF
                best = (i + 1 - at, self.replacements[value:self.replacements.index(b"\0", value)])
        return best


class Encoder:
    """One model: ids, and source byte spans of its pieces."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            proto = sentencepiece_model_pb2.ModelProto.FromString(file.read())
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.spec = proto.normalizer_spec
        self.suffix = proto.trainer_spec.treat_whitespace_as_suffix
        self.map = CharacterMap(self.spec.precompiled_charsmap)
        self.end = self.library.eos_id()
        pieces = [p.piece.encode() for p in proto.pieces]
        self.sizes = np.array([1 if p.type == 6 else len(b) for p, b in zip(proto.pieces, pieces, strict=True)], np.int64)
        self.sizes[self.end] = 0
        self.unknown = self.library.unk_id()
        self.digits = [str(i) for i in range(len(pieces))]
        blank = self.library.piece_to_id("▁")
        whole = all(b.strip(b" ").rfind(_MARK) <= 0 or not b.replace(_MARK, b"") for b in map(self._after_marks, pieces))
        self.plain = (not self.spec.precompiled_charsmap and self.spec.add_dummy_prefix and self.spec.escape_whitespaces
                      and not self.spec.remove_extra_whitespaces and not self.suffix and whole
                      and not any(p.type == 4 for p in proto.pieces) and proto.trainer_spec.byte_fallback)
        self.chunks = ChunkIds(lambda keys: [r or [blank] for r in self.library.encode(keys, num_threads=1)])

    @staticmethod
    def _after_marks(piece: bytes) -> bytes:
        """A piece with its leading marks as one; a mark further in would join chunks."""
        while piece.startswith(_MARK * 2):
            piece = piece[len(_MARK):]
        return piece

    def normalise(self, text: str) -> tuple[bytes, np.ndarray]:
        """The normalised bytes and, for each of them and the end, the source byte it came from."""
        data, out, source = text.encode(), bytearray(), []
        mark = _MARK if self.spec.escape_whitespaces else b" "

        def put(piece: bytes, at: int) -> None:
            out.extend(piece)
            source.extend([at] * len(piece))

        steps, at = [], 0
        while at < len(data):
            taken, made = self.map.prefix(data, at)
            if not taken:
                taken = 1 if data[at] < 0x80 else 2 if data[at] < 0xE0 else 3 if data[at] < 0xF0 else 4
                made = data[at:at + taken]
            steps.append((at, taken, made))
            at += taken
        end = len(data)
        if self.spec.remove_extra_whitespaces:
            while steps and not steps[0][2].strip(b" "):
                steps.pop(0)
            while steps and not steps[-1][2].strip(b" "):
                steps.pop()
        if not steps:
            return b"", np.array([end])
        if self.spec.add_dummy_prefix and not self.suffix:
            put(mark, steps[0][0])
        blank_before = self.spec.remove_extra_whitespaces
        for at, taken, made in steps:
            if blank_before and made.startswith(b" "):
                made = made.lstrip(b" ")
            # a kept run of bytes keeps each byte's own place
            exact = len(made) == taken and b" " not in made
            for i, byte in enumerate(made):
                put(mark if byte == 32 else bytes([byte]), at + i if exact else at)
            if self.spec.remove_extra_whitespaces and made:
                blank_before = made.endswith(b" ")
        if self.spec.remove_extra_whitespaces:
            while out.endswith(mark):
                del out[-len(mark):], source[-len(mark):]
        if self.spec.add_dummy_prefix and self.suffix:
            put(mark, end)
        return bytes(out), np.array([*source, end])

    def one(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(ids with the end id, span ends) of one text by the library and ``normalise``."""
        data, source = self.normalise(text)
        ids = self.library.encode(text, num_threads=1)
        sizes = self.sizes[ids] if ids else np.zeros(0, np.int64)
        if self.unknown in ids:
            parts = self.library.encode(text, return_type="proto").pieces
            sizes = np.array([1 if self.library.is_byte(p.id) else len(p.piece.encode()) for p in parts])
        ends = source[np.minimum(np.cumsum(sizes), len(data))] if len(ids) else np.zeros(0, np.int64)
        total = len(text.encode())
        if len(ids):
            ends[-1] = total
        return np.array([*ids, self.end], np.int32), np.append(ends, total)

    def batch(self, column: pa.Array) -> Iterator[tuple[int, list[tuple[np.ndarray, np.ndarray]]]]:
        """(first row, [(ids with the end id, span ends)]) for consecutive parts of a text column."""
        for first, end, data, offsets in text_chunks(column):
            if not self.plain or _MARK in data.tobytes():
                yield first, [self.one(column[i].as_py() or "") for i in range(first, end)]
                continue
            blank = data == 32
            opens = np.zeros(len(data) + 1, bool)
            opens[offsets[:-1][offsets[1:] > offsets[:-1]]] = True
            starts = opens.copy()
            starts[1:-1] |= blank[1:] & ~blank[:-1]
            starts = np.flatnonzero(starts[:-1])
            ends = np.append(starts[1:], len(data))
            inner = starts + ~opens[starts]
            raw = data.tobytes()
            ids, sizes = self.chunks.ids(
                span_hashes(_CODE[data], inner, ends),
                lambda at, a=inner, b=ends, raw=raw: [raw[a[i]:b[i]].decode() for i in at])
            cuts = np.searchsorted(starts, offsets)
            counts = np.append(0, np.cumsum(sizes))[cuts]
            # places of the source bytes in the normalised text: a blank is three bytes, and each text begins with one
            wide = np.append(0, np.cumsum(1 + 2 * blank.astype(np.int64)))
            wide_ends = np.cumsum(self.sizes[ids])
            rows = []
            for k in range(len(offsets) - 1):
                a, b = counts[k], counts[k + 1]
                base = wide_ends[a - 1] if a else 0
                place = np.searchsorted(wide[offsets[k]:offsets[k + 1] + 1] - wide[offsets[k]], wide_ends[a:b] - base - 3)
                total = offsets[k + 1] - offsets[k]
                rows.append((np.append(ids[a:b], np.int32(self.end)), np.append(place, total)))
            yield first, rows


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def encode(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id, ``ids`` with the end id, and ``starts``/``ends``, the byte span of each piece."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, rows in encoder(model).batch(batch.column("text")):
                ints = pa.list_(pa.int32())
                ends = [e.astype(np.int32) for _, e in rows]
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(first, len(rows)), pa.array([i for i, _ in rows], ints),
                    pa.array([np.append(np.int32(0), e[:-1]) for e in ends], ints), pa.array(ends, ints),
                ], ["doc_id", "ids", "starts", "ends"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return texts(docs).mapInArrow(run, f"doc_id {kind}, ids array<int>, starts array<int>, ends array<int>")


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id and ``text`` from doc_id and ``ids``; null ids give the empty text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [encoder(model).library.decode(ids or []) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.string())], ["doc_id", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")


def round_trip(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """Digests of each text's ids and of its decoded text; ``tiled``: the spans tile the text."""
    def sha(data: str) -> str:
        return hashlib.sha256(data.encode()).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = encoder(model)
        for batch in batches:
            for first, rows in one.batch(batch.column("text")):
                lists = [ids.tolist() for ids, _ in rows]
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(first, len(rows)),
                    pa.array([len(x) for x in lists], pa.int64()),
                    pa.array([sha(" ".join(map(one.digits.__getitem__, x))) for x in lists]),
                    pa.array([sha(one.library.decode(x)) for x in lists]),
                    pa.array([bool((np.diff(ends, prepend=0) >= 0).all()) for _, ends in rows]),
                ], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "tiled"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return texts(docs).mapInArrow(run, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string, tiled boolean")

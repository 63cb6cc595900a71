"""MinHash fingerprints and near-duplicate classes.

A text's signature is, for each of several universal hash functions (multiply and add, modulo
2**64), the least value over its word shingles, computed in numpy for many texts at once. Bands of
the signature are joined in Spark: each band's texts with one of them first. Of a band that then still
holds several classes, all texts outside the largest class are compared with all of the band: both
sides are dealt into blocks, and two blocks of whole shingle sets meet in one numpy step that counts
what any two share, so the pairs are never rows of a table. Every link is verified by the Jaccard
similarity of the whole sets, and two texts over the limit that share a band are always in one class.
The work in a band is texts outside times texts; classes over all pairs are ``ngram_join.link``.

Defined cases: a null text counts as empty; texts without words share one signature, which agrees
with no other's, and form no class. Fewer words than a shingle are one shingle. Equal texts have
equal fingerprints. The next document is the next row by doc_id (nulls first), then by a hash of
the text; a table's only row is next to itself. Repeated rows are rows of their own. Further
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mirepoix.llm.common import CHUNK_BYTES, bounded_broadcast, stored, texts
from mirepoix.llm.components import components
from mirepoix.llm.ngram_join import digest, held_sets, ordered, verified
from mirepoix.llm.wordhash import mix, shingle_hashes, unique_sorted, word_hashes

SHINGLE, PERCENT = 5, 80
BANDS, ROWS = 12, 5
# A block of a band's texts: at most about so many texts and shingles.
BLOCK_ROWS, BLOCK_SHINGLES = 1_024, 1 << 20
_COLUMNS = 4_096
HASHES = 64
_FACTORS = mix(np.arange(20_001, 20_001 + HASHES, dtype=np.uint64)) | np.uint64(1)
_TERMS = mix(np.arange(30_001, 30_001 + HASHES, dtype=np.uint64))


def signatures(parts: list[bytes], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(signatures, shingle hashes, cuts): one row of 32-bit values per text, and where its shingles lie."""
    offsets = np.append(0, np.cumsum([len(p) for p in parts]))
    hashes, owner = shingle_hashes(*word_hashes(np.frombuffer(b"".join(parts), np.uint8), offsets), size)
    cuts = np.searchsorted(owner, np.arange(len(offsets)))
    some = np.flatnonzero(np.diff(cuts))
    out = np.full((len(parts), HASHES), 0xFFFFFFFF, np.uint32)
    if len(some):
        work = np.empty_like(hashes)
        for i in range(HASHES):
            np.multiply(hashes, _FACTORS[i], out=work)
            np.add(work, _TERMS[i], out=work)
            out[some, i] = np.minimum.reduceat(work, cuts[some]) >> np.uint64(32)
    return out, hashes, cuts


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as much of the beginning of the next."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


_FIELDS = [("doc_id", None), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("signature", pa.binary()),
           ("edited_signature", pa.binary()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
           ("n", pa.int64()), ("unit", pa.int64()), ("part", pa.int64()), ("first", pa.bool_()), ("held", pa.binary())]


def _rows(docs: list[tuple], following: list[tuple], size: int) -> list[tuple]:
    """Result rows of (doc_id, text) with their next ones."""
    base = [t.encode() for _, t in docs]
    ahead = [t.encode() for _, t in following]
    changed = [edited(t, u).encode() for (_, t), (_, u) in zip(docs, following, strict=True)]
    # a run of documents shares all but one text with its next ones
    run = base[1:] == ahead[:-1]
    own, hashes, cuts = signatures(base + ahead[-1:] if run else base + ahead, size)
    after = own[1:] if run else own[len(base):]
    own = own[:len(base)]
    other = signatures(changed, size)[0]
    out = []
    for i, (doc_id, text) in enumerate(docs):
        held = unique_sorted(hashes[cuts[i]:cuts[i + 1]])
        out.append((doc_id, len(text), hashlib.sha256(changed[i]).hexdigest(), own[i].tobytes(), other[i].tobytes(),
                    float((own[i] == other[i]).mean()), float((own[i] == after[i]).mean()), len(held), digest(held), None, None, None))
    return out


def edited_signatures(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """Stored: per document its signature, that of its edited text, and how they and the next document's agree.

    The table is range-sorted by doc_id once, with packed texts. A range's last document meets the
    next range's first in a second, small step over two rows a range.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {kind}, n_chars bigint, edited_sha256 string, signature binary, edited_signature binary, near_edited double, "
              "near_next double, n bigint, unit bigint, part bigint, first boolean, held binary")

    def batch_of(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) if rows else [()] * len(_FIELDS)
        return pa.RecordBatch.from_arrays([pa.array(c, t or id_type) for c, (_, t) in zip(columns, _FIELDS, strict=True)], [f for f, _ in _FIELDS])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            held = pa.array([tool.compress(t.as_buffer()) for t in batch.column("text").cast(pa.binary())], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), held, batch.column("tie")], ["doc_id", "held", "tie"])

    def unpacked(held: pa.BinaryScalar) -> str:
        return zstandard.ZstdDecompressor().decompress(held.as_buffer()).decode()

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, waiting, weight, id_type, last, first = TaskContext.get().partitionId(), [], 0, None, None, None
        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            for doc_id, held in zip(batch.column("doc_id"), batch.column("held"), strict=True):
                waiting.append((doc_id.as_py(), unpacked(held)))
                last = (doc_id.as_py(), held.as_py())
                first = first or last
                weight += len(waiting[-1][1])
                if weight > CHUNK_BYTES and len(waiting) > 1:
                    yield batch_of(_rows(waiting[:-1], waiting[1:], size), id_type)
                    waiting, weight = waiting[-1:], len(waiting[-1][1])
        if first is None:
            return
        if len(waiting) > 1:
            yield batch_of(_rows(waiting[:-1], waiting[1:], size), id_type)
        none = (None,) * 8
        yield batch_of([(i, *none, part, mark, held) for (i, held), mark in ((first, True), (last, False))], id_type)

    def between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges, id_type = [], None
        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            edges += zip(batch.column("part").to_pylist(), batch.column("first").to_pylist(),
                         batch.column("doc_id").to_pylist(), (unpacked(h) for h in batch.column("held")), strict=True)
        edges.sort(key=lambda e: (e[0], not e[1]))
        heads, lasts = [e[2:] for e in edges if e[1]], [e[2:] for e in edges if not e[1]]
        for doc, following in zip(lasts, heads[1:] + heads[:1], strict=True):
            yield batch_of(_rows([doc], [following], size), id_type)

    packed = texts(docs).withColumn("tie", F.xxhash64("text")).mapInArrow(pack, f"doc_id {kind}, held binary, tie bigint")
    ranged = packed.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "tie")
    done = stored(ranged.select("doc_id", "held").mapInArrow(inside, schema), "signatures")
    rest = stored(done.filter("held IS NOT NULL").repartition(1).mapInArrow(between, schema), "signatures")
    keep = [f for f, _ in _FIELDS if f not in ("part", "first", "held")]
    return done.filter("held IS NULL").select(*keep).unionByName(rest.select(*keep))


def shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many values each two of the sets have in common."""
    out = np.zeros((len(left), len(right)), np.int64)
    common = np.intersect1d(np.concatenate(left), np.concatenate(right))
    sides = []
    for sets in (left, right):
        values, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        known = np.isin(values, common)
        at = np.searchsorted(common, values[known])
        order = np.argsort(at, kind="stable")
        sides.append((at[order], owner[known][order], len(sets)))
    for start in range(0, len(common), _COLUMNS):
        width = min(_COLUMNS, len(common) - start)
        marks = []
        for at, owner, n in sides:
            a, b = np.searchsorted(at, (start, start + width))
            marks.append(np.zeros((n, width), np.float32))
            marks[-1][owner[a:b], at[a:b] - start] = 1
        out += (marks[0] @ marks[1].T).astype(np.int64)
    return out


def _met(left: list[tuple], right: list[tuple], percent: int) -> list[tuple[int, int]]:
    """Of the similar enough (unit, unit) between two blocks of (unit, part, set) so many that they join the same parts as all."""
    if not left or not right:
        return []
    both = shared_counts([x[2] for x in left], [y[2] for y in right])
    n, m = (np.array([len(r[2]) for r in side]) for side in (left, right))
    parts, others = (np.array([r[1] for r in side], np.int64) for side in (left, right))
    close = (100 * both >= percent * (n[:, None] + m[None] - both)) & (parts[:, None] != others[None])
    root: dict[int, int] = {}
    out = []
    for i, j in zip(*np.nonzero(close), strict=True):
        ends = []
        for part in (left[i][1], right[j][1]):
            while (up := root.get(part, part)) != part:
                root[part] = root.get(up, up)
                part = up
            ends.append(part)
        if ends[0] != ends[1]:
            root[ends[0]] = ends[1]
            out.append((min(left[i][0], right[j][0]), max(left[i][0], right[j][0])))
    return out


def _rest(docs: DataFrame, units: DataFrame, placed: DataFrame, size: int, percent: int) -> DataFrame:
    """Stored links (a, b) between the parts of a bucket; ``placed`` has bucket, unit, n, part."""
    def blocks(rows: Column, shingles: Column) -> Column:
        return F.greatest(F.ceil(rows / BLOCK_ROWS), F.ceil(shingles / BLOCK_SHINGLES), F.lit(1)).cast("int")

    sizes = placed.groupBy("bucket", "part").agg(F.count("*").alias("c"), F.sum("n").alias("w"))
    mixed = sizes.groupBy("bucket").agg(
        F.max(F.struct("c", "part", "w")).alias("main"), F.count("*").alias("parts"), F.sum("c").alias("c"), F.sum("w").alias("w")).filter("parts > 1")
    mixed = mixed.select("bucket", F.col("main.part").alias("main"), blocks(F.col("c"), F.col("w")).alias("ours"),
                         blocks(F.col("c") - F.col("main.c"), F.col("w") - F.col("main.w")).alias("theirs"))
    placed = stored(placed.join(bounded_broadcast(stored(mixed, "mixed")), "bucket"), "left")
    held = held_sets(docs, units, placed.select("unit").distinct(), size)

    def one(count: str) -> Column:
        return F.pmod(F.xxhash64(F.lit(11), "unit"), F.col(count)).cast("int")

    def each(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    outside = placed.filter("part <> main").select("unit", "bucket", "part", F.lit(True).alias("outside"), one("theirs").alias("i"), each("ours").alias("j"))
    every = placed.select("unit", "bucket", "part", F.lit(False).alias("outside"), each("theirs").alias("i"), one("ours").alias("j"))
    dealt = outside.unionByName(every).join(held, "unit").repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, sides, found = None, {True: [], False: []}, []
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("bucket", "i", "j", "unit", "part", "outside"))
            for (bucket, i, j, unit, part, side), held in zip(zip(*columns, strict=True), batch.column("held"), strict=True):
                if block != (bucket, i, j):
                    found += _met(sides[True], sides[False], percent)
                    block, sides = (bucket, i, j), {True: [], False: []}
                sides[side].append((unit, part, np.frombuffer(held.as_buffer(), np.uint64)))
            yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], ["a", "b"])
            found = []
        found = _met(sides[True], sides[False], percent)
        yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], ["a", "b"])

    return stored(dealt.mapInArrow(meet, "a bigint, b bigint").distinct(), "links")


def near_duplicates(docs: DataFrame, signed: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(unit, class_id) for the shingle sets of more than one document's class; ``signed`` has doc_id, n, unit, signature.

    class_id is the smallest doc_id that verified links lead to; rows with a null doc_id are compared like others.
    """
    units = signed.filter("n > 0").select("doc_id", "unit")
    bands = F.array(*[F.struct(F.lit(b).alias("band"), F.xxhash64(F.substring("signature", 4 * ROWS * b + 1, 4 * ROWS)).alias("key")) for b in range(BANDS)])
    rows = signed.filter("n > 0").select("unit", "n", F.inline(bands)).select("unit", "n", F.xxhash64("band", "key").alias("bucket"))
    met = rows.groupBy("bucket").agg(F.min("unit").alias("head"), F.max("unit").alias("hi")).filter("head <> hi").select("bucket", "head")
    rows = stored(rows.join(met, "bucket").distinct(), "bands")
    star = verified(docs, units, rows.filter("unit <> head").select(*ordered("unit", "head")).distinct(), size, percent)
    names = bounded_broadcast(components(star))
    placed = rows.join(names, F.col("unit") == F.col("node"), "left").select("bucket", "unit", "n", F.coalesce("component", "unit").alias("part"))
    names = components(star.unionByName(_rest(docs, units, stored(placed, "placed"), size, percent)))
    named = units.join(names, F.col("unit") == F.col("node"), "left").select("doc_id", "unit", F.coalesce("component", "unit").alias("component"))
    named = stored(named.groupBy("unit", "component").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"),
                                                               F.bool_or(F.col("doc_id").isNull()).alias("nameless")), "named")
    least = named.groupBy("component").agg(F.min("least").alias("class_id"), F.max("most").alias("most"), F.bool_or("nameless").alias("nameless"))
    least = least.filter("class_id <> most OR nameless")
    return named.join(least.select("component", "class_id"), "component").select("unit", "class_id")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per document: fingerprints of it and its edited text, their likeness, the next document's, and its near-duplicate class."""
    signed = edited_signatures(docs)
    classes = bounded_broadcast(stored(near_duplicates(docs, signed), "classes"))
    return signed.join(classes, "unit", "left").select(
        "doc_id", "n_chars", "edited_sha256", F.lower(F.hex("signature")).alias("fingerprint"),
        F.lower(F.hex("edited_signature")).alias("edited_fingerprint"), "near_edited", "near_next",
        F.coalesce("class_id", "doc_id").alias("class_id"))

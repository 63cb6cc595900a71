"""Toxicity of texts whose words may be disguised: a noisy-channel decoder and a word scorer.

Words that look disguised - look-alike signs among letters, letters spaced or dotted out, letters
repeated - become lattices: a sign may stand for several letters or for nothing, a repeat for one
letter or two, a gap for a word's end or for nothing. A Viterbi search under a character trigram
model of all texts picks the likeliest reading. The words so restored join the text's own, and a
logistic regression (follow-the-regularised-leader) over words and word beginnings scores the whole.

Only words and beginnings seen mostly in toxic texts enter the model: document frequencies are counted
over a bounded sample of the labelled texts outside the held-out fold, near copies once.

Defined cases: a null text counts as empty; a text without known words gets the bias alone. Rows
without label are scored, never learnt from. Repeated label rows count once, with the larger label.
Without both labels in the sample every score is the share of toxic ones (0 without any label).
Further columns are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mirepoix.llm.common import held_out, text_chunks, texts
from mirepoix.llm.quality import ftrl
from mirepoix.llm.wordhash import mix, powers, shingle_hashes, word_hashes, word_spans

MAX_TRAIN_DOCS = 20_000
MAX_FEATURES = 4_096
MIN_SHARE = 0.7
PREFIXES = (4, 5, 6)
THRESHOLD = 0.5
# Letters that a sign is used for.
LOOK_ALIKES = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l",
}
_RUN = re.compile(r"(?s)((.)\2*)")
_LETTERS = "abcdefghijklmnopqrstuvwxyzßàáâäçèéêëìíîïñòóôöùúûü"
_CODES = {c: i + 1 for i, c in enumerate(_LETTERS)}
_SIZE = 64
_CODE_OF = np.zeros(0x110000, np.uint8)
_CODE_OF[[ord(c) for c in _LETTERS]] = np.arange(1, len(_LETTERS) + 1)
_BYTE = mix(np.arange(11_001, 11_257, dtype=np.uint64))
_IS_LETTER = np.zeros(256, bool)
_IS_LETTER[97:123] = _IS_LETTER[128:] = True
_IS_SIGN = np.zeros(256, bool)
_IS_SIGN[[ord(c) for c in LOOK_ALIKES if ord(c) < 128]] = True


def character_counts(docs: DataFrame) -> np.ndarray:
    """How often each three characters follow one another in all texts; what is no letter is 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_SIZE ** 3, np.int64)
        for batch in batches:
            for _, _, data, _ in text_chunks(batch.column("text")):
                points = np.frombuffer(data.tobytes().decode().lower().encode("utf-32-le"), np.uint32)
                code = np.concatenate([[0, 0], _CODE_OF[points], [0, 0]]).astype(np.int32)
                total += np.bincount((code[:-2] * _SIZE + code[1:-1]) * _SIZE + code[2:], minlength=len(total))
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cells.astype(np.int32)), pa.array(total[cells])], ["cell", "n"])

    out = np.zeros(_SIZE ** 3, np.int64)
    summed = texts(docs).mapInArrow(run, "cell int, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
    for row in summed.collect():  # at most 64**3 rows
        out[row["cell"]] = row["n"]
    return out


class Decoder:
    """The likeliest reading of a disguised piece of text."""

    def __init__(self, counts: np.ndarray):
        three = counts.reshape(_SIZE, _SIZE, _SIZE).astype(np.float64)
        two, one = three.sum(0), three.sum((0, 1)) + 0.5
        p1 = one / one.sum()
        p2 = (two + 4 * p1[None]) / (two.sum(1, keepdims=True) + 4)
        p3 = (three + 2 * p2[None]) / (three.sum(2, keepdims=True) + 2)
        self.cost = (-np.log(p3)).tolist()
        self.read = lru_cache(100_000)(self._read)

    def _read(self, piece: str) -> str:
        beams = {(0, 0): (0.0, "")}
        before = ""
        runs = [len(m) for m, _ in _RUN.findall(piece) for _ in m]
        # signs at the end may be no more than emphasis
        body = len(piece.rstrip("".join(LOOK_ALIKES)))
        for place, (c, alike) in enumerate(zip(piece, runs, strict=True)):
            arcs: list[tuple[str, float]] = []
            if c in _CODES:
                arcs.append((c, 0.0))
            arcs += [(x, 0.4) for x in LOOK_ALIKES.get(c, "")]
            if c == before and (c in _CODES or c in LOOK_ALIKES):
                arcs.append(("", 0.1 if alike > 2 else 1.5))
            elif c.isspace():
                arcs += [("", 0.1), (" ", 1.5)]
            elif c not in _CODES:
                arcs += [(" ", 7.0 if place < body else 4.0)] if c in LOOK_ALIKES else [("", 1.0), (" ", 3.0)]
            after: dict[tuple[int, int], tuple[float, str]] = {}
            for (u, v), (cost, text) in beams.items():
                for x, step in arcs:
                    if not x:
                        key, total, made = (u, v), cost + step, text
                    else:
                        w = _CODES.get(x, 0)
                        key, total, made = (v, w), cost + step + self.cost[u][v][w], text + x
                    if key not in after or total < after[key][0]:
                        after[key] = (total, made)
            beams, before = after, c
        return min((cost + self.cost[u][v][0], text) for (u, v), (cost, text) in beams.items())[1]


def _lone(core: np.ndarray, lead: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The first byte of every letter or sign that stands alone between other marks or the edges of its word."""
    opens = np.zeros(len(core) + 1, bool)
    opens[starts] = True
    first = np.flatnonzero(core & (~np.append(False, core[:-1]) | opens[:-1]))
    last = np.flatnonzero(core & (~np.append(core[1:], False) | opens[1:])) + 1
    out = np.zeros(len(core), bool)
    out[first[lead[last] - lead[first] == 1]] = True
    return out


def disguised(data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int]]:
    """(text, start, end) of the pieces of lower-case texts that the lattice can read in another way.

    These are words of letters and signs, with a letter three times in a row or two doubled ones, or with three
    letters or signs alone between other marks; and three or more words of one letter or sign each.
    """
    starts, ends, owner = word_spans(data, offsets)
    if not len(starts):
        return []
    letter, sign = _IS_LETTER[data], _IS_SIGN[data]

    def held(flags: np.ndarray) -> np.ndarray:
        seen = np.append(0, np.cumsum(flags))
        return seen[ends] - seen[starts]

    lead = np.append(0, np.cumsum((data & 0xC0) != 0x80))
    # a doubled letter is noted at its second place, as no word ends between the two
    alike = np.append(False, (data[1:] == data[:-1]) & letter[1:] & (data[1:] < 128))
    alike[starts] = False
    doubled = alike & ~np.append(False, alike[:-1])
    letters, signs = held(letter), held(sign)
    lone = held(_lone(letter | sign, lead, starts))
    odd = (letters > 0) & ((signs > 0) | (held(alike) > held(doubled)) | (held(doubled) > 1) | (lone > 2))
    out = [(int(owner[i]), int(starts[i]), int(ends[i])) for i in np.flatnonzero(odd)]
    # spaced-out letters: at least three words of one character each, not all the same
    single = (lead[ends] - lead[starts] == 1) & (letters + signs > 0)
    edge = np.flatnonzero(np.diff(np.concatenate([[0], single & True, [0]]).astype(np.int8)))
    for a, b in zip(edge[::2], edge[1::2], strict=True):
        for k in range(owner[a], owner[b - 1] + 1):
            i, j = max(a, int(np.searchsorted(owner, k))), min(b, int(np.searchsorted(owner, k, "right")))
            if j - i >= 3 and len({bytes(data[starts[x]:ends[x]]) for x in range(i, j)}) > 2:
                out.append((k, int(starts[i]), int(ends[j - 1])))
    return out


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Hashes of the words and of their beginnings (0 where a word is not longer than that)."""
    up, down = powers(len(data) + 1)
    sums = np.append(np.uint64(0), np.cumsum(_BYTE[data] * up[:len(data)]))
    out = [mix((sums[ends] - sums[starts]) * down[starts])]
    for n in PREFIXES:
        cut = np.minimum(starts + n, ends)
        part = mix((sums[cut] - sums[starts]) * down[starts] + np.uint64(n))
        out.append(np.where(ends - starts > n, part, np.uint64(0)))
    return out


def features(column: pa.Array, decoder: Decoder | None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, hashes, text numbers) of the words and beginnings of the texts and of their restored words."""
    for first, end, data, offsets in text_chunks(column):
        lowered = [data[a:b].tobytes().decode().lower().encode() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        offsets = np.append(0, np.cumsum([len(x) for x in lowered]))
        data = np.frombuffer(b"".join(lowered), np.uint8)
        found = []
        for extra in (False, True):
            if extra:
                if decoder is None:
                    break
                odd = disguised(data, offsets)
                read = [decoder.read(data[a:b].tobytes().decode()).encode() + b" " for _, a, b in odd]
                places = np.append(0, np.cumsum([len(r) for r in read]))
                owners, bytes_ = np.array([k for k, _, _ in odd], np.int64), np.frombuffer(b"".join(read), np.uint8)
                if not read:
                    break
            else:
                places, owners, bytes_ = offsets, np.arange(len(lowered)), data
            letter = np.concatenate([[False], _IS_LETTER[bytes_], [False]])
            breaks = np.zeros(len(letter), bool)
            breaks[places] = True
            starts = np.flatnonzero(letter[1:-1] & (~letter[:-2] | breaks[:-2]))
            ends = np.flatnonzero(letter[1:-1] & (~letter[2:] | breaks[1:-1])) + 1
            owner = owners[np.searchsorted(places, starts, "right") - 1]
            for h in _hashes(bytes_, starts, ends):
                found.append((h[h != 0], owner[h != 0]))
        yield first, end, np.concatenate([h for h, _ in found]), np.concatenate([o for _, o in found])


class Model:
    """Known features (sorted hashes), their weights and the bias."""

    def __init__(self, known: np.ndarray, weights: np.ndarray, bias: float):
        self.known, self.weights, self.bias = known, weights, bias
        self.gate = np.zeros(1 << 20, bool)
        self.gate[(known >> np.uint64(44)).astype(np.int64)] = True

    def rows(self, hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(text number, feature number) of the known features, each once a text."""
        maybe = self.gate[(hashes >> np.uint64(44)).astype(np.int64)]
        hashes, owner = hashes[maybe], owner[maybe]
        if not len(self.known) or not len(hashes):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)
        hit = self.known[at] == hashes
        pairs = np.unique(owner[hit] * len(self.known) + at[hit])
        return pairs // len(self.known), pairs % len(self.known)


def sample(docs: DataFrame, labels: DataFrame, label: str, limit: int) -> DataFrame:
    """doc_id, text and label of at most ``limit`` labelled documents outside the held-out fold, picked by a hash of doc_id."""
    known = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    known = known.filter(~held_out("doc_id")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    return texts(docs).join(F.broadcast(known), "doc_id")


def fit(docs: DataFrame, labels: DataFrame, decoder: Decoder, label: str = "toxic", limit: int = MAX_TRAIN_DOCS) -> Model:
    """The model from the labelled sample; what comes to the driver is at most ``MAX_FEATURES`` hashes and weights."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(decoder.cost)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in text_chunks(batch.column("text")):
                hashes, owner = shingle_hashes(*word_hashes(data, offsets), 5)
                least = np.zeros(b - a, np.int64)
                cuts = np.searchsorted(owner, np.arange(b - a + 1))
                some = np.flatnonzero(np.diff(cuts))
                if len(some):
                    least[some] = np.minimum.reduceat(hashes, cuts[some]).view(np.int64)
                yield pa.RecordBatch.from_arrays([*(c.slice(a, b - a) for c in batch.columns), pa.array(least)], ["doc_id", "text", "label", "least"])

    chosen = sample(docs, labels, label, limit).select("doc_id", "text", "label")
    chosen = chosen.mapInArrow(key, f"doc_id {kind}, text string, label int, least bigint").dropDuplicates(["least", "label"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = _restored(shared.value)
        for batch in batches:
            y = batch.column("label").to_numpy()
            for a, _, hashes, owner in features(batch.column("text"), decoder):
                rows = np.unique(np.stack([hashes, owner.astype(np.uint64)]), axis=1)
                hashes, toxic = rows[0], y[a + rows[1].astype(np.int64)]
                found, inverse = np.unique(hashes, return_inverse=True)
                n, t = np.bincount(inverse, minlength=len(found)), np.bincount(inverse, weights=toxic, minlength=len(found))
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n), pa.array(t.astype(np.int64))], ["feature", "n", "toxic"])

    totals = chosen.groupBy("label").count().collect()
    size = {r["label"]: r["count"] for r in totals}
    toxic, every = size.get(1, 0), sum(size.values())
    if not toxic or toxic == every:
        share = toxic / every if every else 0.0
        return Model(np.zeros(0, np.uint64), np.zeros(0), math.log(max(share, 1e-6) / max(1 - share, 1e-6)))
    sums = chosen.mapInArrow(counted, "feature bigint, n bigint, toxic bigint").groupBy("feature").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))
    least = max(3, round(0.004 * toxic))
    best = sums.filter((F.col("toxic") >= least) & (F.col("toxic") >= MIN_SHARE * F.col("n")))
    best = best.orderBy(F.desc("toxic"), "feature").limit(MAX_FEATURES).select("feature").toPandas()["feature"].to_numpy(np.int64)
    known = np.sort(best.view(np.uint64))
    model = Model(known, np.zeros(len(known)), 0.0)
    packed = spark.sparkContext.broadcast(known)

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder, model = _restored(shared.value), Model(packed.value, np.zeros(len(packed.value)), 0.0)
        for batch in batches:
            for a, b, hashes, owner in features(batch.column("text"), decoder):
                row, at = model.rows(hashes, owner)
                cuts = np.searchsorted(row, np.arange(b - a + 1))
                yield pa.RecordBatch.from_arrays([
                    batch.column("least").slice(a, b - a), batch.column("label").slice(a, b - a),
                    pa.array([at[i:j].astype(np.int32) for i, j in zip(cuts[:-1], cuts[1:], strict=True)], pa.list_(pa.int32())),
                ], ["least", "label", "at"])

    # rows of a few numbers each, at most ``limit`` of them
    rows = chosen.mapInArrow(seen, "least bigint, label int, at array<int>").toPandas().sort_values(["least", "label"])
    rows = [(np.append(0, np.asarray(r.places, np.int64) + 1), np.ones(len(r.places) + 1), int(r.label)) for r in rows.rename(columns={"at": "places"}).itertuples()]
    weights = ftrl(rows, bits=13)
    return Model(known, weights[1:len(known) + 1], float(weights[0]))


_decoders: dict[int, Decoder] = {}


def _restored(cost: list) -> Decoder:
    """One decoder per worker and table."""
    if id(cost) not in _decoders:
        _decoders.clear()
        made = Decoder.__new__(Decoder)
        made.cost = cost
        made.read = lru_cache(100_000)(made._read)
        _decoders[id(cost)] = made
    return _decoders[id(cost)]


def score(docs: DataFrame, model: Model, decoder: Decoder) -> DataFrame:
    """doc_id, held_out and ``score``, the probability that the text is toxic."""
    shared = docs.sparkSession.sparkContext.broadcast((model, decoder.cost))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, cost = shared.value
        decoder = _restored(cost)
        for batch in batches:
            for a, b, hashes, owner in features(batch.column("text"), decoder):
                row, at = model.rows(hashes, owner)
                logit = np.bincount(row, weights=model.weights[at], minlength=b - a) + model.bias
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), pa.array(1 / (1 + np.exp(-np.clip(logit, -35, 35))))], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = texts(docs).mapInArrow(run, f"doc_id {kind}, score double")
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Scores of all documents, and ``predicted``."""
    decoder = Decoder(character_counts(docs))
    scored = score(docs, fit(docs, labels, decoder), decoder)
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))

"""Quality classifier: hashed word n-grams, logistic regression, FTRL-proximal updates.

Words are runs other than blanks; each gives itself and its form (letters as ``a`` or
``A``, digits as ``0``, repeats once), and neighbouring words give pairs of both. A
feature's value is its share of the text's features, damped by a square root, so a
text is a sparse unit vector and its score one sparse dot product.

Defined cases: a null text counts as empty; an empty text is scored by the bias
alone. A row without label is scored but never learnt from, nor is one of the
held-out fold (crc32 of doc_id modulo 5 is 0). Repeated label rows of a document
count once, with the larger label. Without any label every score is 0.5. Further
columns of the inputs are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mirepoix.llm.common import held_out, text_chunks, texts
from mirepoix.llm.wordhash import mix, powers, span_hashes, word_spans

BITS = 18
MAX_TRAIN_DOCS = 6_000
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.0005, 0.0005
THRESHOLD = 0.3

_FORM = np.arange(256, dtype=np.uint8)
_FORM[97:123] = 97
_FORM[65:91] = 65
_FORM[48:58] = 48
_FORM[128:] = 97
_RAW = mix(np.arange(5001, 5257, dtype=np.uint64))
_SHAPE = mix(np.arange(7001, 7257, dtype=np.uint64))


def features(data: np.ndarray, offsets: np.ndarray, bits: int = BITS) -> list[tuple[np.ndarray, np.ndarray]]:
    """(indices, values) of each text; index 0 is the bias."""
    starts, ends, owner = word_spans(data, offsets)
    words = span_hashes(_RAW[data], starts, ends)
    form = _FORM[data]
    turn = np.ones(len(data), bool)
    turn[1:] = form[1:] != form[:-1]
    turn[starts] = True
    place = np.zeros(len(data) + 1, np.int64)
    np.cumsum(turn, out=place[1:])
    shapes = span_hashes(_SHAPE[form[turn]], place[starts], place[ends])
    last = np.ones(len(owner), bool)
    last[:-1] = owner[1:] != owner[:-1]
    first = np.ones(len(owner), bool)
    first[1:] = last[:-1]
    pairs = []
    for of, salt in ((words, 3), (shapes, 5)):
        before, after = of[:-1][~last[:-1]], of[1:][~first[1:]]
        pairs.append(mix(before * np.uint64(salt) + after))
        # a word that stands beside itself
    again = (words[:-1] == words[1:])[~last[:-1]]
    pair_owner = owner[:-1][~last[:-1]]
    hashed = np.concatenate([words, shapes, *pairs, np.full(int(again.sum()), mix(np.array([77], np.uint64))[0])])
    owners = np.concatenate([owner, owner, pair_owner, pair_owner, pair_owner[again]])
    index = (hashed >> np.uint64(64 - bits)).astype(np.int64)
    keys, counts = np.unique((owners << bits) | index, return_counts=True)
    cuts = np.searchsorted(keys, np.arange(len(offsets)) << bits)
    out = []
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        at, n = keys[a:b] & ((1 << bits) - 1), counts[a:b].astype(np.float64)
        value = np.sqrt(n / n.sum()) if b > a else n
        keep = at != 0
        out.append((np.concatenate([[0], at[keep]]), np.concatenate([[1.0], value[keep]])))
    return out


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], bits: int = BITS, epochs: int = EPOCHS) -> np.ndarray:
    """Weights from (indices, values, label) rows by follow-the-regularised-leader updates, in the given order."""
    z, n = np.zeros(1 << bits), np.zeros(1 << bits)

    def weights(at: np.ndarray | slice) -> np.ndarray:
        za = z[at]
        shrunk = np.sign(za) * np.maximum(np.abs(za) - L1, 0)
        return -shrunk / ((BETA + np.sqrt(n[at])) / ALPHA + L2)

    for _ in range(epochs):
        for at, value, label in rows:
            w = weights(at)
            slope = (1 / (1 + np.exp(-np.clip(w @ value, -35, 35))) - label) * value
            step = (np.sqrt(n[at] + slope * slope) - np.sqrt(n[at])) / ALPHA
            z[at] += slope - step * w
            n[at] += slope * slope
    return weights(slice(None))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", limit: int = MAX_TRAIN_DOCS) -> np.ndarray:
    """Weights from at most ``limit`` labelled documents outside the held-out fold, chosen and ordered by a hash of doc_id.

    Their sparse rows, bounded in number by ``limit``, meet in one task, as the updates follow one another.
    """
    known = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    known = known.filter(~held_out("doc_id")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    found = texts(docs).join(F.broadcast(known), "doc_id").select("doc_id", "label", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in text_chunks(batch.column("text")):
                rows = features(data, offsets)
                yield pa.RecordBatch.from_arrays([
                    *(batch.column(c).slice(a, b - a) for c in ("doc_id", "label")),
                    pa.array([r[0].astype(np.int32) for r in rows], pa.list_(pa.int32())),
                    pa.array([r[1].astype(np.float32) for r in rows], pa.list_(pa.float32())),
                ], ["doc_id", "label", "at", "value"])

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = {}
        for batch in batches:
            for turn, i, label, at, value in zip(*(batch.column(c) for c in ("turn", "doc_id", "label", "at", "value")), strict=True):
                rows[turn.as_py(), i.as_py()] = (at.values.to_numpy(), value.values.to_numpy(), label.as_py())
        weights = ftrl([rows[k] for k in sorted(rows)]).astype(np.float32)
        yield pa.RecordBatch.from_arrays([pa.array([weights], pa.list_(pa.float32()))], ["weights"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    table = found.mapInArrow(run, f"doc_id {kind}, label int, at array<int>, value array<float>")
    table = table.withColumn("turn", F.xxhash64("doc_id")).repartition(1).mapInArrow(train, "weights array<float>")
    return np.array(table.first()["weights"], np.float32)


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """doc_id, held_out and ``score``, the probability of label 1."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value.astype(np.float64)
        for batch in batches:
            for a, b, data, offsets in text_chunks(batch.column("text")):
                logits = np.array([w[at] @ value for at, value in features(data, offsets)])
                out = 1 / (1 + np.exp(-np.clip(logits, -35, 35)))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), pa.array(out)], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = texts(docs).mapInArrow(run, f"doc_id {kind}, score double")
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Scores of all documents by weights fitted on the labelled ones, and ``predicted``."""
    scored = score(docs, fit(docs, labels))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows whose text scores at least ``threshold``, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))

    @F.pandas_udf("double")
    def scored(text: pd.Series) -> pd.Series:
        w, out = shared.value.astype(np.float64), []
        for _, _, data, offsets in text_chunks(pa.array(text, pa.string(), from_pandas=True)):
            out += [float(w[at] @ value) for at, value in features(data, offsets)]
        return pd.Series(1 / (1 + np.exp(-np.clip(np.array(out, np.float64), -35, 35))))

    return docs.filter(scored(F.col("text").cast("string")) >= threshold)

"""Quality rules by tokeniser fertility: how public vocabularies cut a text, held against its language's bands.

A text that a vocabulary was not made for falls into many short pieces. Of every text are measured,
with a vocabulary that has byte fallback: characters per token, the share of tokens that are single
bytes, and the entropy of the tokens; with a byte-level one: characters per token again. A text is
kept if every measure lies in the band of its language (without one, of its most frequent script).

Bands come from all texts that pass the base rules: the outer fences of the quartiles, per language
and length class (words, by powers of two), as short texts scatter more. Texts of equal measures
count once, and a spread counts as at least what sampling of that many words gives, so a group of copies,
however large, can neither narrow nor move a band much. Quartiles are exact on a fixed grid: the
counts per grid cell are a small table, whatever the corpus. A class with few texts takes the band
of its language, a language with few texts has none and rejects nothing.

Defined cases: a null or empty text has no words and fails the base rules. A null or empty lang is
replaced by the script, ``none`` for a text without letters. Repeated rows give repeated results; a
null doc_id is kept as such. Further columns are not read.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mirepoix.llm import packing, pieces
from mirepoix.llm.common import bounded_broadcast, stored, text_chunks
from mirepoix.llm.wordcodes import following, run_keys, word_codes
from mirepoix.llm.wordhash import WHITE, word_spans

LEAST_WORDS, MOST_REPEATED = 50, 50
SYMBOLS = b"#*$%&|<>"
# Quartile distances between a quartile and its fence; texts that make a band of their own.
SPAN, LEAST_TEXTS = 2.5, 100
# Measure: grid step, quartile distance times the root of the words that sampling alone gives, tested below, above.
MEASURES = {
    "chars_per_token": (0.005, 0.8, True, True),
    "byte_share": (0.0005, 0.07, False, True),
    "token_entropy": (0.01, 1.6, True, False),
    "chars_per_byte_token": (0.005, 0.8, True, True),
}
_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return np.diff(sums[offsets])


def base_counts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``_COUNTS`` for each text, and its code points."""
    texts = len(offsets) - 1
    starts, ends, owner = word_spans(data, offsets)
    inside = ~WHITE[data]
    opens = (data & 0xC0) != 0x80
    raw, dup = data.tobytes(), np.zeros(texts, np.int64)
    for k in range(texts):
        lines = [line for line in raw[offsets[k]:offsets[k + 1]].split(b"\n") if line.strip()]
        dup[k] = len(lines) - len(set(lines))
    repeat = np.zeros(texts, np.int64)
    if len(starts):
        columns = following(word_codes(data, inside, starts, ends)[0], owner, 3)
        whole = np.flatnonzero(columns[2] >= 0) if len(starts) > 2 else np.zeros(0, np.int64)
        _, which, n = np.unique(run_keys(np.vstack([owner[whole], columns[:, whole]])), return_inverse=True, return_counts=True)
        again = whole[n[which] > 1]
        covered = np.zeros(len(starts), bool)
        for j in range(3):
            covered[again + j] = True
        repeat = np.bincount(owner[covered], minlength=texts)
    return np.array([
        np.bincount(owner, minlength=texts), _per_text(opens & inside, offsets),
        _per_text(_SYMBOL[data], offsets), dup, repeat]), _per_text(opens, offsets)


def entropies(ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Bits per token of each text's ids."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    keys, n = np.unique(run_keys(np.vstack([owner, ids])), return_counts=True)
    first = np.searchsorted(keys, run_keys(np.vstack([owner, ids])))
    weight = np.zeros(len(keys))
    weight[first] = owner
    sums = np.bincount(weight.astype(np.int64), n * np.log2(n), minlength=len(sizes)) if len(ids) else np.zeros(len(sizes))
    total = np.maximum(sizes, 1)
    return np.maximum(np.log2(total) - sums / total, 0.0)


def script(text: str) -> str:
    """The script of most of a text's letters, by their names; of equally frequent ones the first."""
    found: Counter[str] = Counter()
    for letter, n in Counter(text).items():
        if letter.isalpha():
            found[unicodedata.name(letter, "other").split()[0].lower()] += n
    return min(found, key=lambda s: (-found[s], s)) if found else "none"


def measured(docs: DataFrame, pieces_model: str = pieces.MODEL, bytes_model: str = packing.VOCABULARY) -> DataFrame:
    """Stored rows, one per document: doc_id, the base counts, ``base_failed``, n_tokens, the measures, ``band``, ``size_class``."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.col("lang").cast("string").alias("lang"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = pieces.encoder(pieces_model), packing.byte_tokens(bytes_model)
        is_byte = np.array([one.library.is_byte(i) for i in range(one.library.get_piece_size())])
        for batch in batches:
            texts, langs = batch.column("text"), batch.column("lang").to_pylist()
            # all three walk the column in the same parts
            parts = zip(text_chunks(texts), one.batch(texts), two.batch(texts), strict=True)
            for (first, end, data, offsets), (_, encoded), (_, byte_ids) in parts:
                counts, chars = base_counts(data, offsets)
                sizes = np.array([len(ids) - 1 for ids, _ in encoded])
                ids = np.concatenate([ids[:-1] for ids, _ in encoded]).astype(np.int64)
                owner = np.repeat(np.arange(len(sizes)), sizes)
                single = np.bincount(owner, is_byte[ids], minlength=len(sizes))
                tokens, byte_tokens = np.maximum(sizes, 1), np.maximum([len(x) for x in byte_ids], 1)
                failed = (counts[0] < LEAST_WORDS) | (100 * counts[4] > MOST_REPEATED * counts[0])
                bands = [lang or script(texts[first + k].as_py()) for k, lang in enumerate(langs[first:end])]
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(first, end - first), *(pa.array(c, pa.int64()) for c in counts), pa.array(failed),
                    pa.array(sizes, pa.int64()), pa.array(chars / tokens), pa.array(single / tokens),
                    pa.array(entropies(ids, sizes)), pa.array(chars / byte_tokens), pa.array(bands, pa.string()),
                    pa.array(np.floor(np.log2(np.maximum(counts[0], 1))), pa.float64()).cast(pa.int32()),
                ], ["doc_id", *_COUNTS, "base_failed", "n_tokens", *MEASURES, "band", "size_class"])

    columns = [f"doc_id {kind}", *(f"{c} bigint" for c in _COUNTS), "base_failed boolean", "n_tokens bigint",
               *(f"{m} double" for m in MEASURES), "band string", "size_class int"]
    return stored(rows.mapInArrow(run, ", ".join(columns)), "measured")


def _named(expressions: dict[str, Column]) -> list[Column]:
    return [e.alias(name) for name, e in expressions.items()]


def bands(rows: DataFrame, span: float = SPAN, least_texts: int = LEAST_TEXTS) -> DataFrame:
    """Stored rows (band, size_class, <measure>_low, <measure>_high); size_class -1 is all of a language."""
    passed = rows.filter("NOT base_failed").select("band", "size_class", *MEASURES).distinct()
    cells = F.array(*[
        F.struct(F.lit(m).alias("measure"), F.floor(F.col(m) / F.lit(step)).alias("cell")) for m, (step, *_) in MEASURES.items()])
    key = ["band", "size_class", "measure"]
    counts = passed.select("band", "size_class", F.inline(cells)).groupBy(*key, "cell").agg(F.count("*").alias("n"))
    counts = stored(counts, "cells")
    every = counts.groupBy("band", "measure", "cell").agg(F.sum("n").alias("n")).withColumn("size_class", F.lit(-1))
    whole = Window.partitionBy(*key)
    placed = counts.unionByName(every).withColumns({
        "upto": F.sum("n").over(whole.orderBy("cell")), "total": F.sum("n").over(whole)})
    found = placed.filter(F.col("total") >= least_texts).groupBy(*key).agg(
        F.min(F.when(4 * F.col("upto") >= F.col("total"), F.col("cell"))).alias("q1"),
        F.min(F.when(4 * F.col("upto") >= 3 * F.col("total"), F.col("cell"))).alias("q3"))
    words = F.pow(F.lit(2.0), F.when(F.col("size_class") < 0, F.lit(float(np.floor(np.log2(LEAST_WORDS))))).otherwise(F.col("size_class")))
    limits = {}
    for m, (step, noise, below, above) in MEASURES.items():
        width = span * F.greatest((F.col("q3") - F.col("q1")) * F.lit(step), F.lit(noise) / F.sqrt(words))
        here = F.col("measure") == m
        limits[f"{m}_low"] = F.max(F.when(here & F.lit(below), F.col("q1") * F.lit(step) - width))
        limits[f"{m}_high"] = F.max(F.when(here & F.lit(above), (F.col("q3") + 1) * F.lit(step) + width))
    return stored(found.groupBy("band", "size_class").agg(*_named(limits)), "bands")


def judge(docs: DataFrame, pieces_model: str = pieces.MODEL, bytes_model: str = packing.VOCABULARY,
          span: float = SPAN, least_texts: int = LEAST_TEXTS) -> DataFrame:
    """One row per document: the base counts, ``base_failed``, ``kept``, the measures and ``failed``, the measures out of band."""
    rows = measured(docs, pieces_model, bytes_model)
    limits = bounded_broadcast(bands(rows, span, least_texts))
    names = [f"{m}_{side}" for m in MEASURES for side in ("low", "high")]
    own = limits.select("band", "size_class", F.lit(True).alias("own"), *names)
    wide = limits.filter("size_class = -1").select("band", *(F.col(c).alias(f"wide_{c}") for c in names))
    placed = rows.join(own, ["band", "size_class"], "left").join(wide, "band", "left")
    limit = {c: F.when(F.col("own"), F.col(c)).otherwise(F.col(f"wide_{c}")) for c in names}
    out = F.array_compact(F.array(*[
        F.when((F.col(m) < limit[f"{m}_low"]) | (F.col(m) > limit[f"{m}_high"]), F.lit(m)) for m in MEASURES]))
    judged = placed.withColumn("failed", out)
    return judged.select(
        "doc_id", *_COUNTS, "base_failed", (~F.col("base_failed") & (F.size("failed") == 0)).alias("kept"),
        "n_tokens", *MEASURES, "band", "failed")

"""Correct words against a table of terms: the most similar term, if it is similar enough.

Similarity is that of ``units.correct_term``: letters put in and taken out over the letters of both.
Words and terms are packed into blocks of one length, a text of its own, and a block of words meets one after the other
the blocks of terms whose length allows a similar one: what is listed of each text to find the pairs
that are alike (``functions.near``) never becomes a row. No list of terms is brought together, neither
on the driver nor in a plan, and nothing is broadcast by hint.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mirepoix.functions import near
from mirepoix.session import store

# Texts of one length that are kept together in a block, and letters of a block.
TOGETHER, LETTERS = 100_000, 1 << 20
# Ways to drop letters from a text up to which all of them are listed; with more, it is cut into pieces.
WAYS = 10_000
# Hashes that are looked up in one step of a task.
CELLS = 1 << 18
_WORD, _TERM = "_word", "_term"
_FOUND = f"{_WORD} string, {_TERM} string, edits bigint"


def _alike_lengths(words: DataFrame, terms: DataFrame, percent: int) -> DataFrame:
    """``(n, m)``: lengths of words beside lengths of terms of which some may be similar."""
    # |n - m| edits are the fewest there are: 100 * (n - m) < percent * (n + m)
    n, m = F.col("n"), F.col("m")
    least = F.floor(n * (100 - percent) / (100.0 + percent)).cast("int")
    most = F.ceil(n * (100 + percent) / (100.0 - percent)).cast("int")
    own = words.select(F.length(_WORD).alias("n")).distinct()
    each = own.withColumn("m", F.explode(F.sequence(F.greatest(F.lit(1), least), F.greatest(F.lit(1), most))))
    return each.filter(F.abs(n - m) * 100 < (n + m) * percent).join(
        terms.select(F.length(_TERM).alias("m")).distinct(), "m", "left_semi")


def _keyed(df: DataFrame, text: str, own: str, lengths: DataFrame, percent: int) -> DataFrame:
    """``(key, text)`` of all that is listed of each text, for partners of every length there is."""
    ways, word = WAYS, own == "n"

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text).to_pylist()
            sizes = np.stack([batch.column(c).to_numpy() for c in ("n", "m")], axis=1)
            for n, m in np.unique(sizes, axis=0).tolist():
                rows = np.flatnonzero((sizes == (n, m)).all(axis=1))
                by = near.level(n, m, near.most_edits(n, m, percent), ways)
                found = near.keys(near.Texts("".join(texts[i] for i in rows), n if word else m).letters, by, word)
                keys = (found + np.uint64(near.salt(n, m))).ravel().view(np.int64)
                whole = batch.column(text).take(pa.array(np.tile(rows, len(found))))
                yield pa.RecordBatch.from_arrays([pa.array(keys), whole], ["key", text])

    sized = df.select(text, F.length(text).alias(own)).join(lengths, own)
    return sized.mapInArrow(listed, f"key bigint, {text} string")


def _entries(terms: DataFrame, words: DataFrame, percent: int) -> DataFrame:
    """What may be left of every term, or every piece of it, per length of the word: ``(key, term)``."""
    return _keyed(terms, _TERM, "m", _alike_lengths(words, terms, percent), percent)


def _lookups(words: DataFrame, terms: DataFrame, percent: int) -> DataFrame:
    """What may be left of a word, or every piece it may share, per length of the term: ``(key, word)``."""
    return _keyed(words, _WORD, "n", _alike_lengths(words, terms, percent), percent)


def _parts(df: DataFrame, text: str, together: int) -> Callable[[Column], Column]:
    """Into how many blocks the texts of a length go. Only lengths of more than one block come to the driver."""
    size = F.length(text)
    most = F.least(F.lit(together), F.greatest(F.lit(1), F.floor(F.lit(LETTERS) / F.col("size"))))
    often = df.groupBy(size.alias("size")).count().select("size", F.ceil(F.col("count") / most).cast("int").alias("parts"))
    many = often.filter("parts > 1").collect()
    return lambda length: F.coalesce(*[F.when(length == r["size"], F.lit(r["parts"])) for r in many], F.lit(1))


def _blocks(df: DataFrame, text: str, parts: Callable[[Column], Column]) -> DataFrame:
    """``(size, block, texts)``: texts of one length in order, one behind the other."""
    block = F.pmod(F.xxhash64(text), parts(F.length(text))).cast("int")
    grouped = df.groupBy(F.length(text).alias("size"), block.alias("block"))
    return grouped.agg(F.array_join(F.sort_array(F.collect_list(text)), "").alias("texts"))


def _rows(word: list[str], term: list[str], edits: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(word, pa.string()), pa.array(term, pa.string()), pa.array(edits, pa.int64())], [_WORD, _TERM, "edits"])


def _compared(percent: int, nearest: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Takes each block of words, then the blocks of terms that it meets; gives the pairs that are alike."""
    ways, cells = WAYS, CELLS

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = best = None
        for batch in batches:
            for n, m, texts in zip(*(batch.column(c) for c in ("n", "m", "texts"))):
                if m.as_py() == 0:
                    if best:
                        yield _rows(*best.found())
                    words = near.Texts(texts.as_py(), n.as_py())
                    best = near.Nearest(words, percent, ways, cells) if nearest else None
                    continue
                terms = near.Texts(texts.as_py(), m.as_py())
                if best:
                    best.see(terms)
                    continue
                for word, term, edits in near.pairs(words, terms, percent, ways, cells):
                    yield _rows(words.at(word), terms.at(term), edits)
        if best:
            yield _rows(*best.found())

    return compared


def similar_terms(
    words: DataFrame, terms: DataFrame, percent: int = 20, together: int = TOGETHER, nearest: bool = False
) -> DataFrame:
    """All pairs of ``(_word, _term)`` with 100 * edits < ``percent`` * letters of both, each once, with ``edits``.

    With ``nearest`` only the pair of each word that has the least share of edits, the first term by name on a tie.
    Both inputs hold distinct, non-empty texts in a column of that name. ``percent`` is 1 to 99.
    At most about ``together`` texts of one length are kept together; more are spread over tasks.
    """
    if not 0 < percent < 100:
        raise ValueError(f"percent is {percent}, not within 1 to 99")
    words, terms = store(words, "words"), store(terms, "terms")
    word_parts, term_parts = _parts(words, _WORD, together), _parts(terms, _TERM, together)
    asked = _blocks(words, _WORD, word_parts).select(
        F.col("size").alias("n"), "block", F.lit(0).alias("m"), F.lit(0).alias("turn"), "texts")
    listed = _blocks(terms, _TERM, term_parts).select(F.col("size").alias("m"), F.col("block").alias("turn"), "texts")
    beside = listed.join(_alike_lengths(words, terms, percent), "m")
    each = beside.withColumn("block", F.explode(F.sequence(F.lit(0), word_parts(F.col("n")) - 1)))
    tasks = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = asked.unionByName(each.select(*asked.columns)).repartition(tasks, "n", "block")
    # the words, then terms by how far their length lies off: near ones spare most lookups
    away = F.when(F.col("m") == 0, F.lit(-1)).otherwise(F.abs(F.col("n") - F.col("m")))
    return met.sortWithinPartitions("n", "block", away, "m", "turn").mapInArrow(_compared(percent, nearest), _FOUND)


def correct_terms(
    words: DataFrame, terms: DataFrame, word: str = "word", term: str = "term", percent: int = 20, together: int = TOGETHER
) -> DataFrame:
    """Every distinct word with the term it stands for: ``(word, corrected, edits)``.

    The term with the least share of edits counts, the first by name on a tie; a term stands for itself.
    A word without a letter, or without a similar term, stays (``edits`` is NULL). NULL words are left out, as
    are NULL and empty terms; an empty word stays empty. Repeated words and terms count once.
    """
    all_words = words.select(F.col(word).alias(_WORD)).filter(F.col(_WORD).isNotNull()).distinct()
    known = terms.select(F.col(term).alias(_TERM)).filter(F.col(_TERM) != "").distinct()
    best = similar_terms(all_words.filter(F.col(_WORD).rlike(r"\p{L}")), known, percent, together, nearest=True)
    return all_words.join(best, _WORD, "left").select(
        F.col(_WORD).alias(word), F.coalesce(_TERM, _WORD).alias("corrected"), "edits")

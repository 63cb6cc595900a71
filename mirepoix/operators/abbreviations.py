"""Abbreviations of a corpus, learnt from its counts, for cutting sentences where they end.

The published criterion of Kiss and Strunk (2006): a word is an abbreviation if its full stop hangs on it
far more often than full stops follow words at large (a log-likelihood ratio against 0.99), weighed by its
shortness, its inner stops and how often it stands without its stop. Counting is one grouped sum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mirepoix.functions.core import split_words
from mirepoix.session import store

# Signs that hang on a word without belonging to it.
OPENING, CLOSING = r"""["'`(\[{<]""", r"""[\])}>"'`,;:!?]"""
# Fixed values of the publication.
ALWAYS, LEAST_SCORE = 0.99, 0.3


def _counted(df: DataFrame, column: str) -> DataFrame:
    """``(word, with_stop, without)`` of every word with a letter; the word stands without its stop."""
    words = F.transform(
        split_words(F.lower(F.col(column))), lambda w: F.regexp_replace(w, f"^{OPENING}+|{CLOSING}+$", ""))
    each = df.select(F.explode(words).alias("w")).filter("w <> ''")
    stop = F.col("w").endswith(".") & ~F.col("w").endswith("..")
    typed = each.select(F.when(stop, F.expr("left(w, length(w) - 1)")).otherwise(F.col("w")).alias("word"), stop.alias("stop"))
    return typed.groupBy("word").agg(
        F.count_if("stop").alias("with_stop"), F.count_if(~F.col("stop")).alias("without"))


def _score(all_words: Column, all_stops: Column) -> Column:
    """The log-likelihood ratio, weighed."""
    stops, bare = F.col("with_stop"), F.col("without")
    usual = all_stops / all_words

    def likelihood(p: Column) -> Column:
        rest = F.when(bare == 0, F.lit(0.0)).otherwise(bare * F.log(1 - p))
        return stops * F.log(p) + rest

    ratio = -2 * (likelihood(usual) - likelihood(F.lit(ALWAYS)))
    inner = F.length("word") - F.length(F.translate("word", ".", ""))
    size = F.length("word") - inner
    return ratio * F.exp(-size) * (inner + 1) * F.exp(-bare * F.log(size))


def learn_abbreviations(
    df: DataFrame, column: str, least_count: int = 5, least_share: float = 1e-5, least_score: float = LEAST_SCORE
) -> DataFrame:
    """``(word, with_stop, without, score)`` of the abbreviations of a text column, lower-cased, without their stop.

    A word counts if it has a letter, stands with its stop at least ``least_count`` times and makes up at least
    ``least_share`` of all words: whatever the corpus, there are at most 1 / ``least_share`` of them, so the
    result may be handed to ``scoring.bleu_tokens`` as a list. NULL texts are left out; without a word there is no row.
    """
    counted = store(_counted(df, column), "word-stops")
    totals = counted.agg(F.sum(F.col("with_stop") + F.col("without")).alias("n"), F.sum("with_stop").alias("stops"))
    seen = F.col("with_stop") + F.col("without")
    often = counted.filter((F.col("with_stop") >= least_count) & F.col("word").rlike(r"\p{L}"))
    scored = often.crossJoin(F.broadcast(totals)).filter(seen >= F.col("n") * least_share)
    scored = scored.select("word", "with_stop", "without", _score(F.col("n"), F.col("stops")).alias("score"))
    return scored.filter(F.col("score") >= least_score)


def as_list(abbreviations: DataFrame) -> tuple[str, ...]:
    """The words of ``learn_abbreviations``, sorted; their number is bounded by its ``least_share``."""
    return tuple(sorted(r.word for r in abbreviations.select("word").collect()))

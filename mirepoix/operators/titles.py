"""Cleaning recipe titles with a lemma table and stop words."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mirepoix.functions import text
from mirepoix.session import store

def english_stop_words() -> list[str]:
    """The English list Spark ships."""
    return StopWordsRemover.loadDefaultStopWords("english")


def title_lemmas(df: DataFrame, tokens: str, lemmas: DataFrame | None = None) -> DataFrame:
    """Replace every token of an array column by its lemma.

    ``lemmas(token, lemma)`` is joined to the exploded tokens; of several lemmas of
    one token the alphabetically first counts, and a token without one becomes its
    singular by ending. A NULL token stays NULL. The join groups by a row number, so
    a group never holds more than one title.
    """
    if lemmas is None:
        return df.withColumn(tokens, F.transform(tokens, text.singular))
    return _join_lemmas(df, tokens, lemmas)


def _join_lemmas(df: DataFrame, tokens: str, lemmas: DataFrame) -> DataFrame:
    # Stored once, because the row numbers have to be the same on both sides of the join.
    rows = store(df.withColumn("_row", F.monotonically_increasing_id()), "titles")
    listed = lemmas.groupBy("token").agg(F.min("lemma").alias("_lemma"))
    # A frequent token meets one lemma row: the skew is on the left side only,
    # where adaptive execution splits it.
    exploded = rows.select("_row", F.posexplode(tokens).alias("_at", "_token"))
    found = exploded.join(listed, F.col("_token") == F.col("token"), "left").select(
        "_row", "_at", F.coalesce("_lemma", text.singular(F.col("_token"))).alias("_token")
    )
    rebuilt = found.groupBy("_row").agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("_at", "_token"))), lambda s: s.getField("_token")
        ).alias("_new")
    )
    return (
        rows.join(rebuilt, "_row", "left")
        .withColumn(tokens, F.when(F.col(tokens).isNotNull(), F.coalesce(
            "_new", F.array().cast("array<string>"))))
        .select(*df.columns)
    )


def clean_title(
    df: DataFrame,
    column: str = "name",
    stop_words: Sequence[str] = (),
    lemmas: DataFrame | None = None,
    output: str = "cleaned_name",
) -> DataFrame:
    """Strip, split, lemmatise, drop stop words, join; rows without a title go.

    ``stop_words`` come on top of the English list: house names, sales words and
    the like belong to the data set and are the caller's.
    """
    words = sorted({*english_stop_words(), *stop_words})
    tokens = df.withColumn(output, text.title_tokens(column))
    lemmatised = title_lemmas(tokens, output, lemmas)
    return lemmatised.withColumn(
        output, F.array_join(text.drop_stop_words(output, words), " ")
    ).dropna(subset=[output])

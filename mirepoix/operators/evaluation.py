"""Scoring tables of generations and reducing judge replies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mirepoix import lookups
from mirepoix.functions import prompts, scoring, units
from mirepoix.functions.core import once, split_words


def vocabulary(df: DataFrame, column: str) -> DataFrame:
    """Distinct lower-cased words of a text column: ``(token)``."""
    return df.select(F.explode(split_words(F.lower(F.col(column)))).alias("token")).distinct()


def correct_vocabulary(df: DataFrame, column: str) -> DataFrame:
    """Every distinct word with its listed correction and its final correction."""
    return vocabulary(df, column).select(
        "token",
        units.listed_term("token").alias("listed"),
        units.correct_term("token").alias("corrected"),
    )


def with_recipe_metrics(
    df: DataFrame, reference: str = "reference", generated: str = "generated_text"
) -> DataFrame:
    return once(df, {"recipe_metrics": scoring.recipe_metrics(reference, generated)})


def calculate_metrics(
    df: DataFrame, reference: str = "reference", generated: str = "generated_text", abbreviations: Sequence[str] = ()
) -> DataFrame:
    """Add ``bleu``, ``similarity`` and ``recipe_metrics`` to each pair."""
    native = once(df, {
        "bleu": scoring.bleu(reference, generated, abbreviations),
        "recipe_metrics": scoring.recipe_metrics(reference, generated),
    })
    return native.withColumn("similarity", scoring.similarity(reference, generated))


def resolve_verdicts(
    replies: DataFrame,
    judges: Sequence[str],
    keys: Sequence[str] = ("model_name", "id"),
    generated: str | None = None,
) -> DataFrame:
    """One verdict per generation: the first judge in the list with a readable reply.

    Without a readable reply the verdict is the error default. With
    ``generated`` an empty generated text scores 0 whatever the judges say.
    ``min_by`` combines on the map side, so many replies to one generation
    are reduced before they move.
    """
    places = F.create_map(*[F.lit(x) for i, j in enumerate(judges) for x in (j, i)])
    ranked = replies.withColumns({
        "_verdict": prompts.read_verdict("reply"),
        "_place": F.try_element_at(places, F.col("judge_model")),
    })
    usable = F.col("_verdict").isNotNull() & F.col("_place").isNotNull()
    empty = (
        F.coalesce(F.length(generated), F.lit(0)) == 0 if generated else F.lit(False)
    )
    best = F.min_by(
        F.struct("_verdict.score", "_verdict.reasoning", "judge_model"),
        F.when(usable, F.col("_place")),
    )
    grouped = ranked.groupBy(*keys).agg(best.alias("_best"), F.bool_or(empty).alias("_empty"))
    found = F.col("_best").isNotNull()
    return grouped.select(
        *keys,
        F.when(F.col("_empty"), F.lit(0.0)).when(
            found, F.coalesce("_best.score", F.lit(0.0))).otherwise(F.lit(0.0)).alias("score"),
        F.when(F.col("_empty"), F.lit(lookups.EMPTY_OUTPUT_REASON)).when(
            found, F.coalesce("_best.reasoning", F.lit("Error"))
        ).otherwise(F.lit("Judge Error: unreadable reply")).alias("reasoning"),
        F.when(F.col("_empty") | ~found, F.lit("None")).otherwise(
            F.col("_best.judge_model")).alias("judge_model"),
    )

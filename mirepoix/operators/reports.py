"""Per-model reports, benchmark tables and side-by-side views."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mirepoix import lookups
from mirepoix.functions import prompts, scoring
from mirepoix.functions.core import round_exact

METRIC_COLUMNS = {
    "avg_bleu": "bleu",
    "avg_similarity": "similarity",
    "avg_ingredient_coverage": "recipe_metrics.ingredient_coverage.score",
    "avg_temperature_validation": "recipe_metrics.temperature_validation.score",
    "avg_allergen_handling": "recipe_metrics.allergen_handling.score",
    "avg_composite_score": "recipe_metrics.composite_score",
}


def model_metrics(
    scored: DataFrame, metrics: Mapping[str, str] = METRIC_COLUMNS, by: str = "model_name"
) -> DataFrame:
    """Mean of every metric per model."""
    return scored.groupBy(by).agg(*[F.avg(path).alias(name) for name, path in metrics.items()])


def judge_report(results: DataFrame) -> DataFrame:
    """Mean score and time per model; failed verdicts count as 0."""
    return results.groupBy("model_name").agg(
        F.avg("score").alias("avg_score"), F.avg("generation_time").alias("avg_generation_time")
    )


def structure_report(generations: DataFrame, text: str = "generated_text") -> DataFrame:
    """Share of well-formed texts and mean time per model."""
    valid = scoring.structure_exact(text)
    return generations.groupBy("model_name").agg(
        F.avg("generation_time").alias("avg_generation_time"),
        (100 * F.avg(valid.cast("double"))).alias("structure_validity"),
        F.count_if(valid).alias("valid_recipes"),
        F.count(F.lit(1)).alias("total_recipes"),
    )


def run_summary(generations: DataFrame, text: str = "generated_text") -> DataFrame:
    """Totals of one run: texts, well-formed texts, their share, mean length."""
    valid = scoring.structure_loose(text)
    return generations.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(valid).alias("valid"),
        (100 * F.avg(valid.cast("double"))).alias("valid_percent"),
        F.avg(F.length(text)).alias("avg_length"),
    )


def loss_series(log: DataFrame) -> DataFrame:
    """Training and validation loss per step from an exploded training log."""
    train = log.filter(F.col("loss").isNotNull()).select("step", F.col("loss").alias("train_loss"))
    evals = log.filter(F.col("eval_loss").isNotNull()).select("step", "eval_loss")
    return train.join(evals, "step", "full_outer")


def models_by_sample(
    sample: DataFrame, generations: DataFrame, models: Sequence[str], key: str = "id"
) -> DataFrame:
    """Every model on the same sample rows; a missing generation stays as NULL.

    The model list is a plan literal, so no cross join is needed.
    """
    wanted = sample.withColumn("model_name", F.explode(F.array(*[F.lit(m) for m in models])))
    produced = generations.select("model_name", key, "generated_text", "generation_time")
    return wanted.join(produced, ["model_name", key], "left")


def prefix_model(results: DataFrame, config_name: str) -> DataFrame:
    return results.withColumn(
        "model_name", F.concat(F.lit(config_name + " - "), F.col("model_name"))
    )


def union_runs(runs: Mapping[str, DataFrame]) -> DataFrame:
    """Results of several configurations in one table, named by configuration."""
    frames = [prefix_model(df, name) for name, df in runs.items()]
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def side_by_side(
    long: DataFrame, variants: Sequence[str], keys: Sequence[str] = ("id", "instruction")
) -> DataFrame:
    """One row per instruction, one column per variant of its text.

    Conditional aggregates instead of a pivot: the variants are known, and each
    column combines on the map side.
    """
    return long.groupBy(*keys).agg(*[
        F.min(F.when(F.col("variant") == v, F.col("text"))).alias(v) for v in variants
    ])


def benchmark_rows(generations: DataFrame, verdicts: DataFrame, keys: Sequence[str] = ("model_name", "id")) -> DataFrame:
    """Benchmark result rows: rounded time, score and judge with defaults, length."""
    joined = generations.join(verdicts, list(keys), "left")
    return joined.select(
        *keys,
        prompts.dish_name("instruction").alias("dish_name"),
        round_exact(F.col("generation_time"), 2).alias("generation_time"),
        F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"),
        F.coalesce("reasoning", F.lit("Error")).alias("reasoning"),
        F.length("generated_text").alias("recipe_length"),
        F.coalesce("judge_model", F.lit("Unknown")).alias("judge_model"),
    )


def report_text(
    wide: DataFrame, headings: Sequence[tuple[str, str]] = lookups.VARIANT_HEADINGS,
    number: str = "id",
) -> DataFrame:
    """One text block per sample for reading variants side by side."""
    bar = "#" * 80
    parts: list[Column] = [
        F.lit("\n" + bar),
        F.concat(
            F.lit(lookups.SAMPLE_HEADING), F.col(number).cast("string"), F.lit(": "),
            F.col("instruction"),
        ),
        F.lit(bar),
    ]
    for column, heading in headings:
        if column in wide.columns:
            parts += [F.lit("\n" + heading), F.coalesce(F.col(column), F.lit("N/A"))]
    return wide.select("id", F.concat_ws("\n", *parts, F.lit("\n")).alias("value"))

"""Instruction/output pairs: building, filtering, ordering, splitting, rendering."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mirepoix.functions import prompts
from mirepoix.functions.core import once, split_words
from mirepoix.operators.ordering import (
    is_among_smallest,
    lay_out,
    seeded_key,
    with_order_keys,
    with_row_index,
)
from mirepoix.session import store

MIN_STEP_CHARS = 10
MIN_OUTPUT_CHARS = 200
SUBSET_SIZE = 10_000
TEST_SHARE = 0.05
GOLDEN_SIZE = 5
MEGA_BATCHES = 50
SEED = 42


def instruction_pairs(df: DataFrame, min_step_chars: int = MIN_STEP_CHARS) -> DataFrame:
    """One pair per cleaned recipe with long enough steps."""
    steps = "steps_string_standardize"
    return once(df, {steps: F.col(steps)}).filter(F.length(steps) >= min_step_chars).select(
        "id",
        prompts.instruction_text("name").alias("instruction"),
        prompts.output_text("ingredients_text", steps).alias("output"),
    )


def filter_length(df: DataFrame, min_chars: int = MIN_OUTPUT_CHARS, column: str = "output") -> DataFrame:
    return df.filter(F.length(column) > min_chars)


def seeded_shuffle(df: DataFrame, seed: int = SEED, key: str = "id") -> DataFrame:
    """Rows in a repeatable random order; copies of one key still spread over tasks."""
    keyed, names = with_order_keys(df, seeded_key(seed, key))
    return keyed.orderBy(*names).drop(*names)


def seeded_subset(df: DataFrame, size: int = SUBSET_SIZE, seed: int = SEED, key: str = "id") -> DataFrame:
    """The first ``size`` rows of the seeded order, without sorting the table.

    Rows are kept by comparison with the cut-off digest. If copies of one key
    straddle the cut-off the final limit drops the surplus copies, by a hash of the row.
    """
    digest = seeded_key(seed, key)
    kept = df.filter(is_among_smallest(df, digest, lambda total: F.lit(size)))
    hashable = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    return kept.orderBy(digest, F.xxhash64(*hashable)).limit(size)


def train_test_split(
    df: DataFrame, test_share: float = TEST_SHARE, seed: int = SEED, key: str = "id"
) -> DataFrame:
    """Add ``split``: exactly ``ceil(share * n)`` rows are ``test`` when keys are unique.

    Copies of a key always land on the same side.
    """
    digest = seeded_key(seed, key)
    is_test = is_among_smallest(
        df, digest, lambda total: F.ceil(total * F.lit(float(test_share)))
    )
    return df.withColumn("split", F.when(is_test, "test").otherwise("train"))


def golden_sample(df: DataFrame, size: int = GOLDEN_SIZE, seed: int = SEED, key: str = "id") -> DataFrame:
    """A few test rows, the same ones for every model; all rows if there are fewer."""
    test = df.filter(F.col("split") == "test") if "split" in df.columns else df
    return test.orderBy(seeded_key(seed + 1, key), key).limit(size)


STYLES = ("qlora", "prompt_tuning", "ia3")


def render_prompt(df: DataFrame, style: str, output: str = "text") -> DataFrame:
    """Training or inference text of each pair in one style."""
    if style in STYLES:
        rendered = prompts.training_text("instruction", "output", style)
    elif style == "inference":
        rendered = prompts.inference_prompt("instruction")
    elif style == "chef":
        rendered = prompts.persona_prompt("instruction")
    elif style == "with_ingredients":
        rendered = prompts.ingredients_prompt("name", "ingredients_text")
    else:
        raise ValueError(f"unknown style: {style}")
    return df.withColumn(output, rendered)


def sequence_budget(df: DataFrame, max_tokens: int = 512, column: str = "text", pad: str = "<pad>") -> DataFrame:
    """Cut each text to a token budget and pad it; labels are the same tokens.

    Tokens are white-space separated words. Adds ``tokens``, ``labels``,
    ``attention``, ``n_tokens`` (before the cut) and ``over_budget``.
    """
    counted = df.withColumn("_words", split_words(F.col(column))).withColumns({
        "n_tokens": F.size("_words"),
        "_kept": F.slice("_words", 1, max_tokens),
    })
    padding = F.array_repeat(F.lit(pad), F.lit(max_tokens) - F.size("_kept"))
    filled = counted.withColumns({
        "tokens": F.concat("_kept", padding),
        "attention": F.concat(
            F.array_repeat(F.lit(1), F.size("_kept")),
            F.array_repeat(F.lit(0), F.lit(max_tokens) - F.size("_kept")),
        ),
        "over_budget": F.col("n_tokens") > max_tokens,
    })
    return filled.withColumn("labels", F.col("tokens")).drop("_words", "_kept")


def with_length_bucket(df: DataFrame, step: int = 64, column: str = "text") -> DataFrame:
    tokens = F.size(split_words(F.col(column)))
    return df.withColumn("bucket", F.floor(tokens / step))


def length_buckets(df: DataFrame, step: int = 64, column: str = "text") -> DataFrame:
    """How many texts fall into each length bucket."""
    return with_length_bucket(df, step, column).groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n_texts")
    )


def group_by_length(df: DataFrame, column: str = "text") -> DataFrame:
    """Lay texts of similar length side by side.

    Range-partitioned, with equal lengths told apart, so one frequent length does
    not end up in a single task.
    """
    return lay_out(df, F.size(split_words(F.col(column))))


def length_grouped_batches(
    df: DataFrame, batch_size: int = 8, seed: int = SEED, key: str = "id", column: str = "text"
) -> DataFrame:
    """Batches of texts of similar length in a seeded random order, as a trainer draws them.

    The seeded order is cut into mega-batches of up to ``MEGA_BATCHES`` batches (fewer in a small
    table), each sorted from long to short. The longest text of all changes places with the very
    first one, so that a batch that does not fit in memory fails at once. Adds ``n_tokens``,
    ``batch`` and ``slot``. A mega-batch is a window of fixed size; nothing else is brought together.
    """
    sized = df.withColumn("n_tokens", F.greatest(F.size(split_words(F.col(column))), F.lit(0)))
    placed = with_row_index(sized.withColumn("_digest", seeded_key(seed, key)), ["_digest", key], "_place")
    many = F.greatest(F.lit(1), F.least(F.lit(MEGA_BATCHES), F.floor(F.count(F.lit(1)) / (4 * batch_size))))
    size = placed.agg((many * batch_size).alias("size")).select("size").scalar()
    cut = placed.withColumn("_size", size).withColumn("_mega", F.floor(F.col("_place") / F.col("_size")))
    inner = Window.partitionBy("_mega").orderBy(F.desc("n_tokens"), "_place")
    ranked = store(cut.withColumn("_at", F.row_number().over(inner) - 1), "mega-batches")
    longest = F.max_by("_mega", F.struct("n_tokens", -F.col("_mega")))
    best = ranked.filter("_at = 0").agg(longest.alias("best")).select("best").scalar()
    first, top = F.col("_at") == 0, F.col("_best")
    swapped = F.when(first & (F.col("_mega") == 0), top).when(first & (F.col("_mega") == top), 0).otherwise(F.col("_mega"))
    where = ranked.withColumn("_best", best).withColumn("_to", swapped)
    batch = F.floor((F.col("_to") * F.col("_size") + F.col("_at")) / batch_size)
    return where.select(*df.columns, "n_tokens", batch.alias("batch"), (F.col("_at") % batch_size).cast("int").alias("slot"))


def padding_waste(batches: DataFrame) -> DataFrame:
    """One row: texts, batches, tokens, and the padding that filling every batch to its longest text takes."""
    each = batches.groupBy("batch").agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_tokens").alias("tokens"), F.max("n_tokens").cast("long").alias("longest"))
    return each.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_texts"), F.count(F.lit(1)).alias("n_batches"),
        F.coalesce(F.sum("tokens"), F.lit(0)).alias("n_tokens"),
        F.coalesce(F.sum(F.col("n") * F.col("longest") - F.col("tokens")), F.lit(0)).alias("n_padding"))

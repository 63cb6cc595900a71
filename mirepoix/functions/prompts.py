"""Prompt texts, echoed prompts, dish names, model labels and judge verdicts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mirepoix import lookups
from mirepoix.functions.core import as_column, let, strip_space, title_case


def instruction_text(name: Column | str) -> Column:
    return F.concat(F.lit("Create a detailed recipe for "), as_column(name), F.lit("."))


def output_text(ingredients: Column | str, steps: Column | str) -> Column:
    return F.concat(
        F.lit("Ingredients:\n"), as_column(ingredients),
        F.lit("\n\nInstructions:\n"), as_column(steps),
    )


def inference_prompt(instruction: Column | str) -> Column:
    return F.concat(F.lit("Instruction: "), as_column(instruction), F.lit("\n\nRecipe:"))


def persona_prompt(instruction: Column | str) -> Column:
    return F.concat(
        F.lit(lookups.PERSONA_OPENING + "\n\nDish: "), as_column(instruction),
        F.lit("\n\n" + lookups.PERSONA_MARKER),
    )


def ingredients_prompt(name: Column | str, ingredients: Column | str) -> Column:
    """Request with an ingredient list; without one when the list is blank."""
    name, ingredients = as_column(name), as_column(ingredients)
    with_list = F.concat(
        F.lit("Create a detailed recipe for "), name, F.lit(" using these ingredients: "),
        ingredients, F.lit("."),
    )
    blank = ingredients.isNull() | (strip_space(ingredients) == "")
    return F.when(blank, instruction_text(name)).otherwise(with_list)


def training_text(instruction: Column | str, output: Column | str, style: str) -> Column:
    """Training text by style: ``qlora``, ``prompt_tuning`` or ``ia3``."""
    prompted = F.concat(inference_prompt(instruction), F.lit(" "), as_column(output))
    if style == "qlora":
        return F.concat(prompted, F.lit(lookups.END_OF_TEXT))
    if style == "prompt_tuning":
        return prompted
    if style == "ia3":
        return F.concat(as_column(instruction), F.lit("\n\n"), as_column(output))
    raise ValueError(f"unknown style: {style}")


# --- echoed prompts ----------------------------------------------------------


def strip_prefix(text: Column | str, prompt: Column | str) -> Column:
    """Remove the prompt if the text starts with it."""
    text, prompt = as_column(text), as_column(prompt)
    rest = F.substr(text, F.length(prompt) + 1)
    return F.when(text.startswith(prompt), strip_space(rest)).otherwise(text)


def strip_everywhere(text: Column | str, prompt: Column | str) -> Column:
    """Remove every occurrence of the prompt."""
    return strip_space(F.replace(as_column(text), as_column(prompt), F.lit("")))


def strip_to_marker(text: Column | str, marker: str = lookups.PERSONA_MARKER) -> Column:
    """Keep what follows the last marker."""
    return strip_space(F.substring_index(as_column(text), marker, -1))


def strip_persona(text: Column | str, instruction: Column | str) -> Column:
    """Remove the persona prompt; fall back to its last line if it was altered."""
    prompt = persona_prompt(instruction)
    return let(
        strip_everywhere(text, prompt),
        lambda t: F.when(
            (F.length(t) > F.length(prompt))
            & t.startswith(lookups.PERSONA_OPENING[: len("You are a professional chef")])
            & t.contains(lookups.PERSONA_MARKER),
            strip_to_marker(t),
        ).otherwise(t),
    )


# --- names and labels --------------------------------------------------------


def dish_name(instruction: Column | str) -> Column:
    found = strip_space(F.regexp_extract(as_column(instruction), lookups.DISH_PATTERN, 1))
    matched = as_column(instruction).rlike(lookups.DISH_PATTERN)
    return F.when(matched, found).otherwise(F.lit(lookups.UNKNOWN_DISH))


def adapter_type(model_name: Column | str) -> Column:
    """The text between the first parentheses."""
    name = as_column(model_name)
    inner = F.split_part(
        F.split_part(name, F.lit("("), F.lit(2)), F.lit(")"), F.lit(1)
    )
    return F.when(name.contains("(") & name.contains(")"), inner).otherwise(
        F.lit(lookups.UNKNOWN_ADAPTER)
    )


def adapter_label(model_name: Column | str) -> Column:
    return F.concat(title_case(adapter_type(model_name)), F.lit(" Fine-Tuned"))


# --- verdicts ----------------------------------------------------------------


def judge_input(text: Column | str) -> Column:
    """The part of a text a judge sees; NULL for an empty text."""
    text = as_column(text)
    return F.when(F.length(text) > 0, F.substring(text, 1, lookups.JUDGE_TEXT_LIMIT))


def read_verdict(reply: Column | str) -> Column:
    """``(score, reasoning)`` of a judge reply, NULL if it is no JSON object.

    Code fences around the object are removed. A score may be any number, also in
    quotes; one that is no number is NULL.
    """
    bare = strip_space(
        F.replace(F.replace(as_column(reply), F.lit("```json"), F.lit("")), F.lit("```"), F.lit(""))
    )
    return let(
        F.from_json(
            bare, "score string, reasoning string, _bad string", {"columnNameOfCorruptRecord": "_bad"}
        ),
        lambda v: F.when(
            v.isNotNull() & v.getField("_bad").isNull(),
            F.struct(v.getField("score").try_cast("double").alias("score"), v.getField("reasoning").alias("reasoning")),
        ),
    )


def parse_verdict(reply: Column | str) -> Column:
    """A verdict with defaults: an unreadable reply scores 0 with an error text."""
    return let(
        read_verdict(reply),
        lambda v: F.struct(
            F.when(v.isNull(), F.lit(0.0)).otherwise(
                F.coalesce(v.getField("score"), F.lit(0.0))).alias("score"),
            F.when(v.isNull(), F.lit("Judge Error: unreadable reply")).otherwise(
                F.coalesce(v.getField("reasoning"), F.lit("Error"))).alias("reasoning"),
        ),
    )

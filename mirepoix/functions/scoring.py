"""Scores of a generated recipe, alone or against its reference.

Every score is local to its row, so scoring a table needs no shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from mirepoix import lookups
from mirepoix.functions import lcs
from mirepoix.functions.core import (
    EDGE,
    as_column,
    common_count,
    let,
    no_strings,
    single_spaced,
    split_words,
    strip_space,
    without_marks,
)

# --- BLEU --------------------------------------------------------------------

# The published Treebank word rules, in order, on lower-cased text with single blanks.
TREEBANK_RULES = (
    (r"(^|[ (\[{<])(?:\"|'')", "$1 `` "),
    (r"([:,])([^0-9])", " $1 $2"),
    (r"([:,])$", " $1 "),
    (r"\.\.\.", " ... "),
    (r"[;@#$%&]", " $0 "),
    # every sentence's full stop, not only the text's last one
    (r"([^. ])\.([\])}>\"']*)( |$)", "$1 . $2$3"),
    (r"[?!]", " $0 "),
    (r"([^'])' ", "$1 ' "),
    (r"[\[\](){}<>]", " $0 "),
    (r"--", " -- "),
    (r"\"|''", " '' "),
    (r"([^' ])('s|'m|'d|'|'ll|'re|'ve|n't)(?= |$)", "$1 $2 "),
    (r"\b(can)(not)\b", "$1 $2"),
    (r"\b(gim|lem)(me)\b", "$1 $2"),
    (r"\b(gon|wan)(na)\b", "$1 $2"),
    (r"\b(got)(ta)\b", "$1 $2"),
)

# The same words in fewer passes: signs that are cut off on both sides go together where no rule
# between them can tell the difference, and so do the joined words. Their first letter is asked
# before the word edge, which costs more.
_PASSES = (
    *TREEBANK_RULES[:3],
    (r"\.\.\.|[;@#$%&]", " $0 "),
    *TREEBANK_RULES[5:8],
    (r"[\[\](){}<>]|--", " $0 "),
    *TREEBANK_RULES[10:12],
    (r"(?=[cglw])\b(can(?=not\b)|(?:gim|lem)(?=me\b)|(?:gon|wan)(?=na\b)|got(?=ta\b))", "$1 "),
)
# Those that find nothing in a text without a quote or an apostrophe: none of the others makes one.
_QUOTE_RULES = {TREEBANK_RULES[i] for i in (0, 7, 10, 11)}
_UNQUOTED_PASSES = tuple(p for p in _PASSES if p not in _QUOTE_RULES)


# A noncharacter in place of the stop of an abbreviation.
_KEPT_STOP = "\ufdd2"


def _abbreviations_marked(text: Column, abbreviations: Sequence[str]) -> Column:
    """Single-spaced text with the stops of abbreviations hidden, but for one that ends the text."""
    def hidden(word: Column, place: Column, count: Column) -> Column:
        bare = F.regexp_replace(word, r"""^["'`(\[{<]+|[,;:]+$""", "")
        known = F.substring(bare, F.lit(1), F.length(bare) - 1).isin(list(abbreviations))
        ends_text = (place == count - 1) & word.endswith(".")
        return F.when(
            bare.endswith(".") & known & ~ends_text, F.regexp_replace(word, r"\.([,;:]*)$", _KEPT_STOP + "$1")
        ).otherwise(word)

    words = F.split(F.translate(text, _KEPT_STOP, ""), " ")
    return let(words, lambda w: F.array_join(F.transform(w, lambda x, i: hidden(x, i, F.size(w))), " "))


def bleu_tokens(text: Column | str, abbreviations: Sequence[str] = ()) -> Column:
    """Lower-cased Treebank tokens: decimals, fractions, hyphenated words and ``...`` stay whole.

    ``abbreviations`` are lower-cased words without their stop (see ``operators.abbreviations``): their stop
    ends no sentence and stays on the word, unless it ends the text.
    """
    def passed(rest: Column, passes: Sequence[tuple[str, str]]) -> Column:
        for pattern, replacement in passes:
            rest = F.regexp_replace(rest, pattern, replacement)
        return rest

    rest = F.lower(single_spaced(as_column(text)))
    if abbreviations:
        rest = _abbreviations_marked(rest, abbreviations)
    rest = let(rest, lambda t: F.when(t.contains("'") | t.contains('"'), passed(t, _PASSES)).otherwise(
        passed(t, _UNQUOTED_PASSES)))
    if abbreviations:
        rest = F.translate(rest, _KEPT_STOP, ".")
    return F.filter(F.split(rest, " +"), lambda w: w != "")


def longer_ngrams(grams: Column, tokens: Column, n: int) -> Column:
    """n-grams from (n-1)-grams: each one extended by the next token. All are 64-bit hashes."""
    count = F.size(tokens) - (n - 1)
    return F.when(
        count > 0,
        F.zip_with(F.slice(grams, F.lit(1), count), F.slice(tokens, F.lit(n), count), lambda g, t: F.xxhash64(g, t)),
    ).otherwise(F.array().cast("array<bigint>"))


def all_ngrams(tokens: Column) -> Column:
    """The n-grams for n = 1 to 4 of hashed tokens, one array per n."""
    return let(
        longer_ngrams(tokens, tokens, 2),
        lambda two: let(
            longer_ngrams(two, tokens, 3),
            lambda three: F.array(tokens, two, three, longer_ngrams(three, tokens, 4)),
        ),
    )


def clipped_matches(reference: Column, generated: Column) -> Column:
    """For n = 1 to 4: how many generated n-grams the reference has, each at most as often."""
    return F.zip_with(all_ngrams(generated), all_ngrams(reference), common_count)


def bleu(reference: Column | str, generated: Column | str, abbreviations: Sequence[str] = ()) -> Column:
    """Sentence BLEU-4 with uniform weights, on ``bleu_tokens``.

    No unigram match gives 0; a higher order without match counts 0.1 matches.
    The multisets of n-grams, as 64-bit hashes, are intersected inside the row. A column
    against itself, by name, is cut into tokens once.
    """
    def combined(hits: Column, ref: Column, gen: Column) -> Column:
        logs = F.transform(
            hits,
            lambda h, i: F.log(
                F.when(h > 0, h.cast("double")).otherwise(F.lit(0.1))
                / F.greatest(F.lit(1), F.size(gen) - i)
            ) * 0.25,
        )
        total = F.aggregate(logs, F.lit(0.0), lambda a, x: a + x)
        penalty = F.when(F.size(gen) > F.size(ref), F.lit(1.0)).otherwise(
            F.exp(1 - F.size(ref) / F.size(gen))
        )
        return F.when(F.get(hits, 0) == 0, F.lit(0.0)).otherwise(penalty * F.exp(total))

    def score(ref: Column, gen: Column) -> Column:
        return F.when(F.size(gen) == 0, F.lit(0.0)).otherwise(
            let(clipped_matches(ref, gen), lambda h: combined(h, ref, gen))
        )

    def hashed(text: Column | str) -> Column:
        return F.transform(bleu_tokens(text, abbreviations), lambda t: F.xxhash64(t))

    if isinstance(reference, str) and reference == generated:
        return let(hashed(reference), lambda t: score(t, t))
    both = F.struct(hashed(reference).alias("r"), hashed(generated).alias("g"))
    return let(both, lambda b: score(b.getField("r"), b.getField("g")))


# --- character similarity ----------------------------------------------------


@F.pandas_udf(DoubleType())
def _similarity_udf(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for left, right in batches:
        yield pd.Series(lcs.similarity(list(left), list(right)), dtype="float64")


def similarity(reference: Column | str, generated: Column | str) -> Column:
    """Insert/delete similarity of the lower-cased texts, 0 to 100."""
    return _similarity_udf(F.lower(as_column(reference)), F.lower(as_column(generated)))


# --- ingredients -------------------------------------------------------------

_LIST_MARKS = r"""'\[\]\""""


def extract_ingredients(text: Column | str) -> Column:
    """The ingredient names listed after "Ingredients:", lower-cased and trimmed."""
    def listed(section: Column) -> Column:
        quoted = F.regexp_extract_all(section, F.lit(r"'([^']+)'"), F.lit(1))
        items = F.when(
            section.startswith("[") | section.contains("['"), quoted
        ).otherwise(F.split(section, r"[,\n]"))
        trimmed = F.filter(
            F.transform(items, strip_space),
            lambda i: (i != "") & ~i.isin("[]", "['']", "''"),
        )
        return F.transform(
            trimmed,
            lambda i: F.regexp_replace(
                F.lower(i), rf"^[{_LIST_MARKS}]+|[{_LIST_MARKS}]+$", ""
            ),
        )

    section = strip_space(F.regexp_extract(as_column(text), lookups.INGREDIENT_SECTION, 1))
    return let(
        section,
        lambda s: F.when(s == "", no_strings()).otherwise(listed(s)),
    )


def _with_edges(text: Column) -> Column:
    """The text with a mark at each edge of a word: a whole-word search becomes a plain one."""
    return F.regexp_replace(without_marks(text), r"\b", EDGE)


def ingredient_is_used(ingredient: Column, marked_text: Column) -> Column:
    """The whole name occurs, or one of its telling words does.

    ``marked_text`` has its word edges marked, and so get the terms; one that has no edge at an end
    of its own needs one in the text. No pattern is built from a term.
    """
    def occurs(term: Column) -> Column:
        def marked_occurs(marked: Column) -> Column:
            before = F.when(marked.startswith(EDGE), F.lit("")).otherwise(F.lit(EDGE))
            after = F.when(marked.endswith(EDGE) | (term == ""), F.lit("")).otherwise(F.lit(EDGE))
            return marked_text.contains(F.concat(before, marked, after))

        return let(_with_edges(term), marked_occurs)

    telling = F.filter(
        split_words(ingredient),
        lambda w: (F.length(w) > 2) & ~w.isin(list(lookups.GENERIC_INGREDIENT_WORDS)),
    )
    return occurs(ingredient) | F.exists(telling, occurs)


def ingredient_coverage(ingredients: Column | str, generated: Column | str) -> Column:
    """Share of the ingredients that occur anywhere in the generated text."""
    def result(names: Column, used: Column) -> Column:
        count, total = F.size(used), F.size(names)
        share = F.when(total > 0, count / total).otherwise(F.lit(0.0))
        return F.struct(
            share.alias("score"),
            (F.when(total > 0, count / total * 100).otherwise(F.lit(0.0))).alias(
                "coverage_percentage"),
            count.alias("used_count"),
            total.alias("total_count"),
            F.filter(names, lambda n: ~F.array_contains(used, n)).alias("missing_ingredients"),
        )

    names = F.transform(as_column(ingredients), lambda i: strip_space(F.lower(i)))
    # without a name to look for, the text is not searched for word edges
    marked = F.when(F.size(as_column(ingredients)) > 0, _with_edges(F.lower(as_column(generated))))
    return let(
        F.struct(names.alias("n"), marked.alias("t")),
        lambda s: let(
            F.filter(s.getField("n"), lambda i: ingredient_is_used(i, s.getField("t"))),
            lambda used: result(s.getField("n"), used),
        ),
    )


# --- temperatures ------------------------------------------------------------


def extract_temperatures(text: Column | str) -> Column:
    """``(value, unit)`` of every mention; a mention two patterns fit counts twice."""
    text = as_column(text)
    found = []
    for pattern in lookups.TEMPERATURE_MENTIONS:
        # the long text is searched once; what a mention holds is read from the mention alone
        found.append(
            F.transform(
                F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
                lambda m: F.struct(
                    F.regexp_extract(m, pattern, 1).cast("double").alias("value"),
                    F.upper(F.left(F.regexp_extract(m, pattern, 2), F.lit(1))).alias("unit"),
                ),
            )
        )
    return F.concat(*found)


def temperature_valid(value: Column | str, unit: Column | str) -> Column:
    """Within the plausible range after conversion to Celsius."""
    value = as_column(value)
    celsius = F.when(F.upper(as_column(unit)) == "F", (value - 32) * 5 / 9).otherwise(value)
    return celsius.between(*lookups.TEMPERATURE_RANGE_C)


def temperature_score(text: Column | str) -> Column:
    """Share of plausible temperatures; 0.5 without any mention."""
    def result(all_found: Column, valid: Column) -> Column:
        count, total = F.size(valid), F.size(all_found)
        return F.struct(
            F.when(total > 0, count / total).otherwise(F.lit(0.5)).alias("score"),
            (total > 0).alias("has_temperatures"),
            count.alias("valid_count"),
            (total - count).alias("invalid_count"),
            (total == count).alias("all_valid"),
        )

    return let(
        extract_temperatures(text),
        lambda found: let(
            F.filter(found, lambda t: temperature_valid(t.getField("value"), t.getField("unit"))),
            lambda valid: result(found, valid),
        ),
    )


# --- allergens ---------------------------------------------------------------


def extract_allergens(text: Column | str) -> Column:
    """The allergen terms that occur as whole words, sorted. One regex pass."""
    pattern = r"\b(" + "|".join(lookups.ALLERGENS) + r")\b"
    return F.array_sort(
        F.array_distinct(
            F.regexp_extract_all(F.lower(as_column(text)), F.lit(pattern), F.lit(1))
        )
    )


def substitution_count(text: Column | str) -> Column:
    def counted(lowered: Column, pattern: str) -> Column:
        # the longest word a pattern begins with is looked for plainly first
        words = re.match(r"(?:\(\?d\))?\\b([a-z ]+)", pattern).group(1).split()
        absent = ~lowered.contains(max(words, key=len))
        return F.when(absent, 0).otherwise(F.regexp_count(lowered, F.lit(pattern)))

    def total(lowered: Column) -> Column:
        counts = [counted(lowered, p) for p in lookups.SUBSTITUTION_PATTERNS]
        return sum(counts[1:], counts[0])

    return let(F.lower(as_column(text)), total)


def safety_warning(text: Column | str) -> Column:
    pattern = r"(?d)\b(?:" + "|".join(lookups.SAFETY_PATTERNS) + ")"
    return F.lower(as_column(text)).rlike(pattern)


def allergen_score(text: Column | str) -> Column:
    def result(found: Column, swaps: Column, warned: Column) -> Column:
        points = (
            F.when(F.size(found) > 0, F.lit(0.3)).otherwise(F.lit(0.0))
            + F.when(swaps > 0, F.lit(0.3)).otherwise(F.lit(0.0))
            + F.when(warned, F.lit(0.4)).otherwise(F.lit(0.0))
        )
        return F.struct(
            F.least(points, F.lit(1.0)).alias("score"),
            found.alias("allergens_mentioned"),
            ((F.size(found) > 0) | (swaps > 0) | warned).alias("allergen_awareness"),
            swaps.alias("substitution_count"),
            warned.alias("has_safety_warnings"),
        )

    found = F.struct(
        extract_allergens(text).alias("f"), substitution_count(text).alias("s"), safety_warning(text).alias("w"))
    return let(found, lambda x: result(x.getField("f"), x.getField("s"), x.getField("w")))


# --- everything --------------------------------------------------------------


def recipe_metrics(reference: Column | str, generated: Column | str) -> Column:
    """Coverage, temperatures, allergens and their weighted sum as one struct."""
    weights = lookups.COMPOSITE_WEIGHTS

    def combined(cov: Column, temp: Column, allergy: Column) -> Column:
        return F.struct(
            (
                cov.getField("score") * weights["ingredients"]
                + temp.getField("score") * weights["temperatures"]
                + allergy.getField("score") * weights["allergens"]
            ).alias("composite_score"),
            cov.alias("ingredient_coverage"),
            temp.alias("temperature_validation"),
            allergy.alias("allergen_handling"),
        )

    parts = F.struct(
        ingredient_coverage(extract_ingredients(reference), generated).alias("c"),
        temperature_score(generated).alias("t"), allergen_score(generated).alias("a"))
    return let(parts, lambda p: combined(p.getField("c"), p.getField("t"), p.getField("a")))


# --- structure ---------------------------------------------------------------


def structure_exact(text: Column | str) -> Column:
    text = as_column(text)
    return text.contains("Ingredients") & text.contains("Instructions")


def structure_loose(text: Column | str) -> Column:
    lowered = F.lower(as_column(text))
    return lowered.contains("ingredient") & lowered.contains("instruction")


def structure_vote(text: Column | str, min_chars: int = 200) -> Column:
    """At least two of: names ingredients, names instructions, is long enough."""
    text = as_column(text)
    lowered = F.lower(text)
    votes = (
        lowered.contains("ingredients").cast("int")
        + lowered.contains("instructions").cast("int")
        + (F.length(text) > min_chars).cast("int")
    )
    return votes >= 2


def format_compliance(text: Column | str) -> Column:
    """The whole text is an ingredient section, a blank line and instructions.

    Written as prefix and position tests: the section pattern would have to
    scan a long text with a lazy quantifier.
    """
    text = as_column(text)
    head, marker = "Ingredients:", "\n\nInstructions:"
    at = F.locate(marker, text, len(head) + 2)
    return text.startswith(head) & (at > 0) & (F.length(text) >= at + len(marker))

"""Parsing and normalising recipe and title text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from mirepoix import lookups
from mirepoix.functions.core import as_column, let, regex_sub_compute, without_marks

_LITERAL_OPTIONS = {
    "allowSingleQuotes": "true",
    "allowBackslashEscapingAnyCharacter": "true",
    "allowUnquotedControlChars": "true",
}
_EVEN = r"(?<!\\)((?:\\\\)*)"
# A quoted piece, or a bare None.
_QUOTED_OR_NONE = r"""(?s)'[^'\\]*+(?:\\.[^'\\]*+)*+'|"[^"\\]*+(?:\\.[^"\\]*+)*+"|\bNone\b"""


def _surrogates(code: Column) -> Column:
    """``\\UNNNNNNNN`` as the JSON escapes of its one or two UTF-16 units."""
    def unit(value: Column) -> Column:
        return F.concat(F.lit("\\u"), F.lpad(F.hex(value), 4, "0"))

    def written(n: Column) -> Column:
        high, low = F.shiftright(n - 0x10000, 10) + 0xD800, (n - 0x10000).bitwiseAND(F.lit(0x3FF)) + 0xDC00
        return F.when(n < 0x10000, unit(n)).otherwise(F.concat(unit(high), unit(low)))

    return let(F.conv(code, 16, 10).cast("int"), written)


def _json_escapes(text: Column) -> Column:
    """A Python list literal with the escapes and the bare None that JSON writes otherwise."""
    def rewritten(t: Column) -> Column:
        # no step makes or removes the sign that calls for the next one
        short = F.when(t.contains("\\x"), F.regexp_replace(t, _EVEN + r"\\x([0-9a-fA-F]{2})", r"$1\\u00$2")).otherwise(t)
        long = F.when(t.contains("\\U"), regex_sub_compute(
            without_marks(short), _EVEN + r"\\U(00(?:0[0-9a-fA-F]|10)[0-9a-fA-F]{4})", [1, 2],
            lambda before, code: F.concat(before, _surrogates(code)), marks=False)).otherwise(short)
        return F.when(t.contains("None"), regex_sub_compute(
            without_marks(long), _QUOTED_OR_NONE, [0],
            lambda piece: F.when(piece == "None", F.lit("null")).otherwise(piece), marks=False)).otherwise(long)

    return let(text, rewritten)


def parse_string_list(text: Column | str, strict: bool = False) -> Column:
    """``"['a', 'b']"`` as ``array<string>``; a malformed literal is NULL or, if strict, an error.

    Escapes are read as Python writes them; a bare ``None`` is a NULL element.
    """
    options = dict(_LITERAL_OPTIONS)
    if strict:
        options["mode"] = "FAILFAST"
    return F.from_json(_json_escapes(as_column(text)), "array<string>", options)


def parse_number_list(text: Column | str, strict: bool = False) -> Column:
    """``"[1, 2.5]"`` as ``array<double>``."""
    options = dict(_LITERAL_OPTIONS)
    if strict:
        options["mode"] = "FAILFAST"
    return F.from_json(as_column(text), "array<double>", options)


def lower_each(items: Column | str) -> Column:
    return F.transform(as_column(items), F.lower)


def join_steps(steps: Column | str) -> Column:
    return F.array_join(as_column(steps), " ")


def join_ingredients(ingredients: Column | str) -> Column:
    return F.array_join(as_column(ingredients), ", ")


def drop_tags(tags: Column | str, keywords: Sequence[str] = lookups.TAG_KEYWORDS) -> Column:
    """Keep the tags that contain none of the keywords."""
    pattern = "|".join(keywords)
    return F.filter(as_column(tags), lambda t: ~F.lower(t).rlike(pattern))


def find_tags(tags: Column | str, keyword: str) -> Column:
    """Keep the tags that contain the keyword."""
    return F.filter(as_column(tags), lambda t: F.lower(t).contains(keyword))


_CONTROL = r"[\x00-\x1f\x7f-\xa0\xad]"


def list_text(items: Column | str) -> Column:
    """A list written out: ``['a', 'b']``, and ``[]`` when empty.

    An element with an apostrophe is put between double quotes, unless it
    holds a double quote as well; then the apostrophe is escaped. Control
    characters are written as escapes, a NULL element as ``None``.
    """
    def escaped(t: Column) -> Column:
        t = F.replace(t, F.lit("\\"), F.lit("\\\\"))
        for raw, name in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
            t = F.replace(t, F.lit(raw), F.lit(name))
        return let(t, lambda x: F.when(x.rlike(_CONTROL), regex_sub_compute(
            x, _CONTROL, [0], lambda c: F.concat(F.lit("\\x"), F.lower(F.lpad(F.hex(F.ascii(c)), 2, "0"))))).otherwise(x))

    def written(t: Column) -> Column:
        return F.coalesce(let(escaped(t), quoted), F.lit("None"))

    def quoted(t: Column) -> Column:
        return (
            F.when(~t.contains("'"), F.concat(F.lit("'"), t, F.lit("'")))
            .when(~t.contains('"'), F.concat(F.lit('"'), t, F.lit('"')))
            .otherwise(
                F.concat(F.lit("'"), F.replace(t, F.lit("'"), F.lit("\\'")), F.lit("'"))
            )
        )

    return F.concat(
        F.lit("["), F.array_join(F.transform(as_column(items), written), ", "), F.lit("]")
    )


def is_non_blank(text: Column | str) -> Column:
    # ends at the first sign that is no white space
    return as_column(text).rlike(rf"(?s)(?!{lookups.SPACE}).")


def nutrition_values(values: Column | str) -> list[Column]:
    """The seven nutrition columns in their fixed order."""
    values = as_column(values)
    return [F.get(values, i).alias(n) for i, n in enumerate(lookups.NUTRITION_COLUMNS)]


def number_unit_pairs(text: Column | str) -> Column:
    """Distinct ``(number, unit)`` mentions."""
    text = as_column(text)
    pattern = F.lit(rf"({lookups.NUMBER})\s*({'|'.join(lookups.DIFF_UNITS)})")
    return F.array_distinct(
        F.arrays_zip(
            F.regexp_extract_all(text, pattern, F.lit(1)).alias("number"),
            F.regexp_extract_all(text, pattern, F.lit(2)).alias("unit"),
        )
    )


# --- titles ------------------------------------------------------------------

# Plural noun endings and what they become; the first that fits is used.
PLURAL_ENDINGS = (
    (r"(ss|us|is)$", "$1"),
    (r"([a-z]{2,})ies$", "$1y"),
    (r"(ch|sh|s|x|z)es$", "$1"),
    (r"([a-z]{2,})ves$", "$1f"),
    (r"men$", "man"),
    (r"([a-z]{2,})s$", "$1"),
)


def strip_title(text: Column | str) -> Column:
    """Lower-case and keep only ``a-z`` and white space."""
    # the wide class of white space is asked only about what the narrow one lets through
    return F.regexp_replace(F.lower(as_column(text)), rf"[^a-z ](?<!{lookups.SPACE})", "")


def title_tokens(text: Column | str) -> Column:
    return F.regexp_extract_all(strip_title(text), F.lit("[a-z]+"), F.lit(0))


def singular(token: Column) -> Column:
    """Noun singular by ending, for tokens no lemma table lists."""
    result = token
    for pattern, replacement in reversed(PLURAL_ENDINGS):
        result = F.when(
            token.rlike(pattern), F.regexp_replace(token, pattern, replacement)
        ).otherwise(result)
    return result


def drop_stop_words(tokens: Column | str, stop_words: Sequence[str]) -> Column:
    """Remove the listed words; order and repeated words stay."""
    words = sorted(set(stop_words))
    if not words:
        return as_column(tokens)
    return F.filter(as_column(tokens), lambda t: ~t.isin(words))


# --- display -----------------------------------------------------------------

def display_recipe(text: Column | str) -> Column:
    """Bold section headings, each numbered step on its own line."""
    result = as_column(text)
    for heading in ("Ingredients:", "Instructions:"):
        result = F.replace(result, F.lit(heading), F.lit(f"\n\n**{heading}**\n"))
    return F.regexp_replace(result, r"(\s)(\d+\.)", "\n$2")


__all__ = [
    "PLURAL_ENDINGS", "display_recipe", "drop_stop_words", "drop_tags", "find_tags",
    "is_non_blank", "join_ingredients", "join_steps", "list_text", "lower_each",
    "number_unit_pairs", "nutrition_values", "parse_number_list", "parse_string_list",
    "regex_sub_compute", "singular", "strip_title", "title_tokens",
]

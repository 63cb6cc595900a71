"""Bringing temperatures, lengths, weights, volumes and times to metric units.

Everything is a row-local expression: no shuffle, no lookup join, no Python.
Cheap regex tests stand in front of the costly parts, so that a text without a
number and a token unlike any unit take the short way.
"""

from __future__ import annotations

import re
from functools import cache, reduce

from pyspark import SparkContext
from pyspark.sql import Column
from pyspark.sql import functions as F

from mirepoix import lookups
from mirepoix.functions.core import (
    as_column,
    let,
    plain_number,
    regex_sub_compute,
    round_exact,
    single_spaced,
    whole_number,
    without_marks,
)

UNITS = list(lookups.UNIT_CATEGORIES)

# --- temperatures ------------------------------------------------------------


def f_to_c(fahrenheit: Column | str) -> Column:
    """Fahrenheit to whole degrees Celsius, ties to even."""
    return F.rint((as_column(fahrenheit) - 32) * 5.0 / 9.0).cast("long")


def f_to_c_decimal(fahrenheit: Column | str) -> Column:
    """Fahrenheit to Celsius with two decimals."""
    return round_exact((as_column(fahrenheit) - 32) * 5.0 / 9.0, 2)


def _celsius(number: Column) -> Column:
    return F.concat(number, F.lit(" " + lookups.CELSIUS))


def _converted(number: Column) -> Column:
    return _celsius(whole_number(F.rint((number.cast("double") - 32) * 5.0 / 9.0)))


def _truncated(number: Column) -> Column:
    return _celsius(whole_number(F.floor(number.cast("double")).cast("double")))


def _is_hot(number: Column) -> Column:
    return number.cast("double") > lookups.FAHRENHEIT_ABOVE


def temp_explicit_c(text: Column | str, marks: bool = True) -> Column:
    return regex_sub_compute(as_column(text), lookups.CELSIUS_EXPLICIT, [1], _truncated, marks)


def temp_attached_c(text: Column | str, marks: bool = True) -> Column:
    return regex_sub_compute(as_column(text), lookups.CELSIUS_ATTACHED, [1], _truncated, marks)


def temp_explicit_f(text: Column | str, marks: bool = True) -> Column:
    return regex_sub_compute(as_column(text), lookups.FAHRENHEIT_EXPLICIT, [1], _converted, marks)


def temp_attached_f(text: Column | str, marks: bool = True) -> Column:
    return regex_sub_compute(as_column(text), lookups.FAHRENHEIT_ATTACHED, [1], _converted, marks)


def temp_bare_degrees(text: Column | str, marks: bool = True) -> Column:
    return regex_sub_compute(
        as_column(text), lookups.BARE_DEGREES, [0, 1],
        lambda whole, n: F.when(_is_hot(n), _converted(n)).otherwise(whole),
        marks,
    )


def _temp_after(text: Column, pattern: str, marks: bool) -> Column:
    return regex_sub_compute(
        text, pattern, [0, 1, 2],
        lambda whole, context, n: F.when(
            _is_hot(n), F.concat(context, F.lit(" "), _converted(n))
        ).otherwise(whole),
        marks,
    )


def temp_context(text: Column | str, marks: bool = True) -> Column:
    return _temp_after(as_column(text), lookups.OVEN_CONTEXT, marks)


def temp_bake_at(text: Column | str, marks: bool = True) -> Column:
    return _temp_after(as_column(text), lookups.BAKE_CONTEXT, marks)


TEMPERATURE_RULES = (
    temp_explicit_c, temp_attached_c, temp_explicit_f, temp_attached_f,
    temp_bare_degrees, temp_context, temp_bake_at,
)


def standardize_temperature(text: Column | str) -> Column:
    """All temperature rules in order; a text without a digit is left alone."""
    return let(
        as_column(text),
        lambda t: F.when(
            t.rlike(r"\d"), reduce(lambda acc, rule: rule(acc, marks=False), TEMPERATURE_RULES, without_marks(t))
        ).otherwise(without_marks(t)),
    )


# --- lengths -----------------------------------------------------------------


def _cm(inches: Column) -> Column:
    return plain_number(round_exact(inches.cast("double") * F.lit(lookups.INCH_IN_CM), 1))


def dim_to_cm(text: Column | str, marks: bool = True) -> Column:
    """``9x13`` as ``22.9x33.0 cm``."""
    return regex_sub_compute(
        as_column(text), lookups.DIMENSIONS, [1, 2],
        lambda a, b: F.concat(_cm(a), F.lit("x"), _cm(b), F.lit(" " + lookups.CM)),
        marks,
    )


def inch_to_cm(text: Column | str, marks: bool = True) -> Column:
    return regex_sub_compute(
        as_column(text), lookups.INCHES, [1],
        lambda a: F.concat(_cm(a), F.lit(" " + lookups.CM)),
        marks,
    )


# --- unit terms --------------------------------------------------------------

# A token matches a unit when 200 * LCS / (len(token) + len(unit)) > 80. For
# token length n and unit length m this means LCS > 0.4 * (n + m). Units of one
# or two characters can then only match themselves.
_FUZZY_UNITS = [(u, i) for i, u in enumerate(UNITS) if len(u) > 2]


def _least_lcs(n: int, m: int) -> int:
    return 4 * (n + m) // 10 + 1


def _lengths(unit: str) -> list[int]:
    """Token lengths at which a match with the unit is possible."""
    m = len(unit)
    return [n for n in range(1, 3 * m) if _least_lcs(n, m) <= min(n, m)]


def _pieces(unit: str, missing: int) -> list[str]:
    """With at most ``missing`` letters lost, one of these pieces is complete."""
    cuts = [round(i * len(unit) / (missing + 1)) for i in range(missing + 2)]
    return [unit[a:b] for a, b in zip(cuts, cuts[1:])]


def _in_order(letters: str) -> str:
    return "".join(f"[^ {c}]*+{c}" for c in letters)


def _like(unit: str, n: int) -> list[str]:
    """Patterns one of which every token of length n similar to the unit fits."""
    m, common = len(unit), _least_lcs(n, len(unit))
    if common == n:  # the token is the unit with letters left out
        return ["".join(f"{c}?" for c in unit) + "(?![^ ])"]
    if common == m:  # the token is the unit with letters put in
        return [_in_order(unit)]
    return [_in_order(piece) for piece in _pieces(unit, m - common)]


def _unit_like() -> str:
    """A pattern that every token similar to a unit fits, by token length.

    The length is halved down to, not tried one by one: a text has many words and few are units.
    """
    by_length: dict[int, set[str]] = {}
    for unit, _ in _FUZZY_UNITS:
        for n in _lengths(unit):
            by_length.setdefault(n, set()).update(_like(unit, n))

    def between(low: int, high: int) -> str:
        """For tokens of at least ``low`` and fewer than ``high`` letters."""
        if high - low == 1:
            return f"(?:{'|'.join(sorted(by_length[low]))})"
        middle = (low + high) // 2
        halves = ((f"(?![^ ]{{{middle}}})", low, middle), (f"(?=[^ ]{{{middle}}})", middle, high))
        return "(?:" + "|".join(
            test + between(a, b) for test, a, b in halves if any(a <= n < b for n in by_length)
        ) + ")"

    longer = max(by_length) + 1
    return f"(?![^ ]{{{longer}}}){between(0, longer)}"


def _any_of(words: list[str]) -> str:
    """Alternation of fixed words, grouped by first letter."""
    groups: dict[str, list[str]] = {}
    for w in words:
        groups.setdefault(w[0], []).append(re.escape(w[1:]))
    return "|".join(
        f"{re.escape(c)}(?:{'|'.join(sorted(rest, key=len, reverse=True))})"
        for c, rest in sorted(groups.items())
    )


# Entries without a letter are never reached: such tokens stay as they are.
_TERMS = {
    **{u: u for u in UNITS},
    **{k: v for k, v in lookups.TERM_CORRECTIONS.items() if any(c.isalpha() for c in k)},
}
_TOKENS = [k for k in _TERMS if " " not in k]

# Tokens that may need a correction or may be a unit. All others are passed over
# by the regex engine without touching an expression.
CANDIDATE = rf"(?<![^ ])(?:(?:{_any_of(_TOKENS)})(?![^ ])|(?:{_unit_like()})[^ ]*)"


def _sql_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _sql_map(entries: dict[str, object]) -> str:
    def written(value: object) -> str:
        if isinstance(value, str):
            return _sql_text(value)
        return f"{value!r}D" if isinstance(value, float) else repr(value)

    cells = [f"{_sql_text(k)}, {written(v)}" for k, v in entries.items()]
    return f"map({', '.join(cells)})"


def _unit_table() -> Column:
    """The units for similarity, as one constant: name, place, lengths, letter bits."""
    rows = []
    for unit, place in _FUZZY_UNITS:
        bits = {c: sum(1 << i for i, d in enumerate(unit) if d == c) for c in unit}
        lengths = _lengths(unit)
        rows.append(
            f"named_struct('name', {_sql_text(unit)}, 'place', {place}, 'size', {len(unit)}, "
            f"'lo', {min(lengths)}, 'hi', {max(lengths)}, 'full', {(1 << len(unit)) - 1}, "
            f"'bits', {_sql_map(bits)})"
        )
    return F.expr(f"array({', '.join(rows)})")


def _indel_share(letters: Column, unit: Column) -> Column:
    """Inserted plus deleted letters over the summed lengths of token and unit.

    The longest common subsequence is counted bit-parallel: one bit per unit
    letter, cleared once matched.
    """
    def step(state: Column, letter: Column) -> Column:
        bit = F.coalesce(F.try_element_at(unit.getField("bits"), letter), F.lit(0))
        hit = state.bitwiseAND(bit)
        return (state + hit).bitwiseOR(state - hit).bitwiseAND(unit.getField("full"))

    left = F.bit_count(F.aggregate(letters, unit.getField("full"), step))
    size = unit.getField("size")
    return (F.size(letters) + size - 2 * (size - left)) / (F.size(letters) + size)


def closest_unit(token: Column) -> Column:
    """The most similar unit if similar enough (first listed on a tie), else NULL."""
    def near(unit: Column, size: Column) -> Column:
        # a replaced letter is one edit but two of the indel share: no unit within the share is lost
        edits = F.levenshtein(token, unit.getField("name"))
        return size.between(unit.getField("lo"), unit.getField("hi")) & (edits * 5 < size + unit.getField("size"))

    def best(letters: Column) -> Column:
        possible = F.filter(_unit_table(), lambda u: near(u, F.size(letters)))
        scored = F.transform(
            possible,
            lambda u: F.struct(
                _indel_share(letters, u).alias("share"), u.getField("place").alias("place"),
                u.getField("name").alias("unit"),
            ),
        )
        return F.array_min(F.filter(scored, lambda s: s.getField("share") < 0.2)).getField("unit")

    return let(F.split(token, ""), best)


def listed_term(token: Column | str) -> Column:
    """The listed correction of a token, else the token."""
    token = as_column(token)
    return F.coalesce(F.try_element_at(F.expr(_sql_map(_TERMS)), token), token)


def _candidate_term(token: Column) -> Column:
    return F.coalesce(
        F.try_element_at(F.expr(_sql_map(_TERMS)), token), closest_unit(token), token
    )


def correct_term(token: Column | str) -> Column:
    """Listed correction, else the closest unit, else the token itself."""
    token = as_column(token)
    return F.when(token.rlike(CANDIDATE), _candidate_term(token)).otherwise(token)


def unit_factor(unit: Column | str) -> Column:
    factors = F.expr(_sql_map(lookups.UNIT_FACTORS))
    return F.coalesce(F.try_element_at(factors, as_column(unit)), F.lit(1.0))


def unit_category(unit: Column | str) -> Column:
    return F.try_element_at(F.expr(_sql_map(lookups.UNIT_CATEGORIES)), as_column(unit))


def convert_unit(value: Column | str, unit: Column | str) -> Column:
    """``value`` of ``unit`` as text in the target unit; NULL if it is no unit."""
    return F.concat(
        plain_number(as_column(value) * unit_factor(unit)), F.lit(" "), unit_category(unit)
    )


def range_mean(text: Column | str) -> Column:
    """Mean of ``a-b``; NULL if the text is no numeric range."""
    text = as_column(text)
    ends = F.split(text, "-")
    return F.when(
        text.rlike(rf"^{lookups.NUMBER}-{lookups.NUMBER}$"),
        (F.get(ends, 0).cast("double") + F.get(ends, 1).cast("double")) / 2,
    )


# --- the token scan ----------------------------------------------------------

# The text becomes words with one space between them, and each candidate token
# becomes "word TAB corrected TAB U?", with U for a known unit; white space never
# occurs inside a word. A greedy left-to-right scan over the words is then one
# alternation. A space inside a corrected term is kept as a line break.
_N = r"\d+(?:\.\d+)?"
_UNIT = r"[^ \t]++\t[^\t]*+\tU"
MEASURES = (
    r"(?<![^ ])(?:"
    rf"{_N} / {_N}(?: {_UNIT})?"
    rf"|{_N}-{_N} {_UNIT}"
    rf"|\d+ to (?:\d+\.?\d*|\.\d+) {_UNIT}"
    rf"|{_N} {_UNIT}"
    r")(?![^ ])"
)


def _mark(word: Column) -> Column:
    return let(
        _candidate_term(word),
        lambda c: F.concat(
            word, F.lit("\t"), F.translate(c, " ", "\n"),
            F.when(c.isin(UNITS), F.lit("\tU")).otherwise(F.lit("\t")),
        ),
    )


def _measure(found: Column) -> Column:
    """The replacement of one matched run of words."""
    def written(parts: Column) -> Column:
        text, words, unit = (parts.getField(n) for n in ("text", "words", "unit"))

        def number(at: int) -> Column:
            return F.get(words, at).cast("double")

        first, second = F.get(words, 0), F.get(words, 1)
        value = (
            F.when(second == "/", F.try_divide(number(0), number(2)))
            .when(first.contains("-"), range_mean(first))
            .when(second == "to", (number(0) + number(2)) / 2)
            .otherwise(number(0))
        )
        # NULL value: a zero denominator, the words stay; NULL unit: a bare fraction
        return F.coalesce(convert_unit(value, unit), plain_number(value), text)

    # the words before the first TAB, cut once, then the corrected unit if there is one
    text = F.substring_index(found, "\t", 1)
    unit = F.get(F.split(found, "\t"), 1)
    return let(F.struct(text.alias("text"), F.split(text, " ").alias("words"), unit.alias("unit")), written)


def scan_measures(text: Column | str, marks: bool = True) -> Column:
    """The token scan: fractions, ranges and numbers with units, corrected terms."""
    spaced = single_spaced(F.lower(as_column(text)))
    marked = regex_sub_compute(spaced, CANDIDATE, [0], _mark, marks)
    measured = regex_sub_compute(marked, MEASURES, [0], _measure, marks=False)
    return F.translate(
        F.regexp_replace(measured, r"(?<![^ ])[^ \t]++\t([^\t]*+)\tU?", "$1"), "\n", " "
    )


def _whole(text: Column | str) -> Column:
    temperatures = standardize_temperature(text)
    return scan_measures(inch_to_cm(dim_to_cm(temperatures, marks=False), marks=False), marks=False)


@cache
def _standardized(name: str, session: int) -> Column:
    return _whole(name)


def standardize_units(text: Column | str) -> Column:
    """Temperatures, then lengths, then the token scan.

    The expression is large; for a column given by name it is built once per driver.
    """
    if isinstance(text, str):
        return _standardized(text, id(SparkContext._gateway))
    return _whole(text)

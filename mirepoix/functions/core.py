"""Small building blocks the other column functions share."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mirepoix.lookups import SPACE



def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it many times in ``body``.

    Lambda variables are bound, not substituted, so a chain of ``let`` grows
    linearly where plain nesting would repeat the inner expression.
    """
    return F.get(F.transform(F.array(value), body), 0)


def once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add costly columns so that later filters use the values, not the expressions.

    A filter on a projected column is pushed below the projection with the whole
    expression in it, which would then run twice. A generator over a one-element
    array is a boundary the optimizer does not substitute across, and it stays
    within the same stage.
    """
    rest = [c for c in df.columns if c not in columns]
    made = F.struct(*[e.alias(n) for n, e in columns.items()])
    return df.select(*rest, F.inline(F.array(made)))


def as_column(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def split_words(text: Column) -> Column:
    """Non-empty white-space separated words."""
    return F.filter(F.split(text, SPACE + "+"), lambda w: w != "")


# A run of white space that is more than the one blank it becomes; all white space but
# the blank lies outside the printable ASCII signs.
_WIDE_SPACE = rf" {SPACE}+|(?=[^ -~]){SPACE}+"


def single_spaced(text: Column) -> Column:
    """The words with one space between them."""
    return F.trim(F.regexp_replace(text, _WIDE_SPACE, " "))


def strip_space(text: Column) -> Column:
    """Remove white space of any kind at both ends.

    The look-behind keeps a long run of blanks inside a text from being tried at
    each of its places.
    """
    return F.regexp_replace(text, rf"^{SPACE}++|(?<!{SPACE}){SPACE}++\z", "")


# Unicode noncharacters, reserved for use inside a program: they mark the matches.
# A text must not bring its own, so they are taken out of it first.
_MATCH, _GROUP = "\ufdd0", "\ufdd1"
EDGE = _MATCH


def without_marks(text: Column) -> Column:
    """The text without the marks that ``regex_sub_compute`` sets; ``text`` should be bound."""
    found = text.contains(_MATCH) | text.contains(_GROUP)
    return F.when(found, F.translate(text, _MATCH + _GROUP, "")).otherwise(text)


def regex_sub_compute(
    text: Column, pattern: str, groups: Sequence[int], fn: Callable[..., Column], marks: bool = True
) -> Column:
    """Replace every match of ``pattern`` by a value computed from its groups.

    ``fn`` gets one column per entry of ``groups`` (0 is the whole match). One
    ``regexp_replace`` puts marks around the wanted groups of each match; cut at
    the marks, every second piece is a match. The pattern is compiled once per
    task and runs once over the text. ``marks=False``: the text has no marks of its
    own, as the outcome of an earlier replacement has not.

    Every bound variable costs the analyser rounds, which add up over a chain of
    replacements: nothing is bound here but the pieces.
    """
    template = _MATCH + _GROUP.join(f"${g}" for g in groups) + _MATCH

    def computed(piece: Column) -> Column:
        if len(groups) == 1:
            return fn(piece)
        cut = F.split(piece, _GROUP)
        return fn(*[F.get(cut, i) for i in range(len(groups))])

    clean = let(text, without_marks) if marks else text
    pieces = F.transform(
        F.split(F.regexp_replace(clean, pattern, template), _MATCH),
        lambda p, i: F.when(i % 2 == 1, computed(p)).otherwise(p),
    )
    return F.array_join(pieces, "")


_SPLITTER = 134217729.0  # 2**27 + 1: cuts a double into two halves of 26 bits


def round_exact(value: Column, digits: int) -> Column:
    """Round the binary value itself, true ties to even.

    ``F.round`` rounds the shortest decimal text: 2.5 * 2.54 prints as 6.35 and
    would become 6.4, though the double lies below 6.35. Where the scaled value
    looks like a tie, the error of the scaling, computed exactly, decides.
    """
    scale = float(10**digits)

    def rounded(x: Column) -> Column:
        scaled = x * scale
        wide = x * _SPLITTER
        high = wide - (wide - x)
        error = (high * scale - scaled) + (x - high) * scale
        below = F.floor(scaled).cast("double")
        tie = scaled - below == 0.5
        whole = (
            F.when(tie & (error < 0), below)
            .when(tie & (error > 0), below + 1)
            .otherwise(F.rint(scaled))
        )
        return F.when(F.abs(scaled) < 1e15, whole / scale).otherwise(x)

    return let(value, rounded)


def plain_number(value: Column) -> Column:
    """A double as text with at least one decimal.

    An exponent is written only below 0.0001 and from 1e16 on, as ``5e-05``.
    """
    def written(value: Column) -> Column:
        text, size = value.cast("string"), F.abs(value)
        places = F.when(size < 1, value.try_cast("decimal(38,30)").cast("string")).otherwise(
            value.try_cast("decimal(38,10)").cast("string")
        )
        power = F.split_part(text, F.lit("E"), F.lit(2))
        digits = F.translate(power, "-", "")
        exponent = F.concat(
            F.regexp_replace(F.split_part(text, F.lit("E"), F.lit(1)), r"\.0$", ""),
            F.when(power.startswith("-"), "e-").otherwise("e+"),
            F.when(F.length(digits) < 2, "0").otherwise(""),
            digits,
        )
        return (
            F.when(~text.contains("E"), text)
            .when((size < 1e-4) | (size >= 1e16), exponent)
            .otherwise(F.coalesce(F.regexp_replace(places, r"(\.\d+?)0+$", "$1"), text))
        )

    return let(value, written)


def whole_number(value: Column) -> Column:
    """A double without fraction as text: no decimals, no exponent, no overflow."""
    return F.coalesce(value.try_cast("decimal(38,0)").cast("string"), value.cast("string"))


def title_case(text: Column) -> Column:
    """Upper-case every letter that follows a non-letter, lower-case the rest."""
    return regex_sub_compute(
        text, r"\p{L}+", [0],
        lambda w: F.concat(F.upper(F.left(w, F.lit(1))), F.lower(F.substr(w, F.lit(2)))),
    )


def no_strings() -> Column:
    return F.array().cast("array<string>")


def surplus(items: Column) -> Column:
    """The second and later copies of every element, sorted."""
    return let(
        F.sort_array(items), lambda s: F.filter(s, lambda x, i: (i > 0) & (x == F.get(s, i - 1)))
    )


def number_copies(ordered: Column) -> Column:
    """Number equal neighbours of a sorted list: ``[a, a, b]`` becomes hashes of ``a 1, a 2, b 1``.

    Turns a multiset into a set, so that the hash-based array functions can be
    used on it. Only the run starts are looked up by index, so it is linear.
    """
    def runs(starts: Column) -> Column:
        return F.flatten(
            F.transform(
                starts,
                lambda at, k: F.transform(
                    F.sequence(F.lit(1), F.coalesce(F.get(starts, k + 1), F.size(ordered)) - at),
                    lambda j: F.xxhash64(F.get(ordered, at), j),
                ),
            )
        )

    starts = F.filter(
        F.sequence(F.lit(0), F.size(ordered) - 1),
        lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1)),
    )
    return F.when(F.size(ordered) > 0, let(starts, runs)).otherwise(F.array().cast("array<bigint>"))


def common_count(a: Column, b: Column) -> Column:
    """Size of the multiset intersection of two arrays.

    Distinct common elements are counted by hashing. What copies add is counted
    on the surplus copies alone, and only if both sides have any.
    """
    def copies(x: Column, y: Column) -> Column:
        return F.when(
            (F.size(x) > 0) & (F.size(y) > 0),
            F.size(F.array_intersect(number_copies(x), number_copies(y))),
        ).otherwise(0)

    repeated = (F.size(F.array_distinct(a)) < F.size(a)) & (
        F.size(F.array_distinct(b)) < F.size(b))
    return F.size(F.array_intersect(a, b)) + F.when(
        repeated, let(surplus(a), lambda x: let(surplus(b), lambda y: copies(x, y)))
    ).otherwise(0)

"""From a raw recipe table to the cleaned one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mirepoix import lookups
from mirepoix.functions import text, units
from mirepoix.functions.core import once
from mirepoix.operators.ordering import with_row_index


def drop_columns(df: DataFrame, names: Sequence[str] = lookups.DROPPED_COLUMNS) -> DataFrame:
    """Drop columns; names the table does not have are ignored."""
    return df.drop(*names)


def drop_nulls(df: DataFrame, subset: Sequence[str] = ("name", "description")) -> DataFrame:
    return df.dropna(subset=list(subset))


def filter_minutes(df: DataFrame, limit: int = lookups.MINUTES_LIMIT) -> DataFrame:
    return df.filter(F.col("minutes") < limit)


def parse_lists(df: DataFrame, strict: bool = False) -> DataFrame:
    """Parse the list-literal columns of a raw recipe table."""
    parsed = {c: text.parse_string_list(c, strict) for c in ("tags", "steps", "ingredients")}
    parsed["nutrition"] = text.parse_number_list("nutrition", strict)
    return df.withColumns({c: e for c, e in parsed.items() if c in df.columns})


def count_malformed(df: DataFrame) -> DataFrame:
    """Rows whose list literal is present but cannot be parsed, per column."""
    parsed = {c: text.parse_string_list(c) for c in ("tags", "steps", "ingredients")}
    parsed["nutrition"] = text.parse_number_list("nutrition")
    return df.agg(*[
        F.count_if(F.col(c).isNotNull() & values.isNull()).alias(c) for c, values in parsed.items()
    ])


def normalize_columns(df: DataFrame) -> DataFrame:
    """Lower-case the description and every tag, step and ingredient."""
    return df.withColumns({
        "description": F.lower("description"),
        **{c: text.lower_each(c) for c in ("tags", "steps", "ingredients")},
    })


def expand_nutrition(df: DataFrame, check_all: bool = True) -> DataFrame:
    """Replace ``nutrition`` by seven columns.

    With ``check_all`` the table is left alone unless every row holds a list,
    which costs one pass over that column; without it a row without a list
    gets NULLs.
    """
    if check_all:
        complete = df.agg(F.min(F.col("nutrition").isNotNull()).alias("ok")).first()
        if complete is None or not complete.ok:
            return df
    rest = [c for c in df.columns if c != "nutrition"]
    return df.select(*rest, *text.nutrition_values("nutrition"))


def filter_nonblank(df: DataFrame, column: str = "steps_string_standardize") -> DataFrame:
    return df.filter(text.is_non_blank(column))


def row_index(df: DataFrame, order_by: str = "id", name: str = "index") -> DataFrame:
    return with_row_index(df, [order_by], name)


def tag_search(df: DataFrame, keyword: str) -> DataFrame:
    """Rows with at least one tag containing the keyword, with those tags."""
    return df.withColumn("tags", text.find_tags("tags", keyword)).filter(F.size("tags") > 0)


def lookup_by_id(df: DataFrame, key: int, columns: Sequence[str]) -> DataFrame:
    return df.filter(F.col("id") == key).select(*columns)


def number_unit_diff(
    df: DataFrame, before: str = "steps_strings", after: str = "steps_string_standardize"
) -> DataFrame:
    """Number and unit mentions found only after or only before standardising."""
    new, old = text.number_unit_pairs(after), text.number_unit_pairs(before)
    return df.withColumns({
        "only_in_standardize": F.array_except(new, old),
        "only_in_not_standardize": F.array_except(old, new),
    })


def clean_recipes(
    df: DataFrame, index: bool = False, strict: bool = False, standardize: bool = True
) -> DataFrame:
    """The whole cleaning of a raw recipe table.

    One narrow plan: filters and projections only, so it reads, filters and
    writes in a single stage. Filters come before the list columns are parsed.
    ``index=True`` adds the row position among the kept recipes, which needs a
    global order (see ``with_row_index``). A malformed list literal is NULL, and
    without steps the row goes (``count_malformed`` counts them); with ``strict``
    it is an error. ``standardize=False`` leaves the standardised text out, for
    statistics that do not read it.
    """
    kept = drop_nulls(filter_minutes(drop_columns(df)))
    if index:
        kept = row_index(kept)
    parsed = normalize_columns(parse_lists(kept, strict))
    # Standardising never empties a text, so the blank test needs the raw steps only.
    # Joined once: the filter would else parse them a second time, before a shuffle that spreads the rows.
    parsed = once(parsed, {"_steps": text.join_steps("steps")}).filter(text.is_non_blank("_steps"))
    standard = {"steps_string_standardize": units.standardize_units("_steps")} if standardize else {}
    with_text = parsed.withColumns({
        **standard,
        "ingredients_text": text.join_ingredients("ingredients"),
        "tags_text": text.list_text(text.drop_tags("tags")),
    })
    return expand_nutrition(with_text, check_all=False).drop(
        "nutrition_score", "ingredients", "steps", "tags", "_steps"
    )

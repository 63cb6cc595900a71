"""Queries: projection, parsing, normalisation, titles."""

from __future__ import annotations

from pyspark.sql import functions as F

from mirepoix import lookups
from mirepoix.functions import text, units
from mirepoix.functions.core import once
from mirepoix.operators import cleaning, titles
from mirepoix.plans.registry import query
from mirepoix.plans.views import CELSIUS_OF_STEP, NUTRITION, STEPS_STANDARD, clean, documents, parts, recipes, with_views

CLEAN_COLUMNS = (
    "id", "name", "minutes", "n_steps", "description", "n_ingredients",
    "steps_string_standardize", "ingredients_text", "tags_text", *lookups.NUTRITION_COLUMNS,
)


@query("parse_list_literal", with_views("recipes_src", """
SELECT id, 3 AS n_tags, '30-minutes-or-less|Easy|' || p_type AS tags, 4 AS n_steps_listed,
       'Bake ' || (10 + p_size) || ' min' AS last_step, 7 AS n_values,
       CAST((p_size % 10) * 250 + id % 60 AS DOUBLE) AS first_and_last FROM recipes_src"""))
def parse_list_literal(spark, sf_dir):
    parsed = cleaning.parse_lists(recipes(spark, sf_dir))
    return parsed.select(
        "id", F.size("tags").alias("n_tags"), F.array_join("tags", "|").alias("tags"),
        F.size("steps").alias("n_steps_listed"), F.get("steps", F.lit(3)).alias("last_step"),
        F.size("nutrition").alias("n_values"),
        (F.get("nutrition", F.lit(0)) + F.get("nutrition", F.lit(6))).alias("first_and_last"),
    )


@query("drop_columns", with_views("recipes_src", """
SELECT id, name, minutes, tags, nutrition, n_steps, steps, description, ingredients,
       n_ingredients, cuisine FROM recipes_src"""))
def drop_columns(spark, sf_dir):
    names = (*lookups.DROPPED_COLUMNS, "nutrition_score", "p_name", "p_size", "p_type")
    return cleaning.drop_columns(recipes(spark, sf_dir), names)


@query("drop_nulls", with_views("recipes_src", """
SELECT id, name, description FROM recipes_src WHERE name IS NOT NULL AND description IS NOT NULL"""))
def drop_nulls(spark, sf_dir):
    return cleaning.drop_nulls(recipes(spark, sf_dir)).select("id", "name", "description")


@query("filter_minutes", with_views("recipes_src", """
SELECT id, minutes FROM (
  SELECT id, CASE WHEN id % 17 = 0 THEN NULL ELSE minutes END AS minutes FROM recipes_src) AS r
WHERE minutes < 300"""))
def filter_minutes(spark, sf_dir):
    rows = recipes(spark, sf_dir).select(
        "id", F.expr("CASE WHEN id % 17 = 0 THEN NULL ELSE minutes END AS minutes")
    )
    return cleaning.filter_minutes(rows)


@query("normalize_columns", with_views("recipes_src", """
SELECT id, lower(description) AS description, '30-minutes-or-less|easy|' || lower(p_type) AS tags,
       'flour|milk|' || lower(p_name) AS ingredients FROM recipes_src"""))
def normalize_columns(spark, sf_dir):
    rows = cleaning.normalize_columns(cleaning.parse_lists(recipes(spark, sf_dir)))
    return rows.select(
        "id", "description", F.array_join("tags", "|").alias("tags"),
        F.array_join("ingredients", "|").alias("ingredients"),
    )


@query("join_steps", with_views("recipes_src", """
SELECT id, 'Preheat oven to ' || (300 + p_size * 5) || ' degrees F Add 2-3 cups milk '
       || 'Cut 1 / 2 inch slices Bake ' || (10 + p_size) || ' min' AS steps_strings
FROM recipes_src"""))
def join_steps(spark, sf_dir):
    parsed = cleaning.parse_lists(recipes(spark, sf_dir))
    return parsed.select("id", text.join_steps("steps").alias("steps_strings"))


@query("join_ingredients", with_views("recipes_src", """
SELECT id, 'Flour, Milk, ' || p_name AS ingredients_text FROM recipes_src"""))
def join_ingredients(spark, sf_dir):
    parsed = cleaning.parse_lists(recipes(spark, sf_dir))
    return parsed.select("id", text.join_ingredients("ingredients").alias("ingredients_text"))


@query("filter_tags", with_views("recipes_src", """
SELECT id, 'Easy|' || p_type AS tags FROM recipes_src"""))
def filter_tags(spark, sf_dir):
    parsed = cleaning.parse_lists(recipes(spark, sf_dir))
    return parsed.select("id", F.array_join(text.drop_tags("tags"), "|").alias("tags"))


@query("tags_text", with_views("recipes_src", """
SELECT id, CASE WHEN id % 5 = 0 THEN '[]'
                ELSE '[' || chr(39) || 'Easy' || chr(39) || ', ' || chr(39) || p_type || chr(39) || ']'
           END AS tags_text FROM recipes_src"""))
def tags_text(spark, sf_dir):
    parsed = cleaning.parse_lists(recipes(spark, sf_dir))
    tags = F.when(F.col("id") % 5 == 0, F.array().cast("array<string>")).otherwise(
        text.drop_tags("tags")
    )
    return parsed.select("id", text.list_text(tags).alias("tags_text"))


@query("expand_nutrition", with_views("recipes_src", f"""
SELECT id, {', '.join(f'{e} AS {n}' for n, e in NUTRITION.items())} FROM recipes_src"""))
def expand_nutrition(spark, sf_dir):
    parsed = cleaning.parse_lists(recipes(spark, sf_dir).select(
        "id", "tags", "steps", "ingredients", "nutrition"))
    return cleaning.expand_nutrition(parsed).drop("tags", "steps", "ingredients")


@query("filter_nonblank", with_views("recipes_src", """
SELECT id, label FROM (
  SELECT id, CASE WHEN id % 13 = 0 THEN '   ' WHEN id % 7 = 0 THEN NULL ELSE p_name END AS label
  FROM recipes_src) AS r WHERE length(trim(label)) > 0"""))
def filter_nonblank(spark, sf_dir):
    rows = recipes(spark, sf_dir).select("id", F.expr(
        "CASE WHEN id % 13 = 0 THEN '   ' WHEN id % 7 = 0 THEN NULL ELSE p_name END AS label"))
    return cleaning.filter_nonblank(rows, "label")


@query("row_index", with_views("recipes_src", """
SELECT id, name, row_number() OVER (ORDER BY id) - 1 AS "index" FROM recipes_src
WHERE minutes < 300 AND description IS NOT NULL"""))
def row_index(spark, sf_dir):
    kept = cleaning.drop_nulls(cleaning.filter_minutes(recipes(spark, sf_dir)))
    return cleaning.row_index(kept.select("id", "name"))


@query("tag_search", with_views("recipes_src", """
SELECT id, p_type AS tags FROM recipes_src WHERE lower(p_type) LIKE '%eco%'"""))
def tag_search(spark, sf_dir):
    found = cleaning.tag_search(cleaning.parse_lists(recipes(spark, sf_dir)), "eco")
    return found.select("id", F.array_join("tags", "|").alias("tags"))


@query("lookup_by_id", with_views("recipes_src", f"""
SELECT id, name, {STEPS_STANDARD} AS steps_string_standardize FROM recipes_src WHERE id = 17"""))
def lookup_by_id(spark, sf_dir):
    steps = text.join_steps(text.lower_each(text.parse_string_list("steps")))
    rows = recipes(spark, sf_dir).withColumn("steps_string_standardize", units.standardize_units(steps))
    return cleaning.lookup_by_id(rows, 17, ["id", "name", "steps_string_standardize"])


@query("number_unit_diff", with_views("recipes_src", f"""
SELECT id, '0.6 liter|' || (10 + p_size) || '.0 minute|' || {CELSIUS_OF_STEP} || '.0 celsius'
           AS only_in_standardize,
       '3 cup|' || (300 + p_size * 5) || ' degre' AS only_in_not_standardize FROM recipes_src"""))
def number_unit_diff(spark, sf_dir):
    steps = text.join_steps(text.lower_each(text.parse_string_list("steps")))
    rows = recipes(spark, sf_dir).select("id", steps.alias("steps_strings")).withColumn(
        "steps_string_standardize", units.standardize_units("steps_strings")
    )

    def written(name: str):
        pairs = F.transform(name, lambda p: F.concat(
            p.getField("number"), F.lit(" "), p.getField("unit")))
        order = F.transform(pairs, lambda p: F.struct(
            F.length(F.substring_index(p, " ", 1)).alias("n"), p.alias("p")))
        # short numbers first: 0.6, then NN.0, then NNN.0
        return F.array_join(
            F.transform(F.array_sort(order), lambda s: s.getField("p")), "|"
        ).alias(name)

    diff = cleaning.number_unit_diff(rows)
    return diff.select("id", written("only_in_standardize"), written("only_in_not_standardize"))


@query("clean_recipes", with_views("clean", f"SELECT {', '.join(CLEAN_COLUMNS)} FROM clean"))
def clean_recipes(spark, sf_dir):
    return clean(spark, sf_dir).select(*CLEAN_COLUMNS)


@query("clean_recipes_indexed", with_views("clean", """
SELECT id, row_number() OVER (ORDER BY id) - 1 AS "index", steps_string_standardize FROM clean"""))
def clean_recipes_indexed(spark, sf_dir):
    rows = cleaning.clean_recipes(recipes(spark, sf_dir), index=True)
    return rows.select("id", "index", "steps_string_standardize")


# --- titles ------------------------------------------------------------------

# Caller-supplied words of these queries, on top of the English list.
HOUSE_WORDS = ("best", "recipe", "grandma", "easy", "favorite")
LEMMAS = (("children", "child"), ("geese", "goose"), ("leaves", "leaf"), ("bolt", "fastener"))


def lemma_table(spark):
    return spark.createDataFrame(list(LEMMAS), "token string, lemma string")


_BLANK = r"\s\x{{1c}}-\x{{1f}}\x{{85}}\x{{a0}}\x{{1680}}\x{{2000}}-\x{{200a}}\x{{2028}}\x{{2029}}\x{{202f}}\x{{205f}}\x{{3000}}"
_STRIPPED = "regexp_replace(lower({}), '[^a-z" + _BLANK + "]', '', 'g')"
_TOKENS = f"list_filter(regexp_split_to_array({_STRIPPED}, '[{_BLANK}]+'), lambda w: w <> '')"


def _sql_lemma(token: str) -> str:
    cases = [f"WHEN {token} = '{a}' THEN '{b}'" for a, b in LEMMAS]
    for pattern, replacement in text.PLURAL_ENDINGS:
        swapped = replacement.replace("$", "\\")
        cases.append(
            f"WHEN regexp_matches({token}, '{pattern}') "
            f"THEN regexp_replace({token}, '{pattern}', '{swapped}')"
        )
    return f"CASE {' '.join(cases)} ELSE {token} END"


def _sql_title(column: str, stop_words) -> str:
    words = ", ".join("'" + w.replace("'", "''") + "'" for w in sorted(set(stop_words)))
    lemmas = f"list_transform({_TOKENS.format(column)}, lambda t: {_sql_lemma('t')})"
    return f"array_to_string(list_filter({lemmas}, lambda t: t NOT IN ({words})), ' ')"


@query("title_strip", f"SELECT doc_id, {_STRIPPED.format('text')} AS stripped FROM documents")
def title_strip(spark, sf_dir):
    return documents(spark, sf_dir).select(
        "doc_id", text.strip_title("text").alias("stripped"))


@query("title_tokens", f"""
SELECT doc_id, len({_TOKENS.format('text')})::INT AS n_tokens,
       array_to_string({_TOKENS.format('text')}, '|') AS tokens FROM documents""")
def title_tokens(spark, sf_dir):
    rows = once(documents(spark, sf_dir), {"t": text.title_tokens("text")})
    return rows.select("doc_id", F.size("t").alias("n_tokens"), F.array_join("t", "|").alias("tokens"))


@query("title_lemmas", f"""
SELECT doc_id, array_to_string(list_transform({_TOKENS.format('text')}, lambda t: {_sql_lemma('t')}),
       ' ') AS lemmas FROM documents""")
def title_lemmas(spark, sf_dir):
    rows = documents(spark, sf_dir).select("doc_id", text.title_tokens("text").alias("t"))
    return titles.title_lemmas(rows, "t", lemma_table(spark)).select(
        "doc_id", F.array_join("t", " ").alias("lemmas"))


@query("title_lemmas_joined", f"""
SELECT p_partkey AS id, array_to_string(list_transform({_TOKENS.format('p_name')},
       lambda t: {_sql_lemma('t')}), ' ') AS lemmas FROM part""")
def title_lemmas_joined(spark, sf_dir):
    rows = parts(spark, sf_dir).select(
        F.col("p_partkey").alias("id"), text.title_tokens("p_name").alias("t"))
    return titles.title_lemmas(rows, "t", lemma_table(spark)).select(
        "id", F.array_join("t", " ").alias("lemmas"))


@query("title_stopwords", """
SELECT p_partkey AS id, array_to_string(list_filter(
         string_split('the best ' || p_name || ' recipe for the best', ' '),
         lambda t: t NOT IN ('the', 'best', 'recipe', 'for')), ' ') AS tokens FROM part""")
def title_stopwords(spark, sf_dir):
    tokens = F.split(F.concat(F.lit("the best "), "p_name", F.lit(" recipe for the best")), " ")
    words = [*titles.english_stop_words(), *HOUSE_WORDS]
    return parts(spark, sf_dir).select(
        F.col("p_partkey").alias("id"),
        F.array_join(text.drop_stop_words(tokens, words), " ").alias("tokens"))


@query("clean_title", with_views("recipes_src", """
SELECT id, CASE WHEN p_name LIKE '%bolt%' THEN replace(p_name, 'bolt', 'fastener')
                ELSE p_name END AS cleaned_name FROM recipes_src"""))
def clean_title(spark, sf_dir):
    rows = recipes(spark, sf_dir).select("id", "name")
    cleaned = titles.clean_title(rows, "name", HOUSE_WORDS, lemma_table(spark))
    return cleaned.select("id", "cleaned_name")


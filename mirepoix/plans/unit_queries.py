"""Queries: unit standardisation.

One text per rule is built from ``part``; with p = p_size the expected text is
plain arithmetic, which the SQL side computes directly.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mirepoix import lookups
from mirepoix.functions import units
from mirepoix.functions.core import regex_sub_compute, split_words
from mirepoix.operators.evaluation import correct_vocabulary, vocabulary
from mirepoix.operators.terms import correct_terms
from mirepoix.plans.registry import query
from mirepoix.plans.views import STEPS_STANDARD, STEPS_TEXT, documents, parts, recipes, table, with_views
from mirepoix.session import store

_C = "CAST(CAST(round(({} - 32) * 5.0 / 9.0) AS INT) AS STRING)"
_F_TEXT, _N_TEXT = "CAST(300 + 5 * p AS STRING)", "CAST(150 + 5 * p AS STRING)"
_F_C, _N_C = _C.format("(300 + 5 * p)"), _C.format("(150 + 5 * p)")
_ABOVE = f"150 + 5 * p > {lookups.FAHRENHEIT_ABOVE}"
_CM = "CAST(round(2.54 * p, 1)::DOUBLE AS STRING)"
_CM4 = "CAST(round(2.54 * (p + 4), 1)::DOUBLE AS STRING)"


def _texts(spark, sf_dir, *texts: str):
    part = parts(spark, sf_dir).select("p_partkey", "p_size")
    rows = part.selectExpr("p_partkey AS id", "p_size AS p")
    return rows.selectExpr("id", "p", *texts)


def _rule(name: str, text: str, expected: str, fn) -> None:
    """Register ``fn`` over one text per part against the expected text."""
    sql = f"SELECT id, {expected} AS result FROM (SELECT p_partkey AS id, p_size AS p FROM part) AS t"

    @query(name, sql)
    def run(spark, sf_dir):
        rows = _texts(spark, sf_dir, f"{text} AS t")
        return rows.select("id", fn("t").alias("result"))


_rule("temp_explicit_c", "concat('hold at ', CAST(100 + p AS STRING), ' degrees C')",
      "concat('hold at ', CAST(100 + p AS STRING), ' celsius')", units.temp_explicit_c)
_rule("temp_attached_c", "concat('hold at ', CAST(100 + p AS STRING), 'c')",
      "concat('hold at ', CAST(100 + p AS STRING), ' celsius')", units.temp_attached_c)
_rule("temp_explicit_f", f"concat('hold at ', {_F_TEXT}, ' degrees F')",
      f"concat('hold at ', {_F_C}, ' celsius')", units.temp_explicit_f)
_rule("temp_attached_f", f"concat('hold at ', {_F_TEXT}, 'f')",
      f"concat('hold at ', {_F_C}, ' celsius')", units.temp_attached_f)
_rule("temp_bare_degrees", f"concat('hold at ', {_N_TEXT}, ' degrees')",
      f"concat('hold at ', CASE WHEN {_ABOVE} THEN concat({_N_C}, ' celsius') "
      f"ELSE concat({_N_TEXT}, ' degrees') END)", units.temp_bare_degrees)
_rule("temp_context", f"concat('preheat to ', {_N_TEXT})",
      f"concat('preheat to ', CASE WHEN {_ABOVE} THEN concat({_N_C}, ' celsius') "
      f"ELSE {_N_TEXT} END)", units.temp_context)
_rule("temp_bake_at", f"concat('bake at ', {_N_TEXT})",
      f"concat('bake at ', CASE WHEN {_ABOVE} THEN concat({_N_C}, ' celsius') "
      f"ELSE {_N_TEXT} END)", units.temp_bake_at)
_rule("standardize_temperature",
      f"concat('Heat to ', {_F_TEXT}, ' degrees, hold at ', {_F_TEXT}, 'F, then ', "
      f"CAST(100 + p AS STRING), '°C and bake ', {_N_TEXT}, ' minutes')",
      f"concat('Heat to ', {_F_C}, ' celsius, hold at ', {_F_C}, ' celsius, then ', "
      f"CAST(100 + p AS STRING), ' celsius and bake ', {_N_TEXT}, ' minutes')",
      units.standardize_temperature)
_rule("dim_to_cm", "concat(CAST(p AS STRING), 'x', CAST(p + 4 AS STRING), ' pan')",
      f"concat({_CM}, 'x', {_CM4}, ' cm pan')", units.dim_to_cm)
_rule("inch_to_cm", "concat(CAST(p AS STRING), chr(34), ' pan')",
      f"concat({_CM}, ' cm pan')", units.inch_to_cm)
_rule("scan_fraction", "concat(CAST(p AS STRING), ' / 4 cups milk')",
      "concat(CAST(p::DOUBLE / 4 * 0.24::DOUBLE AS STRING), ' liter milk')", units.standardize_units)
_rule("scan_range", "concat(CAST(p AS STRING), '-', CAST(p + 1 AS STRING), ' pounds beef')",
      "concat(CAST((2 * p + 1)::DOUBLE / 2 * 453.59::DOUBLE AS STRING), ' gram beef')",
      units.standardize_units)
_rule("scan_to_range", "concat(CAST(p AS STRING), ' to ', CAST(p + 2 AS STRING), ' ounces milk')",
      "concat(CAST((p + 1)::DOUBLE * 28.35::DOUBLE AS STRING), ' gram milk')",
      units.standardize_units)
_rule("convert_unit", "concat(CAST(p AS STRING), ' cups milk')",
      "concat(CAST(p::DOUBLE * 0.24::DOUBLE AS STRING), ' liter milk')", units.standardize_units)


@query("regex_sub_compute", """
SELECT p_partkey AS id, concat('take ', CAST(p_size * 2 AS STRING), ' of ',
       CAST(p_partkey * 2 AS STRING), ' left') AS result FROM part""")
def regex_sub_compute_query(spark, sf_dir):
    rows = parts(spark, sf_dir).selectExpr(
        "p_partkey AS id", "concat('take ', p_size, ' of ', p_partkey, ' left') AS t")

    def doubled(number: Column) -> Column:
        return (number.cast("long") * 2).cast("string")

    return rows.select("id", regex_sub_compute(F.col("t"), r"(\d+)", [1], doubled).alias("result"))


@query("f_to_c", """
SELECT p_partkey AS id, CAST(round_even((p_size * 9 - 100 - 32) * 5.0::DOUBLE / 9.0::DOUBLE, 0) AS BIGINT) AS whole,
       round((p_retailprice - 32) * 5.0::DOUBLE / 9.0::DOUBLE, 2) AS decimal FROM part""")
def f_to_c(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"),
        units.f_to_c((F.col("p_size") * 9 - 100).cast("double")).alias("whole"),
        units.f_to_c_decimal("p_retailprice").alias("decimal"),
    )


@query("range_mean", """
SELECT p_partkey AS id, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_size + 1.25::DOUBLE END AS mean
FROM part""")
def range_mean(spark, sf_dir):
    rows = parts(spark, sf_dir).selectExpr(
        "p_partkey AS id",
        "CASE WHEN p_partkey % 3 = 0 THEN concat(p_size, '-a') "
        "ELSE concat(p_size, '-', p_size + 2, '.5') END AS t")
    return rows.select("id", units.range_mean("t").alias("mean"))


# --- vocabulary --------------------------------------------------------------

_SPACE = r"[\s\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def _quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


_TERM_ROWS = ", ".join(
    f"({_quoted(k)}, {_quoted(v)})" for k, v in lookups.TERM_CORRECTIONS.items()
)
# Words of all documents, of all recipe steps and of a text with misspelt units.
_MISSPELT = "concat('min mm litr ', p_name, 's cupz quarte ', p_name, 'd minutse ', p_name)"
_WORDS = f"""
SELECT DISTINCT unnest(regexp_split_to_array(lower(t), '{_SPACE}')) AS token FROM (
  SELECT text AS t FROM documents UNION ALL SELECT {STEPS_TEXT} FROM recipes_src
  UNION ALL SELECT {_MISSPELT} FROM part) AS texts"""


def _all_texts(spark, sf_dir):
    docs = documents(spark, sf_dir).select(F.col("text").alias("t"))
    steps = recipes(spark, sf_dir).selectExpr(f"{STEPS_TEXT} AS t")
    return docs.union(steps).union(parts(spark, sf_dir).selectExpr(f"{_MISSPELT} AS t"))


@query("correct_term_dict", with_views("recipes_src", f"""
SELECT w.token, CASE WHEN regexp_matches(w.token, '\\p{{L}}') THEN coalesce(t.corrected, w.token)
                     ELSE w.token END AS listed
FROM words AS w LEFT JOIN terms AS t ON w.token = t.token WHERE w.token <> ''""",
    words=_WORDS, terms=f"SELECT * FROM (VALUES {_TERM_ROWS}) AS v(token, corrected)"))
def correct_term_dict(spark, sf_dir):
    words = vocabulary(_all_texts(spark, sf_dir), "t")
    return words.select("token", units.listed_term("token").alias("listed"))


_UNIT_ROWS = ", ".join(f"({_quoted(u)}, {i})" for i, u in enumerate(lookups.UNIT_CATEGORIES))


# Longest common subsequence by folding the token over a bit per unit letter. Letters put in and taken out
# are at least the edits, less the bytes that the token's letters have over one each: others cannot be alike.
_FUZZY_SQL = with_views("recipes_src", """
SELECT w.token, CASE WHEN NOT regexp_matches(w.token, '\\p{L}') THEN w.token
                     ELSE coalesce(t.corrected, b.unit, w.token) END AS corrected
FROM words AS w LEFT JOIN terms AS t ON w.token = t.token LEFT JOIN best AS b ON w.token = b.token
WHERE w.token <> ''""",
    words=_WORDS, terms=f"SELECT * FROM (VALUES {_TERM_ROWS}) AS v(token, corrected)",
    units=f"SELECT * FROM (VALUES {_UNIT_ROWS}) AS v(unit, place)",
    near="""
SELECT token, unit, place, length(token) AS n, length(unit) AS m FROM words, units
WHERE length(token) < 1.5 * length(unit) AND length(token) > 0.6 * length(unit)
  AND 5 * (levenshtein(token, unit) - (strlen(token) - length(token))) < length(token) + length(unit)""",
    folded="""
SELECT token, place, unit, n, m, list_reduce(
         list_transform(string_split(token, ''), lambda c: list_sum(list_transform(
           range(1, m + 1), lambda i: CASE WHEN substr(unit, i, 1) = c THEN 1::BIGINT << (i - 1)
                                           ELSE 0 END))::BIGINT),
         lambda v, h: ((v + (v & h)) | (v - (v & h))) & ((1::BIGINT << m) - 1),
         (1::BIGINT << m) - 1) AS state
FROM near""",
    best="""
SELECT token, arg_min(unit, (n + m - 2 * (m - bit_count(state))) / (n + m) * 1000000 + place) AS unit
FROM folded WHERE 5 * (n + m - 2 * (m - bit_count(state))) < n + m GROUP BY token""")


@query("correct_term_fuzzy", _FUZZY_SQL)
def correct_term_fuzzy(spark, sf_dir):
    return correct_vocabulary(_all_texts(spark, sf_dir), "t").select("token", "corrected")


# The words of all documents against the frequent ones among them. A letter that only one side has is an
# edit, and so is every byte by which levenshtein is short of the edits of an ASCII term.
_TABLE_SQL = f"""
WITH counted AS (
  SELECT token, count(*) AS c FROM (
    SELECT unnest(regexp_split_to_array(lower(text), '{_SPACE}')) AS token FROM documents) AS w
  WHERE token <> '' GROUP BY token),
spelt AS (
  SELECT token, any_value(c) AS c, bit_or(1::BIGINT << (unicode(letter) % 62)::INT) AS mask, length(token) AS n,
         strlen(token) - length(token) AS extra
  FROM (SELECT token, c, unnest(string_split(token, '')) AS letter FROM counted) AS l GROUP BY token),
terms AS (SELECT token AS term, mask, n AS m FROM spelt WHERE c >= 5 AND regexp_full_match(token, '[a-z]{{3,}}')),
near AS (
  SELECT token, term, n, m FROM spelt JOIN terms
    ON n < 1.5 * m AND m < 1.5 * n AND 5 * bit_count(xor(spelt.mask, terms.mask)) < n + m
  WHERE regexp_matches(token, '\\p{{L}}') AND 5 * (levenshtein(token, term) - extra) < n + m),
folded AS (
  SELECT token, term, n, m, list_reduce(
           list_transform(string_split(token, ''), lambda c: list_sum(list_transform(
             range(1, m + 1), lambda i: CASE WHEN substr(term, i, 1) = c THEN 1::BIGINT << (i - 1)
                                             ELSE 0 END))::BIGINT),
           lambda v, h: ((v + (v & h)) | (v - (v & h))) & ((1::BIGINT << m) - 1), (1::BIGINT << m) - 1) AS state
  FROM near),
ranked AS (
  SELECT token, term, n + m - 2 * (m - bit_count(state)) AS edits, row_number() OVER (
           PARTITION BY token ORDER BY (n + m - 2 * (m - bit_count(state)))::DOUBLE / (n + m), term) AS place
  FROM folded WHERE 5 * (n + m - 2 * (m - bit_count(state))) < n + m)
SELECT c.token, coalesce(r.term, c.token) AS corrected, r.edits::BIGINT AS edits
FROM counted AS c LEFT JOIN ranked AS r ON c.token = r.token AND r.place = 1"""


@query("correct_terms_table", _TABLE_SQL)
def correct_terms_table(spark, sf_dir):
    words = documents(spark, sf_dir).select(F.explode(split_words(F.lower("text"))).alias("token"))
    counted = store(words.groupBy("token").agg(F.count("*").alias("c")), "word-counts")
    terms = counted.filter((F.col("c") >= 5) & F.col("token").rlike(r"\A[a-z]{3,}\z"))
    return correct_terms(counted, terms, "token", "token")


# --- whole texts -------------------------------------------------------------


@query("standardize_units", with_views("recipes_src", f"""
SELECT id, {STEPS_STANDARD} AS standardized FROM recipes_src"""))
def standardize_units(spark, sf_dir):
    rows = recipes(spark, sf_dir).selectExpr("id", f"{STEPS_TEXT} AS t")
    return rows.select("id", units.standardize_units("t").alias("standardized"))


@query("standardize_documents")
def standardize_documents(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return docs.select("doc_id", units.standardize_units("text").alias("standardized"))



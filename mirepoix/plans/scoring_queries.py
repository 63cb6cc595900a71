"""Queries: scores of generated texts, structure checks, labels, verdicts."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from mirepoix import lookups
from mirepoix.functions import prompts, scoring, text
from mirepoix.operators import abbreviations, evaluation
from mirepoix.plans.registry import query
from mirepoix.plans.views import JUDGES, documents, generations, parts, replies, table, with_views

_BLANKS = r"[\s\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def re2(pattern: str) -> str:
    """A pattern in the other engine's spelling: code points in braces, no line-end flag (its dot stops at line feeds only)."""
    pattern = re.sub(r"\\u([0-9a-f]{4})", r"\\x{\1}", pattern)
    return pattern.replace("(?d)", "").replace("(?id)", "(?i)").replace("(?isd)", "(?is)")


def treebank(text: str) -> str:
    """The word rules as SQL: quotes, punctuation, brackets, dashes, contractions."""
    sql = f"lower(trim(regexp_replace({text}, '{_BLANKS}', ' ', 'g')))"
    for pattern, replacement in (
        (r"""(^|[ (\[{<])("|'''')""", r"\1 `` "),
        (r"(:|,)([^0-9])", r" \1 \2"),
        (r"(:|,)$", r" \1 "),
        (r"[.][.][.]", " ... "),
        (r"([;@#$%&])", r" \1 "),
        (r"""([^. ])[.]([\])}>"'']*)( |$)""", r"\1 . \2\3"),
        (r"([?!])", r" \1 "),
        (r"([^''])'' ", r"\1 '' "),
        (r"([\[\](){}<>])", r" \1 "),
        (r"--", " -- "),
        (r"""("|'''')""", r" '''' "),
    ):
        sql = f"regexp_replace({sql}, '{pattern}', '{replacement}', 'g')"
    # no look-ahead here: blanks are doubled, so that the one after a contraction can be taken
    sql = f"replace({sql} || ' ', ' ', '  ')"
    for pattern, replacement in (
        (r"([^'' ])(''s|''m|''d|''ll|''re|''ve|n''t|'') ", r"\1 \2 "),
        (r"\b(can)(not)\b", r"\1 \2"), (r"\b(gim|lem)(me)\b", r"\1 \2"), (r"\b(gon|wan)(na)\b", r"\1 \2"), (r"\b(got)(ta)\b", r"\1 \2"),
    ):
        sql = f"regexp_replace({sql}, '{pattern}', '{replacement}', 'g')"
    return f"list_filter(string_split({sql}, ' '), lambda w: w <> '')"


@query("bleu_tokens", f"""
SELECT doc_id, CAST(len(t) AS INT) AS n_tokens, array_to_string(t, ' ') AS tokens
FROM (SELECT doc_id, {treebank('text')} AS t FROM documents) AS d""")
def bleu_tokens(spark, sf_dir):
    rows = documents(spark, sf_dir).select("doc_id", scoring.bleu_tokens("text").alias("t"))
    return rows.select("doc_id", F.size("t").alias("n_tokens"), F.array_join("t", " ").alias("tokens"))


# The abbreviations of all documents, by the formulas written out.
_ABBREVIATIONS = dict(
    word_stops=rf"""
SELECT CASE WHEN stop THEN left(t, length(t) - 1) ELSE t END AS word,
       count(*) FILTER (WHERE stop) AS with_stop, count(*) FILTER (WHERE NOT stop) AS without
FROM (SELECT t, t LIKE '%.' AND t NOT LIKE '%..' AS stop FROM (
        SELECT regexp_replace(unnest(regexp_split_to_array(lower(text), '{_BLANKS}')),
                              '^["''`(\[{{<]+|[\])}}>"''`,;:!?]+$', '', 'g') AS t FROM documents) AS w WHERE t <> '') AS s
GROUP BY 1""",
    word_totals="SELECT sum(with_stop + without)::DOUBLE AS n, sum(with_stop)::DOUBLE AS stops FROM word_stops",
    sized="""
SELECT *, length(word) - length(replace(word, '.', '')) AS inner_stops, length(replace(word, '.', '')) AS size, stops / n AS p
FROM word_stops, word_totals
WHERE with_stop >= 5 AND regexp_matches(word, '\\p{L}') AND with_stop + without >= n * 1e-5""",
    abbreviations="""
SELECT * FROM (
  SELECT word, with_stop, without,
         -2 * ((with_stop * ln(p) + CASE WHEN without = 0 THEN 0 ELSE without * ln(1 - p) END)
               - (with_stop * ln(0.99::DOUBLE) + CASE WHEN without = 0 THEN 0 ELSE without * ln(1 - 0.99::DOUBLE) END))
         * exp(-size::DOUBLE) * (inner_stops + 1) * exp(-without * ln(size)) AS score
  FROM sized) AS x WHERE score >= 0.3""",
)
# The stop of an abbreviation, but for one that ends the text, becomes a character that no rule knows.
_MARKED = rf"""
SELECT doc_id, array_to_string(list_transform(words, lambda w, i:
         CASE WHEN list_contains(known, regexp_replace(w, '^["''`(\[{{<]+|[.][,;:]*$', '', 'g'))
               AND regexp_matches(w, '[.][,;:]*$') AND NOT (i = len(words) AND w LIKE '%.')
              THEN regexp_replace(w, '[.]([,;:]*)$', chr(64978) || '\1') ELSE w END), ' ') AS text
FROM (SELECT doc_id, string_split(lower(trim(regexp_replace(text, '{_BLANKS}', ' ', 'g'))), ' ') AS words FROM documents) AS d,
     (SELECT coalesce(list(word), []) AS known FROM abbreviations) AS a"""


@query("learned_abbreviations", with_views(
    "", "SELECT word, with_stop, without, round(score, 6) AS score FROM abbreviations", **_ABBREVIATIONS))
def learned_abbreviations(spark, sf_dir):
    found = abbreviations.learn_abbreviations(documents(spark, sf_dir), "text")
    return found.withColumn("score", F.round("score", 6))


@query("bleu_tokens_sentences", with_views("", f"""
SELECT doc_id, CAST(len(t) AS INT) AS n_tokens, replace(array_to_string(t, ' '), chr(64978), '.') AS tokens
FROM (SELECT doc_id, {treebank('text')} AS t FROM marked) AS m""", **_ABBREVIATIONS, marked=_MARKED))
def bleu_tokens_sentences(spark, sf_dir):
    """Words of the documents, with the stops of the corpus' own abbreviations kept on."""
    docs = documents(spark, sf_dir)
    known = abbreviations.as_list(abbreviations.learn_abbreviations(docs, "text"))
    rows = docs.select("doc_id", scoring.bleu_tokens("text", known).alias("t"))
    return rows.select("doc_id", F.size("t").alias("n_tokens"), F.array_join("t", " ").alias("tokens"))


# BLEU by exploding n-grams, counting them and joining the counts.
BLEU_CTE = dict(
    tok=f"""
SELECT model_name, id, side, n, list_transform(range(1, len(t) - n + 2),
         lambda i: array_to_string(list_slice(t, i, i + n - 1), ' ')) AS grams, len(t) AS size
FROM (SELECT model_name, id, 'ref' AS side, {treebank('reference')} AS t FROM generations
      UNION ALL
      SELECT model_name, id, 'gen', {treebank('generated_text')} FROM generations) AS s,
     (VALUES (1), (2), (3), (4)) AS v(n)""",
    counted="""
SELECT model_name, id, side, n, gram, count(*) AS c
FROM (SELECT model_name, id, side, n, unnest(grams) AS gram FROM tok) AS u GROUP BY ALL""",
    hits="""
SELECT g.model_name, g.id, g.n, sum(least(g.c, r.c)) AS h FROM counted AS g JOIN counted AS r
  ON g.model_name = r.model_name AND g.id = r.id AND g.n = r.n AND g.gram = r.gram
WHERE g.side = 'gen' AND r.side = 'ref' GROUP BY ALL""",
    levels="""
SELECT t.model_name, t.id, t.n, coalesce(h.h, 0) AS h, greatest(1, t.size - t.n + 1) AS total,
       t.size AS gen_size, r.size AS ref_size
FROM tok AS t JOIN tok AS r ON t.model_name = r.model_name AND t.id = r.id AND r.side = 'ref' AND r.n = t.n
  LEFT JOIN hits AS h ON h.model_name = t.model_name AND h.id = t.id AND h.n = t.n
WHERE t.side = 'gen'""",
    bleu="""
SELECT model_name, id, CASE WHEN min(CASE WHEN n = 1 THEN h END) = 0 THEN 0::DOUBLE ELSE
         CASE WHEN max(gen_size) > max(ref_size) THEN 1::DOUBLE
              ELSE exp(1 - max(ref_size)::DOUBLE / max(gen_size)) END
         * exp(avg(ln((CASE WHEN h > 0 THEN h::DOUBLE ELSE 0.1::DOUBLE END) / total))) END AS bleu
FROM levels GROUP BY model_name, id""",
)


@query("bleu", with_views("generations", "SELECT model_name, id, round(bleu, 9) AS bleu FROM bleu", **BLEU_CTE))
def bleu(spark, sf_dir):
    return generations(spark, sf_dir).select(
        "model_name", "id", F.round(scoring.bleu("reference", "generated_text"), 9).alias("bleu"))


# Similarity by a longest common subsequence over 60-bit words: one bit per letter
# of the reference (they have fewer than 240), folded over the generated text.
_WORDS_60 = 4
_FULL_60 = (1 << 60) - 1


def _lcs_step() -> str:
    cells, carry = [], "0"
    for k in range(1, _WORDS_60 + 1):
        hit = f"(v[{k}] & m[{k}])"
        total = f"(v[{k}] + {hit} + {carry})"
        cells.append(f"(({total} & {_FULL_60}) | (v[{k}] - {hit}))")
        carry = f"({total} >> 60)"
    return "[" + ", ".join(cells) + "]"


SIMILARITY_CTE = dict(
    letters=f"""
SELECT model_name, id, c, {", ".join(
        f"sum(CASE WHEN p BETWEEN {60 * k + 1} AND {60 * k + 60} THEN 1::BIGINT << (p - {60 * k + 1})::INT "
        f"ELSE 0 END)::BIGINT AS m{k + 1}" for k in range(_WORDS_60))}
FROM (SELECT model_name, id, unnest(string_split(lower(reference), '')) AS c,
             unnest(range(1, length(reference) + 1)) AS p FROM generations) AS r GROUP BY model_name, id, c""",
    masks=f"""
SELECT g.model_name, g.id, list([{", ".join(f"coalesce(m{k + 1}, 0)" for k in range(_WORDS_60))}] ORDER BY g.p) AS masks
FROM (SELECT model_name, id, unnest(string_split(lower(generated_text), '')) AS c,
             unnest(range(1, length(generated_text) + 1)) AS p FROM generations) AS g
LEFT JOIN letters AS l ON g.model_name = l.model_name AND g.id = l.id AND g.c = l.c GROUP BY g.model_name, g.id""",
    alike=f"""
SELECT g.model_name, g.id, 200::DOUBLE * ({60 * _WORDS_60} - list_sum(list_transform(list_reduce(
         masks, lambda v, m: {_lcs_step()}, [{", ".join([str(_FULL_60)] * _WORDS_60)}]),
         lambda x: bit_count(x)))) / (length(reference) + length(generated_text)) AS similarity
FROM masks AS k JOIN generations AS g ON g.model_name = k.model_name AND g.id = k.id""",
)


@query("similarity", with_views(
    "generations", "SELECT model_name, id, similarity FROM alike", **SIMILARITY_CTE))
def similarity(spark, sf_dir):
    return generations(spark, sf_dir).select(
        "model_name", "id", scoring.similarity("reference", "generated_text").alias("similarity"))


@query("similarity_of_turns")
def similarity_of_turns(spark, sf_dir):
    """Each assistant turn against the user turn before it."""
    turns = table(spark, sf_dir, "conversations")
    asked = turns.filter("role = 'user'").select(
        "conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("asked"))
    answered = turns.filter("role = 'assistant'").select("conv_id", "turn", "text")
    return answered.join(asked, ["conv_id", "turn"]).select(
        "conv_id", "turn", scoring.similarity("asked", "text").alias("similarity"),
        scoring.bleu("asked", "text").alias("bleu"))


# --- recipe metrics ----------------------------------------------------------

# Regexes of these statements are the fixed patterns of the library, run by DuckDB.
_SECTION = f"trim(regexp_extract(reference, '{re2(lookups.INGREDIENT_SECTION)}', 1), chr(10) || ' ')"
_ITEMS = (
    rf"list_filter(list_transform(regexp_split_to_array({_SECTION}, '[,\n]'), lambda i: trim(lower(i))), "
    "lambda i: i <> '')"
)
_GENERIC = ", ".join(f"'{w}'" for w in lookups.GENERIC_INGREDIENT_WORDS)
_ESCAPED = r"regexp_replace({}, '([^A-Za-z0-9_ ])', '\\\1', 'g')"


def _occurs(term: str) -> str:
    return rf"regexp_matches(t, '\b' || {_ESCAPED.format(term)} || '\b')"


_COVERED = (
    f"list_filter(items, lambda i: {_occurs('i')} OR len(list_filter(string_split(i, ' '), lambda w: "
    f"length(w) > 2 AND w NOT IN ({_GENERIC}) AND {_occurs('w')})) > 0)"
)
_FOUND = " + ".join(
    f"len(regexp_extract_all(generated_text, '{p}'))" for p in map(re2, lookups.TEMPERATURE_MENTIONS)
)


def _celsius_lists() -> str:
    """All mentions as a list of degrees Celsius."""
    lists = []
    for p in map(re2, lookups.TEMPERATURE_MENTIONS):
        values = f"regexp_extract_all(generated_text, '{p}', 1)"
        marks = f"regexp_extract_all(generated_text, '{p}', 2)"
        lists.append(
            f"list_transform(list_zip({values}, {marks}), lambda z: CASE WHEN upper(left(z[2], 1)) = 'F' "
            "THEN (z[1]::DOUBLE - 32) * 5 / 9 ELSE z[1]::DOUBLE END)"
        )
    joined = lists[0]
    for extra in lists[1:]:
        joined = f"list_concat({joined}, {extra})"
    return joined


_ALLERGENS = "[" + ", ".join(f"'{a}'" for a in lookups.ALLERGENS) + "]"
_SWAPS = " + ".join(
    "len(regexp_extract_all(t, '{}'))".format(p.replace("'", "''"))
    for p in map(re2, lookups.SUBSTITUTION_PATTERNS)
)
_WARNED = r"regexp_matches(t, '\b(?:" + "|".join(lookups.SAFETY_PATTERNS) + ")')"

SCORE_CTE = dict(
    read=f"""
SELECT model_name, id, generated_text, lower(generated_text) AS t, {_ITEMS} AS items,
       {_celsius_lists()} AS degrees FROM generations""",
    facts=rf"""
SELECT *, {_COVERED} AS used, list_filter(degrees, lambda d: d BETWEEN -20 AND 250) AS valid,
       list_sort(list_filter({_ALLERGENS}, lambda a: regexp_matches(t, '\b' || a || '\b'))) AS allergens,
       CAST({_SWAPS} AS INT) AS swaps, {_WARNED} AS warned FROM read""",
    scores="""
SELECT *, CASE WHEN len(items) > 0 THEN len(used)::DOUBLE / len(items) ELSE 0::DOUBLE END AS coverage,
       CASE WHEN len(degrees) > 0 THEN len(valid)::DOUBLE / len(degrees) ELSE 0.5::DOUBLE END AS temperature,
       least(CASE WHEN len(allergens) > 0 THEN 0.3::DOUBLE ELSE 0 END + CASE WHEN swaps > 0 THEN 0.3::DOUBLE ELSE 0 END
             + CASE WHEN warned THEN 0.4::DOUBLE ELSE 0 END, 1::DOUBLE) AS allergy FROM facts""",
)


def _scored_sql(body: str) -> str:
    return with_views("generations", body, **SCORE_CTE)


@query("extract_ingredients", _scored_sql("""
SELECT model_name, id, array_to_string(items, '|') AS ingredients FROM read"""))
def extract_ingredients(spark, sf_dir):
    return generations(spark, sf_dir).select(
        "model_name", "id",
        F.array_join(scoring.extract_ingredients("reference"), "|").alias("ingredients"))


@query("ingredient_coverage", _scored_sql("""
SELECT model_name, id, CAST(len(used) AS INT) AS used_count, CAST(len(items) AS INT) AS total_count,
       round(coverage, 9) AS score, round(coverage * 100, 6) AS coverage_percentage,
       array_to_string(list_filter(items, lambda i: NOT list_contains(used, i)), '|') AS missing
FROM scores"""))
def ingredient_coverage(spark, sf_dir):
    c = scoring.ingredient_coverage(scoring.extract_ingredients("reference"), "generated_text")
    return generations(spark, sf_dir).select("model_name", "id", c.alias("c")).select(
        "model_name", "id", "c.used_count", "c.total_count", F.round("c.score", 9).alias("score"),
        F.round("c.coverage_percentage", 6).alias("coverage_percentage"),
        F.array_join("c.missing_ingredients", "|").alias("missing"))


@query("extract_temperatures", _scored_sql(f"""
SELECT model_name, id, CAST({_FOUND} AS INT) AS n_found,
       round(list_sum(degrees), 6) AS sum_celsius FROM read"""))
def extract_temperatures(spark, sf_dir):
    rows = generations(spark, sf_dir).select(
        "model_name", "id", scoring.extract_temperatures("generated_text").alias("t"))
    celsius = F.transform("t", lambda x: F.when(
        x.getField("unit") == "F", (x.getField("value") - 32) * 5 / 9).otherwise(x.getField("value")))
    return rows.select(
        "model_name", "id", F.size("t").alias("n_found"),
        F.round(F.aggregate(celsius, F.lit(0.0), lambda a, x: a + x), 6).alias("sum_celsius"))


@query("temperature_valid", """
SELECT p_partkey AS id, p_size * 12 - 100 BETWEEN -20 AND 250 AS as_c,
       (p_size * 12 - 100 - 32) * 5 / 9 BETWEEN -20 AND 250 AS as_f FROM part""")
def temperature_valid(spark, sf_dir):
    value = (F.col("p_size") * 12 - 100).cast("double")
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"),
        scoring.temperature_valid(value, F.lit("C")).alias("as_c"),
        scoring.temperature_valid(value, F.lit("F")).alias("as_f"))


@query("temperature_score", _scored_sql("""
SELECT model_name, id, round(temperature, 9) AS score, len(degrees) > 0 AS has_temperatures,
       CAST(len(valid) AS INT) AS valid_count, CAST(len(degrees) - len(valid) AS INT) AS invalid_count,
       len(valid) = len(degrees) AS all_valid FROM scores"""))
def temperature_score(spark, sf_dir):
    rows = generations(spark, sf_dir).select(
        "model_name", "id", scoring.temperature_score("generated_text").alias("t"))
    return rows.select("model_name", "id", "t.*").withColumn("score", F.round("score", 9))


@query("extract_allergens", _scored_sql("""
SELECT model_name, id, array_to_string(allergens, '|') AS allergens FROM facts"""))
def extract_allergens(spark, sf_dir):
    return generations(spark, sf_dir).select(
        "model_name", "id",
        F.array_join(scoring.extract_allergens("generated_text"), "|").alias("allergens"))


@query("substitution_count", _scored_sql("SELECT model_name, id, swaps AS n FROM facts"))
def substitution_count(spark, sf_dir):
    return generations(spark, sf_dir).select(
        "model_name", "id", scoring.substitution_count("generated_text").alias("n"))


@query("safety_warning", _scored_sql("SELECT model_name, id, warned FROM facts"))
def safety_warning(spark, sf_dir):
    return generations(spark, sf_dir).select(
        "model_name", "id", scoring.safety_warning("generated_text").alias("warned"))


@query("allergen_score", _scored_sql("""
SELECT model_name, id, round(allergy, 9) AS score, len(allergens) > 0 OR swaps > 0 OR warned AS allergen_awareness,
       swaps AS substitution_count, warned AS has_safety_warnings FROM scores"""))
def allergen_score(spark, sf_dir):
    rows = generations(spark, sf_dir).select(
        "model_name", "id", scoring.allergen_score("generated_text").alias("a"))
    return rows.select(
        "model_name", "id", F.round("a.score", 9).alias("score"), "a.allergen_awareness",
        "a.substitution_count", "a.has_safety_warnings")


@query("recipe_metrics", _scored_sql("""
SELECT model_name, id, round(coverage * 0.4::DOUBLE + temperature * 0.4::DOUBLE + allergy * 0.2::DOUBLE, 9) AS composite_score,
       round(coverage, 9) AS coverage, round(temperature, 9) AS temperature, round(allergy, 9) AS allergy,
       CAST(len(used) AS INT) AS used_count, CAST(len(valid) AS INT) AS valid_count,
       array_to_string(allergens, '|') AS allergens FROM scores"""))
def recipe_metrics(spark, sf_dir):
    rows = evaluation.with_recipe_metrics(generations(spark, sf_dir))
    m = "recipe_metrics"
    return rows.select(
        "model_name", "id", F.round(f"{m}.composite_score", 9).alias("composite_score"),
        F.round(f"{m}.ingredient_coverage.score", 9).alias("coverage"),
        F.round(f"{m}.temperature_validation.score", 9).alias("temperature"),
        F.round(f"{m}.allergen_handling.score", 9).alias("allergy"),
        f"{m}.ingredient_coverage.used_count", f"{m}.temperature_validation.valid_count",
        F.array_join(f"{m}.allergen_handling.allergens_mentioned", "|").alias("allergens"))


@query("calculate_metrics", with_views("generations", """
SELECT s.model_name, s.id, round(b.bleu, 9) AS bleu, m.similarity,
       round(coverage * 0.4::DOUBLE + temperature * 0.4::DOUBLE + allergy * 0.2::DOUBLE, 9) AS composite_score
FROM scores AS s JOIN bleu AS b ON s.model_name = b.model_name AND s.id = b.id
  JOIN alike AS m ON s.model_name = m.model_name AND s.id = m.id""",
    **BLEU_CTE, **SCORE_CTE, **SIMILARITY_CTE))
def calculate_metrics(spark, sf_dir):
    rows = evaluation.calculate_metrics(generations(spark, sf_dir))
    return rows.select(
        "model_name", "id", F.round("bleu", 9).alias("bleu"), "similarity",
        F.round("recipe_metrics.composite_score", 9).alias("composite_score"))


# Each document against itself: the n-gram orders it is too short for count 0.1.
@query("score_documents", with_views("", f"""
SELECT s.id AS doc_id, round(coverage * 0.4::DOUBLE + temperature * 0.4::DOUBLE + allergy * 0.2::DOUBLE, 9) AS composite,
       round(CASE WHEN n = 0 THEN 0 ELSE power(0.1::DOUBLE, greatest(0, 4 - n) / 4) END, 9) AS bleu
FROM scores AS s JOIN (SELECT doc_id, len({treebank('text')}) AS n FROM documents) AS d
  ON d.doc_id = s.id""",
    generations="""
SELECT 'document' AS model_name, doc_id AS id, text AS reference, text AS generated_text FROM documents""",
    **SCORE_CTE))
def score_documents(spark, sf_dir):
    """All text-only scores over whole documents."""
    docs = documents(spark, sf_dir)
    composite = scoring.recipe_metrics("text", "text").getField("composite_score")
    return docs.select(
        "doc_id", F.round(composite, 9).alias("composite"),
        F.round(scoring.bleu("text", "text"), 9).alias("bleu"))


# --- structure ---------------------------------------------------------------


@query("structure_exact", with_views("generations", """
SELECT model_name, id, generated_text LIKE '%Ingredients%' AND generated_text LIKE '%Instructions%' AS valid
FROM generations"""))
def structure_exact(spark, sf_dir):
    return generations(spark, sf_dir).select(
        "model_name", "id", scoring.structure_exact("generated_text").alias("valid"))


@query("structure_loose", with_views("generations", """
SELECT model_name, id, generated_text ILIKE '%ingredient%' AND generated_text ILIKE '%instruction%' AS valid
FROM generations"""))
def structure_loose(spark, sf_dir):
    return generations(spark, sf_dir).select(
        "model_name", "id", scoring.structure_loose("generated_text").alias("valid"))


@query("structure_vote", with_views("generations", """
SELECT model_name, id, (generated_text ILIKE '%ingredients%')::INT + (generated_text ILIKE '%instructions%')::INT
                       + (length(generated_text) > 200)::INT >= 2 AS passed FROM generations"""))
def structure_vote(spark, sf_dir):
    return generations(spark, sf_dir).select(
        "model_name", "id", scoring.structure_vote("generated_text").alias("passed"))


@query("format_compliance", with_views("generations", r"""
SELECT model_name, id, regexp_full_match(generated_text, 'Ingredients:[\s\S]+?\n\nInstructions:[\s\S]+') AS complies
FROM generations"""))
def format_compliance(spark, sf_dir):
    return generations(spark, sf_dir).select(
        "model_name", "id", scoring.format_compliance("generated_text").alias("complies"))


# --- prompts, names, verdicts ------------------------------------------------

_PROMPT = "concat('Instruction: ', instruction, chr(10), chr(10), 'Recipe:')"


@query("strip_prompt", with_views("generations", f"""
SELECT model_name, id,
       CASE WHEN starts_with(generated_text, {_PROMPT})
            THEN trim(substr(generated_text, length({_PROMPT}) + 1), ' ' || chr(10)) ELSE generated_text END AS by_prefix,
       trim(replace(generated_text, instruction, ''), ' ' || chr(10)) AS by_replace,
       trim(string_split(generated_text, 'Recipe:')[-1], ' ' || chr(10)) AS by_marker FROM generations"""))
def strip_prompt(spark, sf_dir):
    return generations(spark, sf_dir).select(
        "model_name", "id",
        prompts.strip_prefix("generated_text", prompts.inference_prompt("instruction")).alias("by_prefix"),
        prompts.strip_everywhere("generated_text", "instruction").alias("by_replace"),
        prompts.strip_to_marker("generated_text", "Recipe:").alias("by_marker"))


@query("strip_persona", with_views("generations", """
SELECT model_name, id, concat('Ingredients: salt', chr(10), 'for ', id) AS whole, concat('Soup ', id) AS altered
FROM generations"""))
def strip_persona(spark, sf_dir):
    """The persona prompt in front of a text, as it was given and cut short before its last line."""
    rows = generations(spark, sf_dir).select("model_name", "id", "instruction", prompts.persona_prompt("instruction").alias("p"))
    whole = F.concat("p", F.lit("\nIngredients: salt\nfor "), "id")
    altered = F.concat(F.lit(lookups.PERSONA_OPENING + " Be brief.\n\nDish: "), "instruction", F.lit("\n\n" + lookups.PERSONA_MARKER + "\nSoup "), "id")
    return rows.select(
        "model_name", "id", prompts.strip_persona(whole, F.col("instruction")).alias("whole"),
        prompts.strip_persona(altered, F.col("instruction")).alias("altered"))


@query("format_recipe", with_views("generations", r"""
SELECT model_name, id, regexp_replace(replace(replace(generated_text,
         'Ingredients:', concat(chr(10), chr(10), '**Ingredients:**', chr(10))),
         'Instructions:', concat(chr(10), chr(10), '**Instructions:**', chr(10))),
       '(\s)(\d+\.)', concat(chr(10), '\2'), 'g') AS display FROM generations"""))
def format_recipe(spark, sf_dir):
    return generations(spark, sf_dir).select(
        "model_name", "id", text.display_recipe("generated_text").alias("display"))


@query("dish_name", with_views("generations", """
SELECT model_name, id, CASE WHEN id % 10 = 0 THEN 'Unknown Dish' ELSE concat('Grandmas Best ', p_name, ' Recipe!!') END
       AS dish_name FROM generations"""))
def dish_name(spark, sf_dir):
    rows = generations(spark, sf_dir).withColumn(
        "instruction", F.when(F.col("id") % 10 == 0, "Cook something").otherwise(F.col("instruction")))
    return rows.select("model_name", "id", prompts.dish_name("instruction").alias("dish_name"))


@query("adapter_label", """
SELECT p_partkey AS id, CASE WHEN p_partkey % 4 = 0 THEN 'unknown' ELSE replace(p_name, ' ', '_') END AS adapter,
       concat(CASE WHEN p_partkey % 4 = 0 THEN 'Unknown' ELSE array_to_string(list_transform(string_split(p_name, ' '),
         lambda w: concat(upper(left(w, 1)), lower(substr(w, 2)))), '_') END, ' Fine-Tuned') AS label FROM part""")
def adapter_label(spark, sf_dir):
    rows = parts(spark, sf_dir).selectExpr(
        "p_partkey AS id", "CASE WHEN p_partkey % 4 = 0 THEN p_brand "
        "ELSE concat(p_brand, ' (', replace(p_name, ' ', '_'), ')') END AS m")
    return rows.select(
        "id", prompts.adapter_type("m").alias("adapter"), prompts.adapter_label("m").alias("label"))


_BARE = "trim(replace(replace(reply, '```json', ''), '```', ''), ' ' || chr(10))"


@query("parse_verdict", with_views("replies", f"""
SELECT model_name, id, judge_model, coalesce(CASE WHEN json_valid({_BARE}) THEN TRY_CAST(json_extract_string({_BARE}, '$.score') AS DOUBLE) END, 0::DOUBLE) AS score,
       CASE WHEN json_valid({_BARE}) THEN json_extract_string({_BARE}, '$.reasoning')
            ELSE 'Judge Error: unreadable reply' END AS reasoning FROM replies"""))
def parse_verdict(spark, sf_dir):
    rows = replies(spark, sf_dir).withColumn("v", prompts.parse_verdict("reply"))
    return rows.select("model_name", "id", "judge_model", "v.score", "v.reasoning")


@query("resolve_verdict", with_views("verdicts", "SELECT model_name, id, score, reasoning, judge_model FROM verdicts"))
def resolve_verdict(spark, sf_dir):
    return evaluation.resolve_verdicts(replies(spark, sf_dir), JUDGES)


@query("judge_input", """
SELECT doc_id, CASE WHEN doc_id % 9 = 0 THEN NULL ELSE substr(text, 1, 4000) END AS judged FROM documents""")
def judge_input(spark, sf_dir):
    docs = documents(spark, sf_dir).select(
        "doc_id", F.when(F.col("doc_id") % 9 == 0, "").otherwise(F.col("text")).alias("t"))
    return docs.select("doc_id", prompts.judge_input("t").alias("judged"))

"""Recipe-like inputs derived from the given tables.

The column expressions use only ``concat``, ``%``, ``chr``, ``CASE`` and ``CAST``,
which mean the same in Spark and DuckDB: the Spark side selects them, the SQL
side puts them into common table expressions. All numbers in the texts come from
``p_size`` and ``p_partkey``, so the expected standardised text is arithmetic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mirepoix.functions import prompts
from mirepoix.operators.cleaning import clean_recipes
from mirepoix.operators.curation import instruction_pairs
from mirepoix.session import spread

MODELS = ("base", "tuned")
JUDGES = ("judge-a", "judge-b", "judge-c")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part table, few bytes a row, dealt over tasks before texts are made of it."""
    return spread(table(spark, sf_dir, "part"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys and whole texts."""
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def _list(*items: str) -> str:
    quoted = ", ', ', ".join(f"chr(39), {i}, chr(39)" for i in items)
    return f"concat('[', {quoted}, ']')"


RECIPE_COLUMNS = {
    "id": "p_partkey",
    "name": "concat('Grandmas Best ', p_name, ' Recipe!!')",
    "minutes": "CAST((p_size * 7 + p_partkey) % 360 AS INT)",
    "contributor_id": "p_partkey % 1000",
    "submitted": "'2005-09-16'",
    "tags": _list("'30-minutes-or-less'", "'Easy'", "p_type"),
    "nutrition": (
        "concat('[', CAST((p_size % 10) * 250 AS STRING), '.0, ', CAST(p_partkey % 40 AS STRING), "
        "'.0, ', CAST(p_partkey % 30 AS STRING), '.0, ', CAST(p_partkey % 20 AS STRING), '.0, ', "
        "CAST(p_size AS STRING), '.0, ', CAST(p_partkey % 25 AS STRING), '.0, ', "
        "CAST(p_partkey % 60 AS STRING), '.0]')"
    ),
    "n_steps": "CAST(p_size % 15 + 1 AS INT)",
    "steps": _list(
        "concat('Preheat oven to ', CAST(300 + p_size * 5 AS STRING), ' degrees F')",
        "'Add 2-3 cups milk'", "'Cut 1 / 2 inch slices'",
        "concat('Bake ', CAST(10 + p_size AS STRING), ' min')",
    ),
    "description": "CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE concat('From ', p_brand) END",
    "ingredients": _list("'Flour'", "'Milk'", "p_name"),
    "n_ingredients": "CAST(p_partkey % 20 + 1 AS INT)",
    "cuisine": "p_brand",
}
# Kept beside the recipe columns, so that expected values can be computed.
PART_COLUMNS = ("p_name", "p_size", "p_type")

RECIPES_SRC = "SELECT {} FROM part".format(
    ", ".join([f"{e} AS {n}" for n, e in RECIPE_COLUMNS.items()] + list(PART_COLUMNS))
)


def recipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw recipe rows."""
    part = parts(spark, sf_dir).select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    return part.selectExpr(*[f"{e} AS {n}" for n, e in RECIPE_COLUMNS.items()], *PART_COLUMNS)


CELSIUS_OF_STEP = "CAST(CAST(round((268 + p_size * 5) * 5.0 / 9.0) AS INT) AS STRING)"
STEPS_TEXT = (
    "concat('preheat oven to ', CAST(300 + p_size * 5 AS STRING), ' degrees f add 2-3 cups milk "
    "cut 1 / 2 inch slices bake ', CAST(10 + p_size AS STRING), ' min')"
)
STEPS_STANDARD = (
    f"concat('preheat oven to ', {CELSIUS_OF_STEP}, '.0 celsius add 0.6 liter milk "
    "cut 1.27 cm slices bake ', CAST(10 + p_size AS STRING), '.0 minute')"
)
NUTRITION = {
    "calories": "CAST((p_size % 10) * 250 AS DOUBLE)",
    "total_fat": "CAST(id % 40 AS DOUBLE)",
    "sugar": "CAST(id % 30 AS DOUBLE)",
    "sodium": "CAST(id % 20 AS DOUBLE)",
    "protein": "CAST(p_size AS DOUBLE)",
    "saturated_fat": "CAST(id % 25 AS DOUBLE)",
    "carbohydrates": "CAST(id % 60 AS DOUBLE)",
}

CLEAN = f"""
SELECT id, name, minutes, n_steps, lower(description) AS description, n_ingredients, cuisine,
       {STEPS_STANDARD} AS steps_string_standardize,
       concat('flour, milk, ', lower(p_name)) AS ingredients_text,
       concat('[', chr(39), 'easy', chr(39), ', ', chr(39), lower(p_type), chr(39), ']') AS tags_text,
       {", ".join(f"{e} AS {n}" for n, e in NUTRITION.items())}, p_name, p_size
FROM recipes_src WHERE minutes < 300 AND description IS NOT NULL
"""

PAIRS = """
SELECT id, concat('Create a detailed recipe for ', name, '.') AS instruction,
       concat('Ingredients:', chr(10), ingredients_text, chr(10), chr(10), 'Instructions:', chr(10),
              steps_string_standardize) AS output
FROM clean WHERE length(steps_string_standardize) >= 10
"""


def clean(spark: SparkSession, sf_dir: str, standardize: bool = True) -> DataFrame:
    return clean_recipes(recipes(spark, sf_dir), standardize=standardize).drop("p_type")


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return instruction_pairs(clean(spark, sf_dir))


# A generated text with faults placed by key: milk left out, an implausible
# temperature, an allergen note, a missing heading, an echoed prompt.
GENERATED_TEXT = """concat(
  CASE WHEN model_name = 'base'
       THEN concat('Instruction: ', instruction, chr(10), chr(10), 'Recipe:') ELSE '' END,
  'Ingredients:', chr(10), 'flour, ', CASE WHEN id % 3 = 0 THEN '' ELSE 'milk, ' END, p_name,
  chr(10), chr(10), CASE WHEN id % 7 = 0 THEN '' ELSE concat('Instructions:', chr(10)) END,
  '1. Mix flour ', CASE WHEN id % 3 = 0 THEN '' ELSE 'and milk ' END, 'with ', p_name,
  '. 2. Bake at ', CASE WHEN id % 5 = 0 THEN '500' ELSE '180' END, '°C for ',
  CAST(10 + p_size AS STRING), ' minutes.',
  CASE WHEN id % 4 = 0 THEN ' Contains dairy, you can use a substitute.' ELSE '' END)"""

GENERATION_TIME = "CAST(id % 90 AS DOUBLE) / 10"

GENERATIONS = f"""
SELECT model_name, id, instruction, reference, {GENERATED_TEXT} AS generated_text,
       {GENERATION_TIME} AS generation_time, p_name, p_size
FROM (SELECT clean.id, pairs.instruction, pairs.output AS reference, clean.p_name, clean.p_size
      FROM clean JOIN pairs ON clean.id = pairs.id) AS r,
     (VALUES {", ".join(f"('{m}')" for m in MODELS)}) AS m(model_name)
"""


def generations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generated texts of two models with their references, one row per (model, id)."""
    rows = clean(spark, sf_dir).select(
        "id", prompts.instruction_text("name").alias("instruction"),
        prompts.output_text("ingredients_text", "steps_string_standardize").alias("reference"),
        "p_name", "p_size",
        F.explode(F.array(*[F.lit(m) for m in MODELS])).alias("model_name"),
    )
    return rows.selectExpr(
        "model_name", "id", "instruction", "reference", f"{GENERATED_TEXT} AS generated_text",
        f"{GENERATION_TIME} AS generation_time", "p_name", "p_size",
    )


# Judge replies: plain JSON, fenced JSON or broken JSON, by key and judge.
BROKEN = (
    "(judge_model = 'judge-a' AND id % 3 = 0) OR (judge_model = 'judge-b' AND id % 9 = 0) "
    "OR (judge_model = 'judge-c' AND id % 27 = 0)"
)
# Scores are whole, halves, and sometimes in quotes.
VERDICT_SCORE = (
    "(CAST((id + length(judge_model) + length(model_name)) % 10 + 1 AS DOUBLE) "
    "+ CAST(CASE WHEN id % 4 = 1 THEN 0.5 ELSE 0.0 END AS DOUBLE))"
)
QUOTE = "CASE WHEN id % 5 = 0 THEN chr(34) ELSE '' END"
VERDICT_REASON = "concat('Fine, says ', judge_model, ' of dish ', CAST(id AS STRING))"
REPLY = f"""concat(CASE WHEN id % 2 = 0 THEN concat('```json', chr(10)) ELSE '' END,
  '{{"score": ', {QUOTE}, CAST({VERDICT_SCORE} AS STRING), {QUOTE}, ', "reasoning": "', {VERDICT_REASON},
  CASE WHEN {BROKEN} THEN '' ELSE '"}}' END,
  CASE WHEN id % 2 = 0 THEN concat(chr(10), '```') ELSE '' END)"""

REPLIES = f"""
SELECT model_name, id, judge_model, {REPLY} AS reply
FROM generations, (VALUES {", ".join(f"('{j}')" for j in JUDGES)}) AS j(judge_model)
"""

# What the first judge with a readable reply says, from the rule above.
VERDICTS = f"""
SELECT model_name, id,
       CASE WHEN judge_model IS NULL THEN 0::DOUBLE ELSE {VERDICT_SCORE} END AS score,
       CASE WHEN judge_model IS NULL THEN 'Judge Error: unreadable reply'
            ELSE {VERDICT_REASON} END AS reasoning,
       coalesce(judge_model, 'None') AS judge_model
FROM (SELECT model_name, id, CASE WHEN id % 3 <> 0 THEN 'judge-a' WHEN id % 9 <> 0 THEN 'judge-b'
                                  WHEN id % 27 <> 0 THEN 'judge-c' END AS judge_model
      FROM generations) AS g
"""


def replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = generations(spark, sf_dir).withColumn(
        "judge_model", F.explode(F.array(*[F.lit(j) for j in JUDGES]))
    )
    return rows.selectExpr("model_name", "id", "judge_model", f"{REPLY} AS reply")


_VIEWS = {
    "recipes_src": (RECIPES_SRC, ()),
    "clean": (CLEAN, ("recipes_src",)),
    "pairs": (PAIRS, ("clean",)),
    "generations": (GENERATIONS, ("pairs",)),
    "replies": (REPLIES, ("generations",)),
    "verdicts": (VERDICTS, ("generations",)),
}


def with_views(view: str, body: str, **extra: str) -> str:
    """``body`` below the common table expressions that ``view`` needs."""
    chain: list[str] = []

    def add(name: str) -> None:
        for needed in _VIEWS[name][1]:
            add(needed)
        if name not in chain:
            chain.append(name)

    for name in view.split():
        add(name)
    parts = [f"{n} AS ({_VIEWS[n][0].strip()})" for n in chain]
    parts += [f"{n} AS ({q.strip()})" for n, q in extra.items()]
    return f"WITH {', '.join(parts)} {body.strip()}"

"""The plans are what a large cluster needs: narrow, pruned, without surprises."""

import inspect
import re
from itertools import product

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from mirepoix.functions import scoring, units
from mirepoix.operators import cleaning, curation, evaluation, reports
from mirepoix.plans.views import recipes


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def stored_recipes(spark, sf_dir, tmp_path):
    path = str(tmp_path / "recipes")
    recipes(spark, sf_dir).write.parquet(path)
    return spark.read.parquet(path)


def test_cleaning_is_one_stage_with_pushdown(spark, sf_dir, tmp_path):
    df = cleaning.clean_recipes(stored_recipes(spark, sf_dir, tmp_path))
    text = plan(curation.instruction_pairs(df))
    assert "Exchange" not in text and "Python" not in text
    assert re.search(r"PushedFilters: \[.*LessThan\(minutes,300\)", text)
    schema = re.search(r"ReadSchema: struct<([^>]*)", text).group(1)
    assert "contributor_id" not in schema and "nutrition" not in schema


def test_statistics_do_not_standardise(spark, sf_dir, tmp_path):
    df = cleaning.clean_recipes(stored_recipes(spark, sf_dir, tmp_path))
    text = plan(df.groupBy("n_steps").count())
    assert "preheat" not in text


def test_scores_are_computed_once_per_row(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scored = evaluation.with_recipe_metrics(docs, "text", "text").withColumn("model_name", F.lit("m"))
    metrics = {k: v for k, v in reports.METRIC_COLUMNS.items() if v.startswith("recipe_metrics")}
    optimized = reports.model_metrics(scored, metrics)._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.count("or use") == 1


def test_row_functions_do_not_shuffle(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    text = plan(docs.select(units.standardize_units("text"), scoring.bleu("text", "text"),
                            scoring.recipe_metrics("text", "text")))
    assert "Exchange" not in text and "Python" not in text


def test_histogram_holds_its_edges_twice(spark):
    from mirepoix.operators import exploration

    df = spark.range(100).select(F.col("id").cast("double").alias("v"))
    optimized = exploration.histogram(df, "v", 5)._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.count("scalar-subquery#") <= 2 * 2 and optimized.count("min(v") <= 2


def test_standard_text_is_built_once_per_name():
    assert units.standardize_units("text") is units.standardize_units("text")


def test_column_functions_need_few_analyser_rounds(spark):
    """Every public function of columns, on an expression instead of a column, in half of Spark's rounds."""
    from mirepoix.functions import prompts, text

    df = spark.createDataFrame([("['Preheat oven to 350 degrees', 'mix 1 / 2 cups']",)], "a string")
    items = text.lower_each(text.parse_string_list("a"))
    inputs = [text.join_steps(items), items, F.length("a"), text.parse_number_list("a")]
    rounds = spark.conf.get("spark.sql.analyzer.maxIterations")
    spark.conf.set("spark.sql.analyzer.maxIterations", "50")
    analysed = 0
    try:
        for module in (text, units, scoring, prompts):
            for name, fn in inspect.getmembers(module, inspect.isfunction):
                needed = [p for p in inspect.signature(fn).parameters.values() if p.default is p.empty]
                if name.startswith("_") or fn.__module__ != module.__name__ or not all("Column" in str(p.annotation) for p in needed):
                    continue
                problem = None
                for values in product(inputs, repeat=len(needed)):
                    try:
                        made = fn(*values)
                        df.select(*made if isinstance(made, list) else [made])
                        analysed, problem = analysed + 1, None
                        break
                    except AnalysisException as e:
                        problem = problem or str(e)
                assert problem is None, f"{name}: {problem}"
    finally:
        spark.conf.set("spark.sql.analyzer.maxIterations", rounds)
    assert analysed > 50


def test_one_file_of_short_rows_is_worked_on_by_all_tasks(spark, tmp_path):
    from mirepoix.plans import curation_queries, scoring_queries, unit_queries
    from mirepoix.plans.views import clean, generations

    rows = spark.range(2_000).selectExpr(
        "id AS p_partkey", "concat('soup ', id) AS p_name", "'Brand#1' AS p_brand", "'ECO TIN' AS p_type",
        "CAST(id % 50 + 1 AS INT) AS p_size", "CAST(id AS DOUBLE) AS p_retailprice")
    rows.coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    for made in (clean, generations, unit_queries.standardize_units, scoring_queries.bleu, curation_queries.render_prompt):
        sizes = [r["count"] for r in made(spark, str(tmp_path)).groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) >= 8 and max(sizes) < sum(sizes) / 4


def test_titles_are_cut_into_tokens_once_per_row(spark, sf_dir):
    from mirepoix.plans import cleaning_queries

    found = cleaning_queries.title_tokens(spark, sf_dir)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace(") == 1


def test_steps_are_parsed_once_and_after_the_rows_are_dealt(spark, sf_dir):
    from mirepoix.plans.views import clean

    text = clean(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    above, below = text.split("Repartition", 1)
    assert "from_json" not in below and "< 300" in below
    assert above.count("from_json(ArrayType(StringType") == 3  # tags, steps and ingredients

"""Queries: per-model reports, benchmark rows, sources and sinks, the stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from mirepoix import lookups
from mirepoix.functions import prompts
from mirepoix.operators import cleaning, curation, evaluation, reports
from mirepoix.plans.cleaning_queries import CLEAN_COLUMNS
from mirepoix.plans.curation_queries import stored_pairs
from mirepoix.plans.registry import query
from mirepoix.plans.scoring_queries import BLEU_CTE, SCORE_CTE, SIMILARITY_CTE
from mirepoix.plans.views import (
    JUDGES,
    MODELS,
    RECIPE_COLUMNS,
    clean,
    generations,
    pairs,
    recipes,
    replies,
    table,
    with_views,
)
from mirepoix.session import fresh_path, spread
from mirepoix.sources import schemas, tables
from mirepoix.streaming.files import process_available

# --- per model ---------------------------------------------------------------


@query("model_metrics", with_views("generations", """
SELECT s.model_name, round(avg(b.bleu), 6) AS avg_bleu, round(avg(m.similarity), 6) AS avg_similarity,
       round(avg(coverage), 6) AS avg_ingredient_coverage,
       round(avg(temperature), 6) AS avg_temperature_validation, round(avg(allergy), 6) AS avg_allergen_handling,
       round(avg(coverage * 0.4 + temperature * 0.4 + allergy * 0.2), 6) AS avg_composite_score
FROM scores AS s JOIN bleu AS b ON s.model_name = b.model_name AND s.id = b.id
  JOIN alike AS m ON s.model_name = m.model_name AND s.id = m.id GROUP BY s.model_name""",
    **BLEU_CTE, **SCORE_CTE, **SIMILARITY_CTE))
def model_metrics(spark, sf_dir):
    means = reports.model_metrics(evaluation.calculate_metrics(generations(spark, sf_dir)))
    return means.select("model_name", *[F.round(c, 6).alias(c) for c in reports.METRIC_COLUMNS])


@query("model_metrics_native", with_views("generations", """
SELECT s.model_name, round(avg(b.bleu), 6) AS avg_bleu, round(avg(coverage), 6) AS avg_ingredient_coverage,
       round(avg(temperature), 6) AS avg_temperature_validation, round(avg(allergy), 6) AS avg_allergen_handling,
       round(avg(coverage * 0.4 + temperature * 0.4 + allergy * 0.2), 6) AS avg_composite_score
FROM scores AS s JOIN bleu AS b ON s.model_name = b.model_name AND s.id = b.id GROUP BY s.model_name""",
    **BLEU_CTE, **SCORE_CTE))
def model_metrics_native(spark, sf_dir):
    """Without similarity the whole report runs in the JVM."""
    scored = evaluation.calculate_metrics(generations(spark, sf_dir))
    metrics = {k: v for k, v in reports.METRIC_COLUMNS.items() if k != "avg_similarity"}
    means = reports.model_metrics(scored, metrics)
    return means.select("model_name", *[F.round(c, 6).alias(c) for c in metrics])


def results(spark, sf_dir):
    verdicts = evaluation.resolve_verdicts(replies(spark, sf_dir), JUDGES)
    return reports.benchmark_rows(generations(spark, sf_dir), verdicts)


_RESULTS = """
SELECT g.model_name, g.id, concat('Grandmas Best ', g.p_name, ' Recipe!!') AS dish_name,
       round(g.generation_time, 2) AS generation_time, v.score, v.reasoning,
       CAST(length(g.generated_text) AS INT) AS recipe_length, v.judge_model
FROM generations AS g JOIN verdicts AS v ON g.model_name = v.model_name AND g.id = v.id"""


@query("benchmark_rows", with_views("verdicts", _RESULTS))
def benchmark_rows(spark, sf_dir):
    return results(spark, sf_dir)


@query("judge_report", with_views("verdicts", """
SELECT model_name, round(avg(score), 6) AS avg_score, round(avg(generation_time), 6) AS avg_generation_time
FROM results GROUP BY model_name""", results=_RESULTS))
def judge_report(spark, sf_dir):
    report = reports.judge_report(results(spark, sf_dir))
    return report.select(
        "model_name", F.round("avg_score", 6).alias("avg_score"),
        F.round("avg_generation_time", 6).alias("avg_generation_time"))


@query("structure_report", with_views("generations", """
SELECT model_name, round(avg(generation_time), 6) AS avg_generation_time,
       round(100 * avg(ok::INT::DOUBLE), 6) AS structure_validity, sum(ok::INT)::BIGINT AS valid_recipes,
       count(*) AS total_recipes
FROM (SELECT *, generated_text LIKE '%Ingredients%' AND generated_text LIKE '%Instructions%' AS ok FROM generations) AS g
GROUP BY model_name"""))
def structure_report(spark, sf_dir):
    report = reports.structure_report(generations(spark, sf_dir))
    return report.withColumns({
        c: F.round(c, 6) for c in ("avg_generation_time", "structure_validity")})


@query("run_summary", with_views("generations", """
SELECT count(*) AS total, sum(ok::INT)::BIGINT AS valid, round(100 * avg(ok::INT::DOUBLE), 6) AS valid_percent,
       round(avg(length(generated_text)), 6) AS avg_length
FROM (SELECT *, generated_text ILIKE '%ingredient%' AND generated_text ILIKE '%instruction%' AS ok FROM generations) AS g"""))
def run_summary(spark, sf_dir):
    summary = reports.run_summary(generations(spark, sf_dir))
    return summary.withColumns({c: F.round(c, 6) for c in ("valid_percent", "avg_length")})


_GOLDEN = """
SELECT * FROM (SELECT *, row_number() OVER (ORDER BY md5('42:' || id)) AS r, count(*) OVER () AS n FROM pairs) AS p
WHERE r <= ceil(n * 0.05::DOUBLE) ORDER BY md5('43:' || id), id LIMIT 5"""


def golden(spark, sf_dir):
    return curation.golden_sample(curation.train_test_split(stored_pairs(spark, sf_dir))).drop("split")


@query("models_x_golden", with_views("generations", f"""
SELECT m.model_name, g.id, g.instruction, x.generated_text, x.generation_time
FROM golden AS g CROSS JOIN (VALUES {', '.join(f"('{m}')" for m in (*MODELS, 'missing'))}) AS m(model_name)
LEFT JOIN generations AS x ON x.model_name = m.model_name AND x.id = g.id""", golden=_GOLDEN))
def models_x_golden(spark, sf_dir):
    return reports.models_by_sample(
        golden(spark, sf_dir), generations(spark, sf_dir), [*MODELS, "missing"]).drop("output")


@query("union_runs", with_views("verdicts", f"""
SELECT concat('First (qlora) - ', model_name) AS model_name, id, score FROM results
UNION ALL SELECT concat('Second - ', model_name), id, score FROM results""", results=_RESULTS))
def union_runs(spark, sf_dir):
    rows = results(spark, sf_dir).select("model_name", "id", "score")
    return reports.union_runs({"First (qlora)": rows, "Second": rows})


def variants(spark, sf_dir):
    rows = generations(spark, sf_dir)
    truth = rows.filter(F.col("model_name") == "base").select(
        "id", "instruction", F.lit("truth").alias("variant"), F.col("reference").alias("text"))
    stripped = prompts.strip_everywhere("generated_text", prompts.inference_prompt("instruction"))
    return truth.unionByName(rows.select(
        "id", "instruction", F.col("model_name").alias("variant"), stripped.alias("text")))


_WIDE = """
SELECT id, instruction, max(CASE WHEN model_name = 'base' THEN reference END) AS truth,
       max(CASE WHEN model_name = 'base' THEN bare END) AS base, max(CASE WHEN model_name = 'tuned' THEN bare END) AS tuned
FROM (SELECT *, trim(replace(generated_text, concat('Instruction: ', instruction, chr(10), chr(10), 'Recipe:'), ''),
             ' ' || chr(10)) AS bare FROM generations) AS g GROUP BY id, instruction"""


@query("side_by_side", with_views("generations", _WIDE))
def side_by_side(spark, sf_dir):
    return reports.side_by_side(variants(spark, sf_dir), ["truth", "base", "tuned"])


# --- training log ------------------------------------------------------------

# Log documents of at most 100 entries each: every fifth entry is a validation.
_ENTRY = {
    "epoch": "CAST(p_partkey AS DOUBLE) / 100",
    "step": "p_partkey",
    "loss": "CASE WHEN p_partkey % 5 <> 0 THEN 1.0D + p_size / 100.0D END",
    "eval_loss": "CASE WHEN p_partkey % 5 = 0 THEN 2.0D + p_size / 100.0D END",
}


def training_log(spark, sf_dir):
    path = fresh_path(spark, "training-log")
    part = table(spark, sf_dir, "part")
    entries = F.struct(*[F.expr(e).alias(n) for n, e in _ENTRY.items()])
    documents = part.groupBy(F.floor(F.col("p_partkey") / 100).alias("run")).agg(
        F.sort_array(F.collect_list(entries)).alias("log_history"))
    documents.drop("run").write.json(path)
    return tables.read_training_log(spark, path, one_per_line=True)


_LOG = """
SELECT CAST(p_partkey AS DOUBLE) / 100 AS epoch, p_partkey AS step,
       CASE WHEN p_partkey % 5 <> 0 THEN 1 + p_size / 100.0::DOUBLE END AS loss,
       CASE WHEN p_partkey % 5 = 0 THEN 2 + p_size / 100.0::DOUBLE END AS eval_loss FROM part"""


@query("src_training_log", f"SELECT epoch, step, loss, eval_loss FROM ({_LOG}) AS l")
def src_training_log(spark, sf_dir):
    return training_log(spark, sf_dir).select("epoch", "step", "loss", "eval_loss")


@query("loss_series", f"SELECT step, loss AS train_loss, eval_loss FROM ({_LOG}) AS l")
def loss_series(spark, sf_dir):
    return reports.loss_series(training_log(spark, sf_dir))


# --- sources and sinks -------------------------------------------------------

_CSV_COLUMNS = [c for c in schemas.RECIPE_COLUMNS if c in RECIPE_COLUMNS]


@query("src_recipes_csv", with_views(
    "recipes_src", f"SELECT {', '.join(_CSV_COLUMNS)} FROM recipes_src"))
def src_recipes_csv(spark, sf_dir):
    path = fresh_path(spark, "recipes-csv")
    tables.write_recipes_csv(recipes(spark, sf_dir).select(*_CSV_COLUMNS), path)
    return tables.read_recipes(spark, path)


@query("src_recipes_csv_split", with_views("recipes_src", f"""
SELECT {', '.join(c for c in _CSV_COLUMNS if c != 'description')}, description || chr(10) || '"so", he said,' || chr(10) || chr(10) || id AS description
FROM recipes_src"""))
def src_recipes_csv_split(spark, sf_dir):
    """One file with line breaks and quotes inside its fields."""
    path = fresh_path(spark, "recipes-csv")
    said = F.concat("description", F.lit('\n"so", he said,\n\n'), F.col("id").cast("string"))
    rows = recipes(spark, sf_dir).withColumn("description", said).select(*_CSV_COLUMNS)
    tables.write_recipes_csv(rows.coalesce(1), path)
    return tables.read_recipes_split(spark, path)


@query("src_load_or_build", with_views("clean", f"SELECT {', '.join(CLEAN_COLUMNS)} FROM clean"))
def src_load_or_build(spark, sf_dir):
    path = fresh_path(spark, "load-or-build")

    def build():
        return clean(spark, sf_dir).select(*CLEAN_COLUMNS)

    def never():
        raise AssertionError("the table is there")

    tables.load_or_build(spark, path, build)
    return tables.load_or_build(spark, path, never)


@query("sink_clean", with_views("clean", f"SELECT {', '.join(CLEAN_COLUMNS)} FROM clean"))
def sink_clean(spark, sf_dir):
    path = fresh_path(spark, "clean")
    tables.write_table(clean(spark, sf_dir).select(*CLEAN_COLUMNS), path)
    return tables.read_table(spark, path)


def _stored_jsonl(spark, sf_dir):
    path = fresh_path(spark, "pairs-jsonl")
    tables.write_pairs_jsonl(pairs(spark, sf_dir), path)
    return path


@query("sink_jsonl", with_views("pairs", "SELECT count(*) AS n, sum(length(output))::BIGINT AS chars FROM pairs"))
def sink_jsonl(spark, sf_dir):
    """Written twice: the second write finds the output and leaves it."""
    path = _stored_jsonl(spark, sf_dir)
    tables.write_pairs_jsonl(spark.range(1).selectExpr("id", "'x' AS instruction", "'y' AS output"), path)
    return tables.read_pairs_jsonl(spark, path).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("output")).alias("chars"))


@query("src_jsonl", with_views("pairs", "SELECT id, instruction, output FROM pairs"))
def src_jsonl(spark, sf_dir):
    return tables.read_pairs_jsonl(spark, _stored_jsonl(spark, sf_dir))


@query("sink_benchmark_csv", with_views("verdicts", """
SELECT model_name, dish_name, generation_time, score, concat(reasoning, ', "so" it', chr(10), 'goes') AS reasoning,
       recipe_length, judge_model FROM results""", results=_RESULTS))
def sink_benchmark_csv(spark, sf_dir):
    path = fresh_path(spark, "benchmark-csv")
    rows = results(spark, sf_dir).drop("id").withColumn(
        "reasoning", F.concat("reasoning", F.lit(', "so" it\ngoes')))
    order = [c.split()[0] for c in schemas.BENCHMARK_RESULTS.split(", ")]
    tables.write_benchmark_csv(rows.select(*order), path)
    return tables.read_benchmark_csv(spark, path)


_BLOCK = "concat({})".format(", chr(10), ".join([
    "chr(10)", "repeat('#', 80)",
    f"'{lookups.SAMPLE_HEADING}' || id || ': ' || instruction", "repeat('#', 80)",
    *[x for name, heading in lookups.VARIANT_HEADINGS[:3]
      for x in (f"chr(10) || '{heading}'", name)],
    "chr(10)",
]).replace("chr(10), chr(10), repeat", "chr(10), repeat", 1))


@query("sink_report_text", with_views("generations", f"""
SELECT unnest(string_split({_BLOCK}, chr(10))) AS value FROM wide""", wide=_WIDE))
def sink_report_text(spark, sf_dir):
    path = fresh_path(spark, "report-text")
    wide = reports.side_by_side(variants(spark, sf_dir), ["truth", "base", "tuned"])
    tables.write_text(reports.report_text(wide), path)
    return spark.read.text(path)


# --- the stream --------------------------------------------------------------


@query("stream_clean", with_views("clean", f"SELECT {', '.join(CLEAN_COLUMNS)} FROM clean"))
def stream_clean(spark, sf_dir):
    """The cleaning as a file stream over the part table; same rows as the batch."""
    target = fresh_path(spark, "stream-clean")
    columns = [f"{e} AS {n}" for n, e in RECIPE_COLUMNS.items()]

    def transform(part):
        return cleaning.clean_recipes(spread(part).selectExpr(*columns)).select(*CLEAN_COLUMNS)

    process_available(
        spark, sf_dir, table(spark, sf_dir, "part").schema, transform, target,
        fresh_path(spark, "stream-progress"), name_filter="part.parquet",
    )
    return tables.read_table(spark, target)

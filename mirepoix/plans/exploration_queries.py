"""Queries: exploratory statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from mirepoix.operators import exploration
from mirepoix.plans.registry import query
from mirepoix.plans.views import NUTRITION, clean, table, with_views

RATIO_NAMES = [f"{a}_to_{b}" for a, b in exploration.RATIOS]

# Rows of a cleaned table without the standardised text, with some NULL groups.
_EDA = """
SELECT id, minutes, n_steps, n_ingredients, CASE WHEN id % 19 = 0 THEN NULL ELSE cuisine END AS cuisine,
       calories, total_fat, sugar, sodium, protein, saturated_fat, carbohydrates, p_name FROM clean"""


def eda(spark, sf_dir):
    rows = clean(spark, sf_dir, standardize=False)
    return rows.withColumn("cuisine", F.when(F.col("id") % 19 != 0, F.col("cuisine")))


def _sql(body: str, **extra: str) -> str:
    return with_views("clean", body, eda=_EDA, **extra)


def _rounded(df, *columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query("value_counts_top10", _sql("""
SELECT n_steps, count(*) AS "count" FROM eda WHERE n_steps IS NOT NULL GROUP BY n_steps
ORDER BY "count" DESC, n_steps LIMIT 10"""))
def value_counts_top10(spark, sf_dir):
    return exploration.value_counts(eda(spark, sf_dir), "n_steps")


@query("label_counts", """
SELECT quality, toxic, count(*) AS n FROM labels GROUP BY quality, toxic""")
def label_counts(spark, sf_dir):
    return table(spark, sf_dir, "labels").groupBy("quality", "toxic").agg(
        F.count(F.lit(1)).alias("n"))


@query("mean_by_group", _sql("""
SELECT cuisine, round(avg(n_steps), 6) AS mean_n_steps, round(avg(n_ingredients), 6) AS mean_n_ingredients
FROM eda WHERE cuisine IS NOT NULL GROUP BY cuisine"""))
def mean_by_group(spark, sf_dir):
    means = exploration.mean_by_group(
        eda(spark, sf_dir), "cuisine", ["n_steps", "n_ingredients"],
        order="mean_n_ingredients", descending=True)
    return _rounded(means, "mean_n_steps", "mean_n_ingredients")


@query("multi_mean_by_group", _sql(f"""
SELECT cuisine, {', '.join(f'round(avg({c}), 6) AS mean_{c}' for c in NUTRITION)}
FROM eda WHERE cuisine IS NOT NULL GROUP BY cuisine"""))
def multi_mean_by_group(spark, sf_dir):
    means = exploration.mean_by_group(eda(spark, sf_dir), "cuisine", list(NUTRITION))
    return _rounded(means, *[f"mean_{c}" for c in NUTRITION])


@query("std_by_group", _sql(f"""
SELECT cuisine, {', '.join(f'round(stddev_samp({c}), 6) AS std_{c}' for c in NUTRITION)}
FROM eda WHERE cuisine IS NOT NULL GROUP BY cuisine"""))
def std_by_group(spark, sf_dir):
    stds = exploration.std_by_group(eda(spark, sf_dir), "cuisine", list(NUTRITION))
    return _rounded(stds, *[f"std_{c}" for c in NUTRITION])


_BOX = """
SELECT e.cuisine, q.n_rows, q.q1, q.median, q.q3,
       min(CASE WHEN v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN v END) AS whisker_low,
       max(CASE WHEN v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN v END) AS whisker_high,
       sum(CASE WHEN v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN 0 ELSE 1 END)::BIGINT AS n_outliers
FROM (SELECT cuisine, {column}::DOUBLE AS v FROM eda WHERE cuisine IS NOT NULL) AS e JOIN (
  SELECT cuisine, count(*) AS n_rows, quantile_cont({column}::DOUBLE, 0.25) AS q1,
         quantile_cont({column}::DOUBLE, 0.5) AS median, quantile_cont({column}::DOUBLE, 0.75) AS q3
  FROM eda WHERE cuisine IS NOT NULL GROUP BY cuisine) AS q ON e.cuisine = q.cuisine
GROUP BY e.cuisine, q.n_rows, q.q1, q.median, q.q3"""


@query("boxplot_stats", _sql(_BOX.format(column="n_ingredients")))
def boxplot_stats(spark, sf_dir):
    return exploration.boxplot_stats(eda(spark, sf_dir), "cuisine", "n_ingredients")


@query("boxplot_stats_calories", _sql(_BOX.format(column="calories")))
def boxplot_stats_calories(spark, sf_dir):
    return exploration.boxplot_stats(eda(spark, sf_dir), "cuisine", "calories")


@query("boxplot_stats_ranged", """
SELECT e.l_returnflag, q.n_rows, q.q1, q.median, q.q3,
       min(CASE WHEN v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN v END) AS whisker_low,
       max(CASE WHEN v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN v END) AS whisker_high,
       sum(CASE WHEN v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN 0 ELSE 1 END)::BIGINT AS n_outliers
FROM (SELECT l_returnflag, l_extendedprice AS v FROM lineitem) AS e JOIN (
  SELECT l_returnflag, count(*) AS n_rows, round(quantile_cont(l_extendedprice, 0.25), 6) AS q1,
         round(quantile_cont(l_extendedprice, 0.5), 6) AS median, round(quantile_cont(l_extendedprice, 0.75), 6) AS q3
  FROM lineitem GROUP BY l_returnflag) AS q ON e.l_returnflag = q.l_returnflag
GROUP BY e.l_returnflag, q.n_rows, q.q1, q.median, q.q3""")
def boxplot_stats_ranged(spark, sf_dir):
    """Few groups with very many distinct values: the range-partitioned ranking."""
    rows = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_extendedprice")
    stats = exploration.boxplot_stats(rows, "l_returnflag", "l_extendedprice")
    return _rounded(stats, "q1", "median", "q3")


_HISTOGRAM = """
SELECT b.bin, round(lo + b.bin * (hi - lo) / {bins}, 6) AS bin_start, coalesce(h.n, 0) AS n
FROM (SELECT min({column})::DOUBLE AS lo, max({column})::DOUBLE AS hi FROM eda) AS e,
     (SELECT unnest(range(0, {bins})) AS bin) AS b
LEFT JOIN (
  SELECT CAST(least(floor(({column} - lo) / ((hi - lo) / {bins})), {last}) AS BIGINT) AS bin, count(*) AS n
  FROM eda, (SELECT min({column})::DOUBLE AS lo, max({column})::DOUBLE AS hi FROM eda) AS m
  GROUP BY 1) AS h ON h.bin = b.bin"""


@query("histogram", _sql(_HISTOGRAM.format(column="n_steps", bins=50, last=49)))
def histogram(spark, sf_dir):
    return _rounded(exploration.histogram(eda(spark, sf_dir), "n_steps", 50), "bin_start")


@query("histogram_ingredients", _sql(_HISTOGRAM.format(column="n_ingredients", bins=35, last=34)))
def histogram_ingredients(spark, sf_dir):
    return _rounded(exploration.histogram(eda(spark, sf_dir), "n_ingredients", 35), "bin_start")


@query("density_curve", _sql("""
SELECT point, round(lo + point * step, 9) AS x, round(sum(w * exp(-0.5 * power((point - k) * step / h, 2))) / (any_value(n) * any_value(h) * sqrt(2 * pi())), 9) AS density
FROM (SELECT k, sum(w) AS w FROM (
        SELECT least(floor((v - lo) / step), 198)::BIGINT + side AS k,
               CASE WHEN side = 0 THEN 1 - ((v - lo) / step - least(floor((v - lo) / step), 198)) ELSE (v - lo) / step - least(floor((v - lo) / step), 198) END AS w
        FROM (SELECT CAST(minutes AS DOUBLE) AS v FROM eda WHERE minutes IS NOT NULL), shape, (VALUES (0), (1)) sides(side)) GROUP BY k),
     shape, (SELECT unnest(range(200)) AS point) GROUP BY point, lo, step""", shape="""
SELECT min(minutes)::DOUBLE AS lo, (max(minutes) - min(minutes)) / 199.0::DOUBLE AS step, count(*) AS n,
       stddev_samp(minutes) * power(count(*), -0.2) AS h FROM eda WHERE minutes IS NOT NULL"""))
def density_curve(spark, sf_dir):
    return _rounded(exploration.density_curve(eda(spark, sf_dir), "minutes"), "x", "density", digits=9)


@query("explode_counts", _sql("""
SELECT label, count(*) AS "count" FROM (SELECT unnest(list_concat([cuisine], string_split(p_name, ' '))) AS label
FROM eda WHERE cuisine IS NOT NULL) AS l GROUP BY label"""))
def explode_counts(spark, sf_dir):
    rows = eda(spark, sf_dir).filter("cuisine IS NOT NULL").select(
        F.concat(F.array("cuisine"), F.split("p_name", " ")).alias("cuisines"))
    return exploration.explode_counts(rows, "cuisines", "label")


_SWAPPED = """
SELECT id, cuisine, calories, sugar, sodium, protein, carbohydrates,
       greatest(total_fat, saturated_fat) AS total_fat, least(total_fat, saturated_fat) AS saturated_fat FROM eda"""


@query("swap_columns", _sql("SELECT id, total_fat, saturated_fat FROM swapped", swapped=_SWAPPED))
def swap_columns(spark, sf_dir):
    return exploration.swap_columns(eda(spark, sf_dir)).select("id", "total_fat", "saturated_fat")


def ratios(spark, sf_dir):
    return exploration.ratio_columns(exploration.swap_columns(eda(spark, sf_dir)))


_RATIOS = "SELECT id, cuisine, {} FROM swapped".format(
    ", ".join(f"CASE WHEN {b} <> 0 THEN {a} / {b} END AS {a}_to_{b}" for a, b in exploration.RATIOS))


@query("ratio_columns", _sql(
    f"SELECT id, {', '.join(f'round({r}, 9) AS {r}' for r in RATIO_NAMES)} FROM ratios",
    swapped=_SWAPPED, ratios=_RATIOS))
def ratio_columns(spark, sf_dir):
    return _rounded(ratios(spark, sf_dir).select("id", *RATIO_NAMES), *RATIO_NAMES, digits=9)


@query("finite_only", _sql(
    "SELECT id, round(sugar_to_calories, 9) AS sugar_to_calories FROM ratios WHERE isfinite(sugar_to_calories)",
    swapped=_SWAPPED, ratios=_RATIOS))
def finite_only(spark, sf_dir):
    rows = exploration.finite_only(ratios(spark, sf_dir), "sugar_to_calories")
    return _rounded(rows.select("id", "sugar_to_calories"), "sugar_to_calories", digits=9)


@query("ratio_by_group", _sql(
    " UNION ALL ".join(
        f"SELECT cuisine, '{r}' AS ratio, round(avg({r}), 6) AS mean_ratio FROM ratios "
        f"WHERE cuisine IS NOT NULL AND isfinite({r}) GROUP BY cuisine" for r in RATIO_NAMES),
    swapped=_SWAPPED, ratios=_RATIOS))
def ratio_by_group(spark, sf_dir):
    return _rounded(
        exploration.ratio_by_group(ratios(spark, sf_dir), "cuisine", RATIO_NAMES), "mean_ratio")


@query("outlier_rows", _sql("SELECT id, calories FROM eda WHERE calories > 2000"))
def outlier_rows(spark, sf_dir):
    return exploration.outlier_rows(eda(spark, sf_dir)).select("id", "calories")


@query("minutes_steps_corr", _sql("""
SELECT round(corr(minutes::DOUBLE, n_steps::DOUBLE), 9) AS corr, count(*) AS n FROM eda"""))
def minutes_steps_corr(spark, sf_dir):
    return _rounded(exploration.correlation(eda(spark, sf_dir), "minutes", "n_steps"), "corr", digits=9)


@query("minutes_steps_bins", _sql("""
SELECT CAST(floor(minutes / 30.0) AS BIGINT) AS minutes_bin, CAST(floor(n_steps / 5.0) AS BIGINT) AS n_steps_bin,
       count(*) AS n FROM eda GROUP BY 1, 2"""))
def minutes_steps_bins(spark, sf_dir):
    return exploration.grid_counts(eda(spark, sf_dir), "minutes", "n_steps", 30, 5)


@query("align_columns", """
SELECT d.doc_id, d.lang, d.n_chars, l.quality, l.toxic FROM documents AS d JOIN labels AS l ON d.doc_id = l.doc_id""")
def align_columns(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    return exploration.align_columns(docs, table(spark, sf_dir, "labels"), "doc_id")


@query("preview", """
SELECT doc_id, substr(text, 1, 100) AS text FROM documents ORDER BY doc_id LIMIT 5""")
def preview(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return exploration.preview(docs, "doc_id", columns=["text"])

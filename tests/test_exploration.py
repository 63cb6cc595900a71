"""Statistics against numpy and pandas, with skewed groups."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from mirepoix.operators import exploration


@pytest.fixture(scope="module")
def skewed(spark):
    return spark.range(0, 3000).select(
        F.when(F.col("id") % 3 > 0, "big").otherwise(
            F.concat(F.lit("g"), (F.col("id") % 11).cast("string"))).alias("g"),
        F.when(F.col("id") % 97 == 0, F.col("id") * 10.0).otherwise(
            F.pmod(F.hash("id"), F.lit(400)).cast("double")).alias("v"),
    ).cache()


def test_boxplot_matches_numpy(spark, skewed):
    pdf = skewed.toPandas()
    got = {r.g: r for r in exploration.boxplot_stats(
        skewed, "g", "v").collect()}
    assert set(got) == set(pdf.g)
    for g, values in pdf.groupby("g").v:
        q1, median, q3 = np.percentile(values, [25, 50, 75])
        low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        inner = values[(values >= low) & (values <= high)]
        r = got[g]
        assert (r.q1, r.median, r.q3) == pytest.approx((q1, median, q3))
        assert (r.whisker_low, r.whisker_high) == (inner.min(), inner.max())
        assert (r.n_rows, r.n_outliers) == (len(values), len(values) - len(inner))


@pytest.mark.parametrize("bins", [1, 7, 50])
def test_histogram_matches_numpy(spark, skewed, bins):
    counts, edges = np.histogram(skewed.toPandas().v, bins=bins)
    rows = sorted(exploration.histogram(skewed, "v", bins).collect(), key=lambda r: r.bin)
    assert [r.n for r in rows] == list(counts)
    assert [r.bin_start for r in rows] == pytest.approx(list(edges[:-1]))


def test_histogram_of_one_value(spark):
    rows = exploration.histogram(spark.range(5).select(F.lit(2).alias("v")), "v", 3).collect()
    assert sorted((r.bin, r.n) for r in rows) == [(0, 5), (1, 0), (2, 0)]


def test_means_and_deviations(spark, skewed):
    pdf = skewed.toPandas().groupby("g").v
    means = {r.g: r.mean_v for r in exploration.mean_by_group(skewed, "g", ["v"]).collect()}
    stds = {r.g: r.std_v for r in exploration.std_by_group(skewed, "g", ["v"]).collect()}
    assert means == pytest.approx(pdf.mean().to_dict())
    assert stds == pytest.approx(pdf.std().to_dict())


def test_null_groups_are_left_out(spark):
    df = spark.createDataFrame([("a", 1.0), (None, 5.0)], "g string, v double")
    assert [r.g for r in exploration.mean_by_group(df, "g", ["v"]).collect()] == ["a"]
    assert [r.g for r in exploration.value_counts(df, "g").collect()] == ["a"]


def test_zero_divisor_and_swap(spark):
    df = spark.createDataFrame(
        [(0.0, 3.0, 5.0, 1.0, 1.0, 1.0, 1.0), (100.0, 6.0, None, 1.0, 1.0, 1.0, 1.0)],
        "calories double, total_fat double, saturated_fat double, sugar double, sodium double, "
        "protein double, carbohydrates double")
    swapped = exploration.swap_columns(df).collect()
    assert (swapped[0].total_fat, swapped[0].saturated_fat) == (5.0, 3.0)
    assert (swapped[1].total_fat, swapped[1].saturated_fat) == (6.0, None)
    ratios = exploration.ratio_columns(df)
    assert ratios.first().sugar_to_calories is None
    assert exploration.finite_only(ratios, "sugar_to_calories").count() == 1


def test_density_curve_is_near_the_exact_estimate(spark):
    import math
    import random

    draw = random.Random(5)
    values = [draw.gauss(draw.choice([0, 6]), 1) for _ in range(2000)]
    df = spark.createDataFrame([(v,) for v in [*values, None, float("nan")]], "v double")
    got = exploration.density_curve(df, "v").collect()
    mean = sum(values) / len(values)
    width = math.sqrt(sum((v - mean) ** 2 for v in values) / (len(values) - 1)) * len(values) ** -0.2
    assert len(got) == 200
    for r in got:
        exact = sum(math.exp(-0.5 * ((r["x"] - v) / width) ** 2) for v in values) / (len(values) * width * math.sqrt(2 * math.pi))
        assert abs(r["density"] - exact) < 2e-4
    assert exploration.density_curve(df.filter("v is null"), "v").count() == 0
    assert exploration.density_curve(spark.createDataFrame([(1.0,), (1.0,)], "v double"), "v").count() == 0

"""Row numbers, seeded order and splits, also with one key filling the table."""

import hashlib
import math

import pytest
from pyspark.sql import functions as F

from mirepoix.operators import curation
from mirepoix.operators.ordering import lay_out, with_row_index


def digest(seed, key):
    return hashlib.md5(f"{seed}:{key}".encode()).hexdigest()


def test_row_index_with_a_hot_value(spark):
    df = spark.range(0, 3000, numPartitions=7).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"))
    rows = with_row_index(df, ["k"]).collect()
    assert sorted(r["index"] for r in rows) == list(range(3000))
    ordered = [r.k for r in sorted(rows, key=lambda r: r["index"])]
    assert ordered == sorted(ordered)


def test_hot_value_spreads_over_tasks(spark):
    df = spark.range(0, 20000, numPartitions=4).select(F.lit(1).alias("k"))
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")  # the data is too small to stay split otherwise
    try:
        placed = lay_out(df, "k")
        sizes = [r["count"] for r in placed.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set(setting, "true")
    assert len(sizes) == 8 and max(sizes) < 5000


def test_row_index_within_keys(spark):
    df = spark.range(0, 500).select((F.col("id") % 3).alias("g"), F.col("id").alias("v"))
    rows = with_row_index(df, ["v"], "at", ["g"]).collect()
    for g in range(3):
        part = sorted((r.v, r.at) for r in rows if r.g == g)
        assert [at for _, at in part] == list(range(len(part)))


def test_row_index_of_nothing(spark):
    assert with_row_index(spark.range(0), ["id"]).count() == 0


@pytest.mark.parametrize("n", [1, 19, 20, 21, 140, 1000])
def test_split_is_exact(spark, n):
    df = spark.range(n)
    test = {r.id for r in curation.train_test_split(df).filter("split = 'test'").collect()}
    size = math.ceil(n * 0.05)
    assert test == set(sorted(range(n), key=lambda i: digest(42, i))[:size])


def test_split_keeps_copies_together(spark):
    df = spark.range(300).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("id"))
    sides = curation.train_test_split(df).groupBy("id").agg(F.countDistinct("split").alias("n"))
    assert sides.filter("n > 1").count() == 0
    assert curation.train_test_split(df).count() == 300


@pytest.mark.parametrize("size", [1, 50, 5000])
def test_subset(spark, size):
    got = [r.id for r in curation.seeded_subset(spark.range(1000), size).collect()]
    assert sorted(got) == sorted(sorted(range(1000), key=lambda i: digest(42, i))[:size])


def test_subset_inside_copies(spark):
    df = spark.range(300).select(F.lit(5).alias("id"))
    assert curation.seeded_subset(df, 10).count() == 10


def test_shuffle_order_repeats(spark):
    got = [r.id for r in curation.seeded_shuffle(spark.range(200)).collect()]
    assert got == sorted(range(200), key=lambda i: digest(42, i)) != list(range(200))


def test_golden_sample(spark):
    split = curation.train_test_split(spark.range(400))
    first = {r.id for r in curation.golden_sample(split).collect()}
    assert len(first) == 5 and first == {r.id for r in curation.golden_sample(split).collect()}
    assert curation.golden_sample(spark.range(3)).count() == 3


def test_sequence_budget(spark):
    df = spark.createDataFrame([("a b c d",), ("a",), ("",)], "text string")
    rows = curation.sequence_budget(df, 3).collect()
    assert [r.tokens for r in rows] == [["a", "b", "c"], ["a", "<pad>", "<pad>"], ["<pad>"] * 3]
    assert [r.attention for r in rows] == [[1, 1, 1], [1, 0, 0], [0, 0, 0]]
    assert [(r.n_tokens, r.over_budget) for r in rows] == [(4, True), (1, False), (0, False)]
    assert all(r.labels == r.tokens for r in rows)


def test_group_by_length_orders_and_keeps_rows(spark):
    df = spark.range(500).select(F.repeat(F.lit("w "), (F.col("id") % 5).cast("int")).alias("text"))
    grouped = curation.group_by_length(df)
    assert grouped.count() == 500
    lengths = [len(r.text.split()) for r in grouped.collect()]
    assert lengths == sorted(lengths)


def test_length_grouped_batches_match_a_sampler_in_plain_python(spark):
    import hashlib
    import random

    from mirepoix.operators import curation

    draw = random.Random(3)
    for n in (0, 1, 5, 40, 3000):
        rows = [(i, " ".join("w" * draw.randint(0, 60))) for i in range(n)]
        df = spark.createDataFrame(rows, "id long, text string")
        got = curation.length_grouped_batches(df, 4, 9).collect()
        order = sorted(rows, key=lambda r: (hashlib.md5(f"9:{r[0]}".encode()).hexdigest(), r[0]))
        size = max(1, min(50, n // 16)) * 4
        megas = [sorted(order[a:a + size], key=lambda r: -len(r[1].split())) for a in range(0, n, size)]
        if megas:
            best = max(range(len(megas)), key=lambda m: (len(megas[m][0][1].split()), -m))
            megas[0][0], megas[best][0] = megas[best][0], megas[0][0]
        want = {r[0]: (k // 4, k % 4, len(r[1].split())) for k, r in enumerate(r for m in megas for r in m)}
        assert {r["id"]: (r["batch"], r["slot"], r["n_tokens"]) for r in got} == want
        waste = curation.padding_waste(curation.length_grouped_batches(df, 4, 9)).first()
        assert waste["n_texts"] == n and waste["n_batches"] == -(-n // 4)

"""Learnt abbreviations against a plain count, and what they change in the words of a text."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from mirepoix.functions import scoring
from mirepoix.operators import abbreviations, evaluation


def corpus():
    draw = random.Random(5)
    plain = ["mix", "bake", "flour", "pan", "stir", "salt", "a", "cook", "1.5", "20", "(cold)", "half-and-half"]
    short = ["approx.", "min.", "e.g.", "tbsp.,", "(tsp.", "St."]
    rows = []
    for i in range(300):
        words = [draw.choice(short) if draw.random() < 0.15 else draw.choice(plain) for _ in range(draw.randint(1, 15))]
        rows.append(" ".join(words) + draw.choice([".", "!", "...", ".)", ""]))
    return [*rows, "", None, " ", "...", "dr. dr. dr. dr.", "once."]


def learnt(texts, least_count=5, least_share=1e-5):
    stops, bare = Counter(), Counter()
    for t in texts:
        for w in (t or "").lower().split():
            w = re.sub(r"""^["'`(\[{<]+|[\])}>"'`,;:!?]+$""", "", w)
            if w:
                ends = w.endswith(".") and not w.endswith("..")
                (stops if ends else bare)[w[:-1] if ends else w] += 1
    n, p = sum(stops.values()) + sum(bare.values()), sum(stops.values()) / (sum(stops.values()) + sum(bare.values()))
    out = {}
    for w, c in stops.items():
        if c < least_count or not any(x.isalpha() for x in w) or c + bare[w] < n * least_share:
            continue
        size = len(w.replace(".", ""))
        ratio = -2 * (c * math.log(p) + bare[w] * math.log(1 - p) - c * math.log(0.99) - bare[w] * math.log(0.01))
        score = ratio * math.exp(-size) * (w.count(".") + 1) * size ** -bare[w]
        if score >= 0.3:
            out[w] = (c, bare[w], score)
    return out


@pytest.mark.parametrize("least_count, least_share", [(5, 1e-5), (1, 1e-5), (5, 0.03)])
def test_learner_matches_a_plain_count(spark, least_count, least_share):
    df = spark.createDataFrame([(t, "x") for t in corpus()], "text string, word string")
    want = learnt(corpus(), least_count, least_share)
    got = abbreviations.learn_abbreviations(df, "text", least_count, least_share).collect()
    assert {r.word for r in got} == set(want) and len(got) == len(want) <= 1 / least_share
    for r in got:
        assert (r.with_stop, r.without) == want[r.word][:2] and r.score == pytest.approx(want[r.word][2])
    if least_share < 0.01:
        assert {"approx", "min", "e.g", "tbsp", "tsp", "st"} <= set(want) and not {"mix", "once", "salt"} & set(want)


def test_no_words_and_only_stops(spark):
    df = spark.createDataFrame([(None,), ("",)], "text string")
    assert abbreviations.as_list(abbreviations.learn_abbreviations(df, "text")) == ()
    only = spark.createDataFrame([("ab.",)] * 6, "text string")
    assert abbreviations.learn_abbreviations(only, "text").collect() == []


CASES = [
    ("Bake approx. 5 min. Then cool.", ["bake", "approx.", "5", "min.", "then", "cool", "."]),
    ("Add 2 tbsp., stir", ["add", "2", "tbsp.", ",", "stir"]),
    ("Wait 5 min.", ["wait", "5", "min", "."]),
    ("Use (e.g. salt) now. Stir", ["use", "(", "e.g.", "salt", ")", "now", ".", "stir"]),
    ("minimum. min", ["minimum", ".", "min"]),
    ("", []),
]


@pytest.mark.parametrize("text, words", CASES)
def test_stops_of_abbreviations_stay(spark, text, words):
    known = ("approx", "min", "tbsp", "e.g")
    assert spark.range(1).select(scoring.bleu_tokens(F.lit(text), known)).first()[0] == words


def test_without_abbreviations_nothing_changes(spark):
    df = spark.createDataFrame([(t,) for t in corpus()], "t string")
    other = scoring.bleu_tokens("t", ("notthere",))
    assert df.filter(~scoring.bleu_tokens("t").eqNullSafe(other)).take(1) == []


def test_scores_take_abbreviations(spark):
    df = spark.createDataFrame([("bake approx. 5 minutes", "bake approx . 5 minutes")], "reference string, generated_text string")
    plain, told = (evaluation.calculate_metrics(df, abbreviations=known).first().bleu for known in ((), ("approx",)))
    assert plain == pytest.approx(1.0) and told < 0.9


def test_many_abbreviations_are_looked_up_by_hash(spark):
    known = tuple(f"w{i}" for i in range(5_000))
    df = spark.createDataFrame([("w17. w4999. w5000. x",)], "t string")
    made = df.select(scoring.bleu_tokens("t", known).alias("w"))
    assert made.first().w == ["w17.", "w4999.", "w5000", ".", "x"]
    assert " INSET " in made._jdf.queryExecution().optimizedPlan().toString()

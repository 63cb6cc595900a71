"""Recipe scores on worked-out cases, BLEU and similarity against brute force."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from mirepoix import lookups
from mirepoix.functions import prompts, scoring
from mirepoix.functions.core import single_spaced, split_words

CASES = [
    # case, reference, generated, (used, total), (valid, invalid), allergens, swaps, warned, allergen score, composite
    ("all used", "Ingredients: oats, honey, raisins, walnut\n\nInstructions:\nToast everything.",
     "Toast the oats with walnut pieces at 150°C. Fold in honey, then raisins.",
     (4, 4), (1, 0), ["walnut"], 0, False, 0.3, 0.4 + 0.4 + 0.06),
    ("some missing", "Ingredients: oats, honey, raisins, walnut\n\nInstructions:\nToast everything.",
     "Warm the honey to 60 degrees C and pour it over the oats.",
     (2, 4), (1, 0), [], 0, False, 0.0, 0.2 + 0.4),
    ("hot and cold", "Serve at once", "Freeze at -5°C, then poach at 82°C.",
     (0, 0), (2, 0), [], 0, False, 0.0, 0.4),
    ("absurd", "Serve at once", "Roast at 900°C, rest at 40°C, grill at 666°C, chill to 4°C.",
     (0, 0), (2, 2), [], 0, False, 0.0, 0.2),
    ("allergen named and swapped", "Ingredients: tofu, sesame oil, rye bread",
     "Contains soy. Spread the tofu on rye bread; you can use olive oil instead of sesame oil.",
     (3, 3), (0, 0), ["rye", "sesame", "soy", "tofu"], 2, True, 1.0, 0.4 + 0.2 + 0.2),
    ("allergen only named", "Ingredients: tofu, sesame oil, rye bread", "Fry tofu in sesame oil, eat with rye bread.",
     (3, 3), (0, 0), ["rye", "sesame", "tofu"], 0, False, 0.3, 0.4 + 0.2 + 0.06),
    ("everything", "Ingredients: shrimp, rice, lemon\n\nSteps:\nBoil.",
     "Warning for shrimp. Boil rice at 100°C, add lemon, or use lime as a substitute.",
     (3, 3), (1, 0), ["shrimp"], 2, True, 1.0, 1.0),
]


@pytest.fixture(scope="module")
def scored(spark):
    df = spark.createDataFrame([c[:3] for c in CASES], "case string, ref string, gen string")
    rows = df.select("case", scoring.recipe_metrics("ref", "gen").alias("m")).collect()
    return {r.case: r.m for r in rows}


@pytest.mark.parametrize("case", CASES, ids=[c[0] for c in CASES])
def test_recipe_metrics(scored, case):
    name, _, _, used, temps, allergens, swaps, warned, allergy, composite = case
    m = scored[name]
    cov, temp, alg = m.ingredient_coverage, m.temperature_validation, m.allergen_handling
    assert (cov.used_count, cov.total_count) == used
    assert (temp.valid_count, temp.invalid_count) == temps
    assert temp.has_temperatures == (sum(temps) > 0)
    assert alg.allergens_mentioned == allergens
    assert (alg.substitution_count, alg.has_safety_warnings) == (swaps, warned)
    assert alg.score == pytest.approx(allergy)
    assert m.composite_score == pytest.approx(composite)


def test_missing_ingredients(scored):
    assert scored["some missing"].ingredient_coverage.missing_ingredients == ["raisins", "walnut"]


def one(spark, *cols):
    return spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).first()


def test_ingredient_lists(spark):
    quoted = "Ingredients: ['Flour', 'brown sugar']\n\nInstructions: mix"
    lines = "ingredients:\n flour\n\n\"salt\",\n  sugar \nSteps: mix"
    row = one(spark, scoring.extract_ingredients(F.lit(quoted)),
              scoring.extract_ingredients(F.lit(lines)),
              scoring.extract_ingredients(F.lit("nothing here")))
    assert row.c0 == ["flour", "brown sugar"]
    assert row.c1 == ["flour", "salt", "sugar"]
    assert row.c2 == []


def test_temperature_traps(spark):
    twice = scoring.extract_temperatures(F.lit("bake at 350 degrees fahrenheit"))
    cups = scoring.extract_temperatures(F.lit("2 c flour"))
    row = one(spark, twice, cups)
    assert [tuple(t) for t in row.c0] == [(350.0, "F"), (350.0, "F")]
    assert [tuple(t) for t in row.c1] == [(2.0, "C")]


def test_substitution_traps(spark):
    row = one(spark, scoring.substitution_count(F.lit("Fold in alternately, although")),
              scoring.substitution_count(F.lit("if you are\nallergic")),
              scoring.substitution_count(F.lit("if you are allergic")))
    assert (row.c0, row.c1, row.c2) == (2, 0, 1)


def test_other_line_ends_and_blanks(spark):
    row = one(spark, scoring.substitution_count(F.lit("if you\rare allergic")), scoring.safety_warning(F.lit("gluten\rfree")),
              prompts.dish_name(F.lit("recipe for A\rB.")), prompts.dish_name(F.lit("recipe for\u00a0pie.")),
              scoring.extract_temperatures(F.lit("bake at 350\u00a0degrees\u00a0F")),
              scoring.extract_ingredients(F.lit("Ingredients:\u00a0salt,\u00a0oil")), scoring.safety_warning(F.lit("gluten\nfree")))
    assert (row.c0, row.c1, row.c2, row.c3) == (1, True, "A\rB", "pie")
    assert [tuple(t) for t in row.c4][0] == (350.0, "F") and row.c5 == ["salt", "oil"] and row.c6 is False


def treebank(text):
    """The published word rules, written once more for plain text."""
    t = " ".join(text.lower().split())
    t = re.sub(r'(^|[ (\[{<])"', r"\1 `` ", t)
    t = re.sub(r"([:,])(?=\D)|([:,])$", r" \1\2 ", t)
    t = t.replace("...", " ... ")
    t = re.sub(r"([;@#$%&?!()\[\]{}<>])", r" \1 ", t)
    t = re.sub(r"([^. ])\.(?=[\])}>\"']*(?: |$))", r"\1 . ", t)
    t = t.replace("--", " -- ").replace('"', " '' ")
    t = re.sub(r"([^' ])('s|'m|'d|'ll|'re|'ve|n't|')(?= |$)", r"\1 \2 ", t)
    return t.split()


@pytest.mark.parametrize("text, tokens", [
    ("Add 0.6 liter, then 1,000 g.", ["add", "0.6", "liter", ",", "then", "1,000", "g", "."]),
    ("Cut 1/2-inch slices. Don't stir...", ["cut", "1/2-inch", "slices", ".", "do", "n't", "stir", "..."]),
    ('He said "stop" (twice)!', ["he", "said", "``", "stop", "''", "(", "twice", ")", "!"]),
    ("the cook's pan; it's 5%", ["the", "cook", "'s", "pan", ";", "it", "'s", "5", "%"]),
    ("salt--pepper: we cannot\u00a0wait", ["salt", "--", "pepper", ":", "we", "can", "not", "wait"]),
    ("", []),
])
def test_word_rules(spark, text, tokens):
    assert one(spark, scoring.bleu_tokens(F.lit(text))).c0 == tokens


def test_bleu_by_hand(spark):
    # 5 of 6 words, 4 of 5 pairs, 3 of 4 triples, 2 of 3 quadruples; equal lengths
    row = one(spark, scoring.bleu(F.lit("add 0.6 liter of milk now"), F.lit("add 0.6 liter of milk today")))
    assert row.c0 == pytest.approx((5 / 6 * 4 / 5 * 3 / 4 * 2 / 3) ** 0.25)


def brute_bleu(ref, gen):
    r, g = treebank(ref), treebank(gen)
    if not g:
        return 0.0
    logs = []
    for n in range(1, 5):
        rc = Counter(zip(*[r[i:] for i in range(n)]))
        gc = Counter(zip(*[g[i:] for i in range(n)]))
        hits = sum(min(c, rc[k]) for k, c in gc.items())
        if n == 1 and hits == 0:
            return 0.0
        logs.append(math.log((hits or 0.1) / max(1, len(g) - n + 1)) / 4)
    return (1.0 if len(g) > len(r) else math.exp(1 - len(r) / len(g))) * math.exp(sum(logs))


def brute_ratio(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return 200.0 * row[-1] / (len(a) + len(b)) if a or b else 100.0


def text_pairs():
    rng = random.Random(3)
    words = "mix the flour and milk, then bake. stir well égal été don't 0.5 1/2-inch (cup) ...".split()
    pairs = [("", ""), ("a", ""), ("", "a"), ("a b c d", "a b c d"), ("a", "a"), ("x y", "p q")]
    for _ in range(60):
        pairs.append((" ".join(rng.choices(words, k=rng.randint(1, 40))),
                      " ".join(rng.choices(words, k=rng.randint(1, 40)))))
    return pairs


def test_bleu_and_similarity_match_brute_force(spark):
    df = spark.createDataFrame(text_pairs(), "ref string, gen string")
    rows = df.select("ref", "gen", scoring.bleu("ref", "gen").alias("b"),
                     scoring.similarity("ref", "gen").alias("s")).collect()
    for r in rows:
        assert r.b == pytest.approx(brute_bleu(r.ref, r.gen), abs=1e-12)
        assert r.s == pytest.approx(brute_ratio(r.ref.lower(), r.gen.lower()))
        assert 0 <= r.b <= 1 + 1e-12 and 0 <= r.s <= 100


def test_identical_texts(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    row = docs.filter(F.size(scoring.bleu_tokens("text")) >= 4).select(
        F.min(scoring.bleu("text", "text")).alias("b"),
        F.min(scoring.similarity("text", "text")).alias("s")).first()
    assert row.b == pytest.approx(1.0) and row.s == 100.0


def test_similarity_is_no_edit_distance(spark):
    row = one(spark, scoring.similarity(F.lit("minute"), F.lit("Minutes")))
    assert row.c0 == pytest.approx(92.3076923)


def test_structure(spark):
    good = "Ingredients:\nflour\n\nInstructions:\nmix"
    row = one(spark, scoring.format_compliance(F.lit(good)),
              scoring.format_compliance(F.lit("Ingredients:\n\nInstructions:\nmix")),
              scoring.format_compliance(F.lit("Ingredients:x\n\nInstructions:")),
              scoring.structure_exact(F.lit("ingredients Instructions")),
              scoring.structure_loose(F.lit("ingredients Instructions")),
              scoring.structure_vote(F.lit("ingredients only")))
    for text, got in ((good, row.c0), ("Ingredients:\n\nInstructions:\nmix", row.c1),
                      ("Ingredients:x\n\nInstructions:", row.c2)):
        assert got == bool(re.fullmatch(r"Ingredients:[\s\S]+?\n\nInstructions:[\s\S]+", text))
    assert (row.c3, row.c4, row.c5) == (False, True, False)


def test_prompts_and_verdicts(spark):
    row = one(spark,
              prompts.dish_name(F.lit("Create a detailed recipe for melon. Now")),
              prompts.dish_name(F.lit("nothing")),
              prompts.adapter_label(F.lit("Model-1 (prompt_tuning)")),
              prompts.adapter_label(F.lit("Model-1")),
              prompts.parse_verdict(F.lit('```json\n{"score": 7, "reasoning": "fine"}\n```')),
              prompts.parse_verdict(F.lit('{"score": 7, "reasoning": ')),
              prompts.parse_verdict(F.lit('{"reasoning": "no score"}')),
              prompts.ingredients_prompt(F.lit("pie"), F.lit(" ")),
              prompts.parse_verdict(F.lit('{"score": 7.5, "reasoning": "a"}')),
              prompts.parse_verdict(F.lit('{"score": "8", "reasoning": "b"}')),
              prompts.parse_verdict(F.lit('{"score": "high", "reasoning": "c"}')))
    assert (tuple(row.c8), tuple(row.c9), tuple(row.c10)) == ((7.5, "a"), (8.0, "b"), (0.0, "c"))
    assert (row.c0, row.c1) == ("melon", "Unknown Dish")
    assert (row.c2, row.c3) == ("Prompt_Tuning Fine-Tuned", "Unknown Fine-Tuned")
    assert tuple(row.c4) == (7, "fine")
    assert row.c5.score == 0 and row.c5.reasoning.startswith("Judge Error")
    assert tuple(row.c6) == (0, "no score")
    assert row.c7 == "Create a detailed recipe for pie."


def test_fewer_passes_give_the_words_of_the_rules(spark):
    draw = random.Random(1)
    parts = ["a", "b1", "can", "not", "cannot", "gimme", "gonna", "got", "ta", "gotta", " ", "  ", " ", ".", "...", "!", "?", "'", "''",
             "'s", "n't", "'ll", '"', "(", ")", "[", "]", "{", "}", "<", ">", "-", "--", ",", ":", ";", "&", "%", "1", "/", "é", "`"]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 14))) for _ in range(30_000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rest = F.lower(single_spaced(F.col("t")))
    for pattern, replacement in scoring.TREEBANK_RULES:
        rest = F.regexp_replace(rest, pattern, replacement)
    ruled = F.filter(F.split(rest, " +"), lambda w: w != "")
    assert df.filter(ruled != scoring.bleu_tokens("t")).take(1) == []


def test_whole_words_are_found_as_a_pattern_finds_them(spark):
    draw = random.Random(2)
    parts = ["a", "b", "ab", "1", "_", " ", " ", "-", ".", "é", "ß", "日", "(", "\\", "$"]
    rows = [tuple("".join(draw.choice(parts) for _ in range(draw.randint(0, n))) for n in (4, 12)) for _ in range(20_000)]
    rows += [("a a", "xa a a"), ("half-and-half", "with half-and-half."), ("", ""), ("", "a"), ("-", "a-b"), ("-", "a - b")]
    df = spark.createDataFrame(rows, "name string, text string")
    quoted = F.regexp_replace("name", r"([^\p{L}\p{N}_ ])", r"\\$1")
    whole = F.rlike("text", F.concat(F.lit(r"\b"), quoted, F.lit(r"\b")))
    long = F.filter(split_words(F.col("name")), lambda w: F.length(w) > 2)
    told = F.exists(long, lambda w: F.rlike("text", F.concat(F.lit(r"\b"), F.regexp_replace(w, r"([^\p{L}\p{N}_ ])", r"\\$1"), F.lit(r"\b"))))
    used = scoring.ingredient_is_used(F.col("name"), scoring._with_edges(F.col("text")))
    assert df.filter((whole | told) != used).take(1) == []
    assert df.filter(used).count() > 100


def test_no_pattern_is_built_from_a_row(spark):
    df = spark.createDataFrame([("['salt']", "some salt")], "a string, b string")
    optimized = df.select(scoring.recipe_metrics("a", "b"))._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search(r"RLIKE\(?[^,]*concat", optimized, re.I)


def test_texts_without_quotes_skip_the_quote_rules(spark):
    draw = random.Random(4)
    parts = ["a", "b1", "cannot", "gimme", "lemme", "wanna", "gotta", " ", "  ", " ", ".", "...", "!", "?", "(", ")", "[", "<", "--", ",", ":", ";",
             "&", "1", "/", "é", "`", "\n"]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 14))) for _ in range(10_000)]
    df = spark.createDataFrame([(t,) for t in [*texts, None, ""]], "t string")
    rest = F.lower(single_spaced(F.col("t")))
    for pattern, replacement in scoring.TREEBANK_RULES:
        rest = F.regexp_replace(rest, pattern, replacement)
    ruled = F.filter(F.split(rest, " +"), lambda w: w != "")
    assert df.filter(~ruled.eqNullSafe(scoring.bleu_tokens("t"))).take(1) == []
    assert len(scoring._PASSES) - len(scoring._UNQUOTED_PASSES) == 4


def test_long_texts_are_searched_once_a_pattern(spark):
    text = F.col("t")
    assert str(scoring.extract_temperatures(text)).count("regexp_extract_all") == len(lookups.TEMPERATURE_MENTIONS)
    assert str(scoring.ingredient_is_used(F.col("i"), text)).count(r"\b") == 2
    assert str(scoring.substitution_count(text)).count("contains(") == len(lookups.SUBSTITUTION_PATTERNS)


def test_mentions_and_substitutions_of_odd_texts(spark):
    texts = {
        "5.C and 12.5 degrees F, 20c": ([(5.0, "C"), (12.5, "F"), (20.0, "C")], 0),
        "350 fahrenheit 180cups": ([(350.0, "F")], 0),
        "Alternatively, IF YOU are allergic, you can use a substitute instead of it": ([], 5),
        "salt, or used": ([], 0),
        "": ([], 0),
    }
    df = spark.createDataFrame([(t,) for t in [*texts, None]], "t string")
    rows = df.select(
        "t", scoring.extract_temperatures("t").alias("found"), scoring.substitution_count("t").alias("n")).collect()
    got = {r.t: (None if r.found is None else sorted((m.value, m.unit) for m in r.found), r.n) for r in rows}
    assert got == {t: (sorted(m), n) for t, (m, n) in texts.items()} | {None: (None, None)}

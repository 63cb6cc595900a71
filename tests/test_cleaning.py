"""Parsing, cleaning, titles."""

import ast

import pytest
from pyspark.sql import functions as F

from mirepoix.functions import text
from mirepoix.operators import cleaning, evaluation, titles

RAW = ("name string, id long, minutes int, contributor_id long, submitted string, tags string, "
       "nutrition string, n_steps int, steps string, description string, ingredients string, n_ingredients int")


def raw(spark, *rows):
    base = dict(name="Pie", id=1, minutes=20, contributor_id=9, submitted="2001-01-01",
                tags="['Easy', '30-minutes-or-less']", nutrition="[10.0, 1, 2, 3, 4, 5, 6]", n_steps=1,
                steps="['Bake at 350F']", description="Nice", ingredients="['Flour']", n_ingredients=1)
    return spark.createDataFrame([tuple({**base, **r}.values()) for r in rows], RAW)


LITERALS = ["['a', 'b']", "[]", "['it\\'s', \"don't\"]", '["x, y", \'z\']', "['é', 'a\"b']", "['a\\\\b']"]


def test_list_literals(spark):
    df = spark.createDataFrame([(v,) for v in LITERALS], "v string")
    got = [r.x for r in df.select(text.parse_string_list("v").alias("x")).collect()]
    assert got == [ast.literal_eval(v) for v in LITERALS]


def test_list_text_reads_back(spark):
    lists = [ast.literal_eval(v) for v in LITERALS]
    df = spark.createDataFrame([(v,) for v in lists], "v array<string>")
    got = [r.x for r in df.select(text.list_text("v").alias("x")).collect()]
    assert got == [str(v) for v in lists]


def test_blank_test_ends_at_the_first_sign(spark):
    values = [None, "", " ", "\t\r\n", "\x1c\x1f\x85\u00a0\u2003\u2028\u3000", "  \n\u00a0x", "x  ", "\u200b", "\x00", "\U0001f370"]
    df = spark.createDataFrame([(v,) for v in values], "v string").select("v", text.is_non_blank("v").alias("x"))
    assert [r.x for r in df.collect()] == [None if v is None else v.strip() != "" for v in values]
    # no copy of the text is made for it
    assert "regexp_replace" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_malformed_lists(spark):
    df = raw(spark, {}, {"tags": "['a', None"}, {"tags": None})
    counts = cleaning.count_malformed(df).first()
    assert (counts.tags, counts.steps) == (1, 0)
    with pytest.raises(Exception):
        cleaning.parse_lists(df, strict=True).collect()


def test_clean_recipes(spark):
    df = raw(spark, {}, {"id": 2, "minutes": 300}, {"id": 3, "name": None}, {"id": 4, "description": None},
             {"id": 5, "steps": "[' ']"}, {"id": 6, "minutes": None}, {"id": 7, "tags": "[]"})
    rows = {r.id: r for r in cleaning.clean_recipes(df, index=True).collect()}
    assert set(rows) == {1, 7}
    one = rows[1]
    assert one.steps_string_standardize == "bake at 177.0 celsius"
    assert (one.tags_text, rows[7].tags_text) == ("['easy']", "[]")
    assert (one.name, one.description, one.ingredients_text) == ("Pie", "nice", "flour")
    assert (one.calories, one.carbohydrates) == (10.0, 6.0)
    # positions count the recipe with blank steps, which goes afterwards
    assert (one["index"], rows[7]["index"]) == (0, 2)
    assert not {"tags", "steps", "ingredients", "nutrition", "submitted"} & set(one.asDict())


def test_nutrition_needs_a_list_everywhere(spark):
    parsed = cleaning.parse_lists(raw(spark, {}, {"id": 2, "nutrition": "oops"}))
    assert "nutrition" in cleaning.expand_nutrition(parsed).columns
    assert "calories" in cleaning.expand_nutrition(parsed, check_all=False).columns
    assert "calories" in cleaning.expand_nutrition(parsed.filter("id = 1")).columns


def test_title(spark):
    df = spark.createDataFrame([(1, "The BEST Grandma's Berry-Pies, 2nd try!"), (2, None)], "id long, name string")
    rows = titles.clean_title(df, "name", ["best", "grandma"]).collect()
    assert [(r.id, r.cleaned_name) for r in rows] == [(1, "berrypy nd try")]


def test_lemmas_with_duplicates_and_null_tokens(spark):
    df = spark.createDataFrame([(1, ["geese", None, "eats"]), (2, []), (3, None)], "id long, t array<string>")
    lemmas = spark.createDataFrame([("geese", "goose"), ("geese", "bird"), (None, "none")], "token string, lemma string")
    got = {r.id: r.t for r in titles.title_lemmas(df, "t", lemmas).collect()}
    assert got == {1: ["bird", None, "eat"], 2: [], 3: None}


def test_list_literals_without_loss(spark):
    lists = [["don't"], ["a\xa0b", "tab\there"], ["smile \U0001f600"], ["back\\x41slash"], ["None, None"], ['say "hi" it\'s'], ["line\nfeed\x07"], []]
    rows = [(i, repr(x)) for i, x in enumerate(lists)] + [(100, "[None, 'a']"), (101, "['raw\ttab']"), (102, "['open")]
    df = spark.createDataFrame(rows, "id long, t string").withColumn("p", text.parse_string_list("t"))
    got = {r.id: r.p for r in df.collect()}
    assert [got[i] for i in range(len(lists))] == lists
    assert (got[100], got[101], got[102]) == ([None, "a"], ["raw\ttab"], None)
    written = {r.id: r.w for r in df.select("id", text.list_text("p").alias("w")).collect()}
    assert all(eval(written[i]) == x for i, x in enumerate(lists)) and written[100] == "[None, 'a']"
    assert written[6] == repr(lists[6])


def test_strict_cleaning_raises(spark):
    row = ("soup", 10, "nice", "['a']", "['open", "['x']", "[1,2,3,4,5,6,7]", 1)
    df = spark.createDataFrame([row], "name string, minutes int, description string, tags string, steps string, ingredients string, nutrition string, id int")
    assert cleaning.clean_recipes(df).count() == 0 and cleaning.count_malformed(df).first().steps == 1
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        cleaning.clean_recipes(df, strict=True).collect()


def test_titles_keep_words_apart(spark):
    row = spark.range(1).select(text.title_tokens(F.lit("Chicken\u00a0Soup!")).alias("t")).first()
    assert row.t == ["chicken", "soup"]



def test_beautiful_is_the_callers_choice(spark):
    kept = spark.range(1).select(text.drop_stop_words(F.array(F.lit("beautiful"), F.lit("l")), ["l"]).alias("t"))
    assert kept.first().t == ["beautiful"]


def test_number_unit_diff(spark):
    df = spark.createDataFrame([("add 2 cups and 5 g", "add 0.48 liter and 5 g")],
                               "steps_strings string, steps_string_standardize string")
    row = cleaning.number_unit_diff(df).first()
    assert [tuple(p) for p in row.only_in_standardize] == [("0.48", "liter")]
    assert [tuple(p) for p in row.only_in_not_standardize] == [("2", "cup")]


def test_verdict_priority(spark):
    ok, bad = '{{"score": {}, "reasoning": "r{}"}}', "{broken"
    rows = [("m", 1, "b", ok.format(4, 1), "t"), ("m", 1, "a", bad, "t"), ("m", 1, "c", ok.format(9, 2), "t"),
            ("m", 2, "a", bad, "t"), ("m", 3, "a", ok.format(7, 3), ""), ("m", 4, "z", ok.format(5, 4), "t")]
    df = spark.createDataFrame(rows, "model_name string, id long, judge_model string, reply string, generated string")
    got = {r.id: (r.score, r.judge_model) for r in
           evaluation.resolve_verdicts(df, ["a", "b", "c"], generated="generated").collect()}
    assert got == {1: (4, "b"), 2: (0, "None"), 3: (0, "None"), 4: (0, "None")}


def test_title_tokens_with_every_kind_of_white_space(spark):
    blanks = "\t\n\x0b\x0c\r \x1c\x1d\x1e\x1f\x85\u00a0\u1680\u2000\u200a\u2028\u2029\u202f\u205f\u3000"
    texts = [*[f"Don't{b}STOP{b}{b}\u00e9t\u00e9 \U0001f600x" for b in blanks], "a\u200bb", "", " ", None]
    found = spark.createDataFrame([(t,) for t in texts], "t string").select(
        text.strip_title("t").alias("s"), text.title_tokens("t").alias("w")).collect()
    assert [r.s for r in found] == [*[f"dont{b}stop{b}{b}t x" for b in blanks], "ab", "", " ", None]
    assert [r.w for r in found] == [*[["dont", "stop", "t", "x"]] * len(blanks), ["ab"], [], [], None]

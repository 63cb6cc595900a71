"""How five filters interact: what each removes, alone and after others, over all orders of them.

Failures are found once per document, not once per order. The conditions on a text alone are a bit
each; that a text was seen before (E) is an existential self-join: a left-semi join on text hash,
exact text and a smaller doc_id. The ids of E are united with the ids of the other failures, every
document's bits are put together, and documents are counted by bit combination - at most 32 per
part and pair of labels. All orders and steps are then read from these few counts.

A group of copies, however large, is never gathered: only hashes that occur twice are joined, the
right side of the join holds the smallest doc_id of each text once, and a text's copies are dealt
over as many salts as their number needs.

Defined cases: a null text is the empty one, a null lang the part of the empty string. A row without
doc_id has no smaller id and is none itself. Repeated rows of one doc_id are not copies of each
other and count once each. A document's label is 1 if any of its label rows says so; unlabelled
documents, and rows without doc_id, are neither good nor toxic. An empty table gives no rows.
Further columns are not read.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mirepoix.llm.common import stored, texts

FILTERS = "ABCDE"
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 100, 80, 10
SIGNS = "[#$%&*|]"
# Copies of one text that a salt takes.
SALT_ROWS = 256


def text_failures(text: Column) -> Column:
    """The bits of the conditions that need the text alone: A 1, B 2, C 4, D 8."""
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")

    def bits(w: Column) -> Column:
        capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
        tests = [
            F.size(w) < LEAST_WORDS,
            100 * F.size(F.array_distinct(w)) < LEAST_DISTINCT * F.size(w),
            100 * capitals > MOST_CAPITALS * F.length(text),
            text.rlike(SIGNS),
        ]
        return sum((F.when(t, F.lit(1 << i)).otherwise(F.lit(0)) for i, t in enumerate(tests)), F.lit(0))

    return F.get(F.transform(F.array(words), bits), 0)


def described(docs: DataFrame) -> DataFrame:
    """Stored rows (doc_id, part, h, bits), one per document; ``h`` is the hash of its text."""
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part")
    rows = docs.select("doc_id", lang, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return stored(rows.select("doc_id", "part", F.xxhash64("text").alias("h"), text_failures(F.col("text")).alias("bits")), "described")


def copies(docs: DataFrame, facts: DataFrame) -> DataFrame:
    """(doc_id, h) of the documents whose text a smaller doc_id has too."""
    often = facts.filter("doc_id IS NOT NULL").groupBy("h").agg(F.count("*").alias("c"), F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
    often = stored(often.filter("lo < hi").select("h", F.ceil(F.col("c") / SALT_ROWS).cast("int").alias("salts")), "often")
    rows = texts(docs).filter("doc_id IS NOT NULL").withColumn("h", F.xxhash64("text")).join(often, "h")
    left = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.col("salts")).cast("int"))
    first = rows.groupBy("h", "text", "salts").agg(F.min("doc_id").alias("least"))
    first = first.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    a, b = left.alias("a"), first.alias("b")
    same = (F.col("a.h") == F.col("b.h")) & (F.col("a.salt") == F.col("b.salt")) & (F.col("a.text") == F.col("b.text"))
    return a.join(b, same & (F.col("b.least") < F.col("a.doc_id")), "left_semi").select("doc_id", "h")


def combinations(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Stored rows (part, mask, good, toxic, n): documents by the set of filters that they fail."""
    facts = described(docs)
    seen = copies(docs, facts).distinct()
    rows = facts.groupBy("doc_id", "h", "part", "bits").agg(F.count("*").alias("n"))
    parts = ["doc_id", "h", F.lit(0).alias("bits"), F.lit(1 << FILTERS.index("E")).alias("seen")]
    marks = rows.select("doc_id", "h", "bits", F.lit(0).alias("seen"), "part", "n").unionByName(
        seen.select(*parts, F.lit(None).cast("string").alias("part"), F.lit(0).cast("long").alias("n")))
    # a document's rows share its id and hash; rows of several parts stay apart
    whole = marks.groupBy("doc_id", "h").agg(
        F.bit_or("seen").alias("seen"),
        F.collect_set(F.when(F.col("n") > 0, F.struct("part", "bits", "n"))).alias("rows"))
    whole = whole.select("doc_id", "seen", F.inline("rows"))
    known = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    marked = whole.join(known, "doc_id", "left").select(
        "part", F.col("bits").bitwiseOR(F.col("seen")).alias("mask"), "n",
        *(F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")))
    return stored(marked.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n")), "combinations")


def _steps() -> Column:
    """For each filter and each set of filters before it, the orders (and the step) in which it comes right after them."""
    places: dict[tuple[int, int], list[str]] = {}
    for order in permutations(FILTERS):
        before = 0
        for step, name in enumerate(order, 1):
            bit = 1 << FILTERS.index(name)
            places.setdefault((bit, before), []).append(f"named_struct('filter_order', '{''.join(order)}', 'step', {step})")
            before |= bit
    cells = []
    for (bit, before), where in places.items():
        held = before.bit_count()
        ways = factorial(held) * factorial(len(FILTERS) - 1 - held)
        cells.append(f"named_struct('own', {bit}, 'before', {before}, 'ways', {ways}L, 'places', array({', '.join(where)}))")
    return F.expr(f"array({', '.join(cells)})")


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, with the counts at that step."""
    rows = combinations(docs, labels).select("*", F.inline(_steps()))
    fails = F.col("mask").bitwiseAND(F.col("own")) != 0
    gone = F.col("mask").bitwiseAND(F.col("before")) != 0

    def count(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(F.lit(0).cast("long")))

    counts = rows.groupBy("part", "own", "before").agg(
        F.any_value("ways").alias("ways"), F.any_value("places").alias("places"),
        count(~fails & ~gone).alias("kept"), count(fails & ~gone).alias("removed"), count(fails & gone).alias("redundant"),
        count(F.col("mask") == F.col("own")).alias("unique_fails"),
        count(fails & ~gone & F.col("good")).alias("good_lost"), count(fails & ~gone & F.col("toxic")).alias("toxic_lost"))
    # at most 16 rows per part and filter
    every = F.sum(F.col("removed") * F.col("ways")).over(Window.partitionBy("part", "own"))
    shares = counts.withColumn("shapley", every).withColumn("place", F.explode("places"))
    return shares.select(
        "part", "place.filter_order", "place.step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")

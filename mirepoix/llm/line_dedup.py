"""Line dedup by deletion neighbourhoods; DataFrame functions only.

A line goes if an earlier one (by doc_id, then line number) is equal to it or, for lines of at
least ``near_chars`` characters, within one edit. Equal lines are found by hash. For the rest, one
edit leaves the first or the last half of a line as it is, so only lines that share a half with
another distinct line can have a partner: these emit themselves and all their one-deletion variants
as hashed keys, equal keys are joined, and pairs are verified by edit distance. Whether the earlier
line itself stays does not matter, so the result does not depend on any order of work.

Defined cases: a null text stays null and an empty one empty; blank lines are never removed and
never compared. A document whose lines other than blank ones are all removed goes as a whole.
Lines are parted by line feeds only. Rows with a null doc_id come last in the order; rows that share
a doc_id are ordered by a hash of their text, and equal rows count as one and are treated alike.
All columns of the documents are kept, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mirepoix.llm.common import bounded_broadcast, stored

NEAR_CHARS = 20


def _lines(docs: DataFrame) -> DataFrame:
    """(doc_id, th, at, line, h1, h2) of every line that is not blank."""
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id"), F.xxhash64(text).alias("th"), F.posexplode(F.split(text, "\n")).alias("at", "line"))
    rows = rows.filter(F.trim("line") != "")
    return rows.withColumns({"h1": F.xxhash64("line"), "h2": F.xxhash64(F.lit(7), "line")})


def _place() -> Column:
    return F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "th", "at")


def _half_keys(near_chars: int) -> Column:
    """Keys of both halves of ``line``, cut as for the shorter line of a possible pair."""
    n = F.length("line")
    cuts = (F.floor(n / 2).cast("int"), F.floor((n - 1) / 2).cast("int"))
    keys = [F.xxhash64(F.lit(side), cut, half) for cut in cuts
            for side, half in (("head", F.left(F.col("line"), cut)), ("tail", F.right(F.col("line"), cut)))]
    return F.when(n >= near_chars, F.array_distinct(F.array(*keys))).otherwise(F.array().cast("array<bigint>"))


def _variants() -> Column:
    """Hashes of ``line`` and of the line without each one of its characters."""
    def without(i: Column) -> Column:
        return F.xxhash64(F.concat(F.substr(F.col("line"), F.lit(1), i - 1), F.substr(F.col("line"), i + 1)))

    return F.array_distinct(F.concat(F.array("h1"), F.transform(F.sequence(F.lit(1), F.length("line")), without)))


def _near(lines: DataFrame, firsts: DataFrame, near_chars: int) -> DataFrame:
    """(h1, h2) of distinct lines with an earlier line within one edit."""
    halves = lines.select("h1", "h2", "line", F.explode(_half_keys(near_chars)).alias("half"))
    shared = halves.groupBy("half").agg(F.min("h1").alias("lo"), F.max("h1").alias("hi")).filter("lo <> hi").select("half")
    shared = bounded_broadcast(stored(shared, "halves"))
    some = halves.join(shared, "half", "left_semi").groupBy("h1", "h2").agg(F.any_value("line").alias("line"))
    some = stored(bounded_broadcast(stored(some, "some")).join(firsts.select("h1", "h2", "place"), ["h1", "h2"]), "candidates")
    keys = some.select("h1", "h2", F.explode(_variants()).alias("variant"))
    met = keys.groupBy("variant").agg(F.min("h1").alias("lo"), F.max("h1").alias("hi")).filter("lo <> hi").select("variant")
    keys = stored(keys.join(bounded_broadcast(stored(met, "variants")), "variant"), "keys")
    known = bounded_broadcast(some)
    placed = keys.join(known.select("h1", "h2", "place"), ["h1", "h2"])
    earliest = placed.groupBy("variant").agg(F.min(F.struct("place", "h1", "h2")).alias("e"))

    def verified(pairs: DataFrame) -> DataFrame:
        """Of pairs (h1, h2, g1, g2) the later lines (h1, h2) that are within one edit."""
        left = known.select("h1", "h2", F.col("line").alias("x"))
        right = known.select(F.col("h1").alias("g1"), F.col("h2").alias("g2"), F.col("line").alias("y"))
        rows = pairs.distinct().join(left, ["h1", "h2"]).join(right, ["g1", "g2"])
        close = F.levenshtein("x", "y", 1)
        return rows.filter(close.between(0, 1)).select("h1", "h2").distinct()

    first = placed.join(earliest, "variant").filter("place > e.place").select("h1", "h2", F.col("e.h1").alias("g1"), F.col("e.h2").alias("g2"))
    gone = stored(verified(first), "near")
    # a key's earliest line may be two edits off where another is one: compare what is left with all earlier ones
    left = placed.join(earliest, "variant").filter("place > e.place").join(bounded_broadcast(gone), ["h1", "h2"], "left_anti")
    other = placed.select("variant", F.col("place").alias("before"), F.col("h1").alias("g1"), F.col("h2").alias("g2"))
    rest = left.join(other, "variant").filter("before < place AND before <> e.place").select("h1", "h2", "g1", "g2")
    return gone.union(verified(rest)).distinct()


def removed_lines(docs: DataFrame, near_chars: int = NEAR_CHARS) -> DataFrame:
    """(doc_id, th, exact, near): per row of documents with lines to remove, their numbers by reason."""
    lines = _lines(docs)
    slim = stored(lines.select("doc_id", "th", "at", "h1", "h2"), "lines")
    firsts = slim.groupBy("h1", "h2").agg(F.min(_place()).alias("place"), F.max(_place()).alias("final"))
    firsts = stored(firsts.select("h1", "h2", "place", (F.col("place") != F.col("final")).alias("again")), "firsts")
    near = _near(lines, firsts, near_chars).withColumn("near", F.lit(True))
    listed = firsts.filter("again").join(near, ["h1", "h2"], "full_outer").select("h1", "h2", "place", F.coalesce("near", F.lit(False)).alias("near"))
    listed = bounded_broadcast(stored(listed, "listed"))
    hit = slim.join(listed, ["h1", "h2"]).filter(F.col("near") | (F.col("place") != _place())).dropDuplicates(["doc_id", "th", "at"])
    # a near line's own repeats count as near
    return hit.groupBy("doc_id", "th").agg(
        F.collect_list(F.when(~F.col("near"), F.col("at"))).alias("exact"), F.collect_list(F.when(F.col("near"), F.col("at"))).alias("near"))


def _marked(docs: DataFrame, near_chars: int) -> DataFrame:
    """All columns of docs in ``row``, with the numbers of lines to remove and the kept text."""
    removed = bounded_broadcast(stored(removed_lines(docs, near_chars), "removed"))
    removed = removed.select(F.col("doc_id").alias("r_id"), F.col("th").alias("r_th"), "exact", "near")
    rows = docs.select(F.struct("*").alias("row"), F.xxhash64(F.col("text").cast("string")).alias("th"))
    rows = rows.join(removed, F.col("row.doc_id").eqNullSafe(F.col("r_id")) & (F.col("th") == F.col("r_th")), "left")
    gone = F.concat("exact", "near")
    lines = F.split("row.text", "\n")
    kept = F.array_join(F.filter(lines, lambda x, i: ~F.array_contains(gone, i)), "\n")
    empty = ~F.exists(F.filter(lines, lambda x, i: ~F.array_contains(gone, i)), lambda x: F.trim(x) != "")
    touched = F.col("r_th").isNotNull()
    return rows.select("row", "exact", "near", lines.alias("lines"),
                       F.when(touched, kept).otherwise(F.col("row.text")).alias("kept"), (touched & empty).alias("drop"))


def dedup(docs: DataFrame, near_chars: int = NEAR_CHARS) -> DataFrame:
    """The documents without removed lines; those left without any line go. ``n_chars``, if there, is counted anew."""
    fields = [F.col("kept").alias("text") if c == "text" else
              F.length("kept").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col("row").getField(c).alias(c) for c in docs.columns]
    return _marked(docs, near_chars).filter(~F.col("drop")).select(*fields)


def report(docs: DataFrame, near_chars: int = NEAR_CHARS) -> DataFrame:
    """Per document: doc_id, n_lines, n_exact, n_near, dropped, kept_md5."""
    def count(c: str) -> Column:
        return F.coalesce(F.size(c), F.lit(0)).cast("long")

    return _marked(docs, near_chars).select(
        F.col("row.doc_id").alias("doc_id"), count("lines").alias("n_lines"), count("exact").alias("n_exact"),
        count("near").alias("n_near"), F.col("drop").alias("dropped"), F.md5(F.encode(F.coalesce("kept", F.lit("")), "UTF-8")).alias("kept_md5"))

"""Phrases whose words keep together, mined by sorting suffix pointers.

Every word of a piece of text opens a suffix, cut after ``most`` words. Suffixes are dealt out by
their leading words over all tasks, equal ones of a task counted as one pointer with a weight, so
that a partition of a leading word pair holds all its suffixes. There the pointers are sorted by a
multikey three-way quicksort: the word at the current depth splits a partition into less, equal and
greater; the equal one goes a word deeper. The weight of an equal partition is the count of the
phrase it stands for. A partition below the least count is abandoned, first of all a whole leading
pair; all open partitions of a block are split at once in numpy.

Scores, containment and ranks are joins and windows over the counted phrases, in exact arithmetic.

Memory: a task holds a block of pointers; a leading pair larger than a block is combined to its
distinct suffixes as it comes. A frequent pair arrives combined from each task.

Defined cases: a null text has no words, a null lang is ``und``. Empty pieces and runs of blanks hold
no word. Repeated rows count each time. A table without candidates gives no rows. Rows of any
doc_id, null included, count; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mirepoix.llm.common import stored
from mirepoix.llm.wordcodes import following, run_keys, word_codes

BREAKS = b".,;:!?\n\x0b\x0c\r"
BLANKS = b" \t"
# Bytes of one language's text that are combined at once, and pointers that are sorted at once.
COMBINE_BYTES = 4 << 20
BLOCK_ROWS = 1 << 18
_OUT_ROWS = 1 << 14
_COUNTED = "lang string, phrase string, n bigint"
_INSIDE = np.ones(256, bool)
_INSIDE[list(BREAKS + BLANKS)] = False
_BREAK = np.zeros(256, bool)
_BREAK[list(BREAKS)] = True


def _rows(lang: pa.Array | str, phrase: pa.Array, n: np.ndarray) -> Iterator[pa.RecordBatch]:
    size = len(phrase)
    langs = pa.array([lang], pa.string()).take(pa.array(np.zeros(size, np.int64))) if isinstance(lang, str) else lang
    whole = pa.RecordBatch.from_arrays([
        langs.cast(pa.string()), phrase.cast(pa.string()), pa.array(n, pa.int64())], ["lang", "phrase", "n"])
    for at in range(0, size, _OUT_ROWS):
        yield whole.slice(at, _OUT_ROWS)


def _joined(words: pa.Array, columns: np.ndarray) -> pa.Array:
    """The words of each column's codes with one blank between them; -1 is no word."""
    parts = [words.take(pa.array(c, mask=c < 0)) for c in columns]
    return pc.binary_join_element_wise(*parts, pa.scalar(" ", words.type), null_handling="skip")


def combined(lang: str, texts: list[bytes], most: int) -> Iterator[pa.RecordBatch]:
    """The number of words (the empty phrase), every word and every suffix of two words and more, with their counts in these texts."""
    data = np.frombuffer(b"\n".join(texts).lower(), np.uint8)
    inside = _INSIDE[data]
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return
    codes, words = word_codes(data, inside, starts, ends)
    yield from _rows(lang, pa.array([""]), np.array([len(codes)]))
    yield from _rows(lang, words, np.bincount(codes, minlength=len(words)))
    columns = following(codes, np.cumsum(_BREAK[data], dtype=np.int32)[starts], most)
    columns = columns[:, columns[1] >= 0] if most > 1 else columns[:, :0]
    _, first, n = np.unique(run_keys(columns), return_index=True, return_counts=True)
    columns = columns[:, first]
    yield from _rows(lang, _joined(words, columns), n)


def suffixes(docs: DataFrame, most: int) -> DataFrame:
    """(lang, phrase, n): the suffixes of all texts, counted within parts of the table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        sizes: dict[str, int] = {}
        total = 0
        for batch in batches:
            column = batch.column("text")
            for k, lang in enumerate(batch.column("lang").to_pylist()):
                text = column[k].as_buffer().to_pybytes()
                held.setdefault(lang, []).append(text)
                sizes[lang] = sizes.get(lang, 0) + len(text)
                total += len(text)
                if sizes[lang] >= COMBINE_BYTES or total >= 4 * COMBINE_BYTES:
                    lang = max(sizes, key=sizes.get)
                    total -= sizes.pop(lang)
                    yield from combined(lang, held.pop(lang), most)
        for lang, kept in held.items():
            yield from combined(lang, kept, most)

    lang, text = (F.coalesce(F.col(c).cast("string"), F.lit(d)).alias(c) for c, d in (("lang", "und"), ("text", "")))
    return docs.select(lang, text).mapInArrow(run, _COUNTED)


def equal_partitions(columns: np.ndarray, weights: np.ndarray, cuts: np.ndarray, least: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Multikey three-way quicksort of the pointers 0, 1, ...; (depth, pointers, weights) of its equal partitions.

    Row d of ``columns`` is the key at depth d, -1 the end. The pointers start as the partitions that
    begin at ``cuts``. One pointer is given for each equal partition of at least ``least`` by weight;
    lighter partitions are abandoned.
    """
    last = len(columns)
    pointers = np.arange(columns.shape[1])
    starts, depth = cuts, np.zeros(len(cuts), np.int64)
    while len(pointers):
        sizes = np.diff(np.append(starts, len(pointers)))
        part = np.repeat(np.arange(len(starts)), sizes)
        values = columns[depth[part], pointers]
        side = np.sign(values - values[starts + sizes // 2][part]) + 1
        # stable three-way split of all partitions at once
        place, counts, base = np.empty(len(pointers), np.int64), np.empty((len(starts), 3), np.int64), starts.copy()
        for s in range(3):
            here = side == s
            passed = np.cumsum(here)
            before = passed[starts] - here[starts]
            counts[:, s] = np.diff(np.append(before, passed[-1]))
            place[here] = (base - before)[part[here]] + passed[here] - 1
            base += counts[:, s]
        moved = np.empty_like(pointers)
        moved[place] = pointers
        sizes, equal = counts.reshape(-1), np.tile([False, True, False], len(starts))
        level = np.repeat(depth, 3)
        full = sizes > 0
        sizes, equal, level = sizes[full], equal[full], level[full]
        starts = np.cumsum(sizes) - sizes
        weight = np.add.reduceat(weights[moved], starts)
        keep = weight >= least
        keep &= ~equal | (columns[level, moved[starts]] >= 0)
        for d in np.unique(level[keep & equal]):
            found = keep & equal & (level == d)
            yield int(d), moved[starts[found]], weight[found]
        level = level + equal
        keep &= level < last
        pointers = moved[np.repeat(keep, sizes)]
        depth, sizes = level[keep], sizes[keep]
        starts = np.cumsum(sizes) - sizes


def _counted(block: pa.Table, most: int, least: int) -> Iterator[pa.RecordBatch]:
    """The counts of a block that holds whole routes, sorted by route."""
    route = block.column("route").to_numpy()
    weights = block.column("n").to_numpy()
    cuts = np.flatnonzero(np.append(True, route[1:] != route[:-1]))
    phrases = block.column("phrase")
    blanks = pc.count_substring(phrases, " ").to_numpy().astype(np.int64)
    words = np.where(pc.equal(phrases, "").to_numpy(), 0, blanks + 1)
    heavy = np.repeat(np.add.reduceat(weights, cuts) >= least, np.diff(np.append(cuts, len(route))))
    heavy |= words == 0
    block, route, words = block.filter(pa.array(heavy)), route[heavy], words[heavy]
    for kind in (0, 1, 2):
        here = words == kind if kind < 2 else words > 1
        if not here.any():
            continue
        rows, keys = block.filter(pa.array(here)), route[here]
        weights = rows.column("n").to_numpy()
        cuts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        langs = rows.column("lang").combine_chunks().dictionary_encode()
        lang = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        if kind == 0:
            columns, terms = lang[None, :], None
        else:
            lists = pc.split_pattern(rows.column("phrase").combine_chunks(), " ")
            offsets = lists.offsets.to_numpy().astype(np.int64)
            coded = lists.flatten().dictionary_encode()
            codes, terms = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary
            sizes = np.diff(offsets)
            owner = np.repeat(np.arange(len(sizes)), sizes)
            columns = np.full((1 + min(most, int(sizes.max())), len(sizes)), -1, np.int64)
            columns[0] = lang
            columns[1 + np.arange(len(codes)) - np.repeat(offsets[:-1] - offsets[0], sizes), owner] = codes
        for depth, pointers, n in equal_partitions(columns, weights, cuts, 1 if kind == 0 else least):
            if depth < kind:
                continue
            phrase = _joined(terms, columns[1:depth + 1, pointers]) if depth else pa.array([""] * len(pointers))
            yield from _rows(langs.dictionary.take(pa.array(lang[pointers])), phrase, n)


def _equal_as_one(rows: pa.Table) -> pa.Table:
    return rows.group_by(["lang", "phrase", "route"]).aggregate([("n", "sum")]).rename_columns(
        ["lang", "phrase", "route", "n"]).select(rows.column_names)


def phrase_counts(docs: DataFrame, most: int = 3, least: int = 10) -> DataFrame:
    """Stored rows (lang, phrase, words, n) of all phrases of up to ``most`` words that occur ``least`` times.

    Words and phrases are counted with overlaps within pieces; the empty phrase of 0 words counts all words.
    """
    route = F.xxhash64("lang", F.substring_index("phrase", " ", 2))
    # made again behind the shuffle: the number would not compress
    routed = suffixes(docs, most).repartition(route).withColumn("route", route).sortWithinPartitions("route")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, full = [], 0, BLOCK_ROWS
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows < full:
                continue
            block = pa.Table.from_batches(held)
            route = block.column("route").to_numpy()
            cut = int(np.flatnonzero(route != route[-1])[-1]) + 1 if route[0] != route[-1] else 0
            if cut:
                yield from _counted(block.slice(0, cut), most, least)
                block, full = block.slice(cut), BLOCK_ROWS
            if block.num_rows >= BLOCK_ROWS // 2:
                block = _equal_as_one(block)
                full = max(BLOCK_ROWS, 2 * block.num_rows)
            held, rows = block.combine_chunks().to_batches(), block.num_rows
        if rows:
            yield from _counted(pa.Table.from_batches(held), most, least)

    words = F.when(F.col("phrase") == "", 0).otherwise(F.size(F.split("phrase", " ")))
    return stored(routed.mapInArrow(run, _COUNTED).select("lang", "phrase", words.alias("words"), "n"), "phrases")


def _parts(phrase: Column, words: Column) -> Column:
    """All shorter phrases of two words and more that lie within a phrase."""
    terms = F.split(phrase, " ")
    sized = F.transform(F.sequence(F.lit(2), words - 1), lambda size: F.transform(
        F.sequence(F.lit(1), words - size + 1), lambda at: F.array_join(F.slice(terms, at, size), " ")))
    return F.flatten(sized)


def scored(counts: DataFrame, percent: int = 50) -> DataFrame:
    """(lang, phrase, a, l, r, score) of the candidates that no longer one mostly explains.

    The score is of the weakest cut into a first part and a rest; of equal ones the first cut counts.
    """
    known = counts.select("lang", F.col("phrase").alias("part"), F.col("n").alias("f"))
    found = counts.filter("words > 1").select("lang", "phrase", "words", F.col("n").alias("a"))
    cuts = found.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.withColumns({
        "first": F.expr("substring_index(phrase, ' ', k)"), "rest": F.expr("substring_index(phrase, ' ', k - words)")})
    cuts = cuts.join(known.select("lang", F.col("part").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cuts = cuts.join(known.select("lang", F.col("part").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    # decimals of up to 38 digits: a product may pass 64 bits
    wide = {c: f"cast({c} as decimal(16, 0))" for c in "alr"}
    share = F.expr(f"cast((1000000BD * ({wide['a']} * {wide['a']})) div ({wide['l']} * {wide['r']}) as bigint)")
    best = cuts.groupBy("lang", "phrase").agg(F.any_value("a").alias("a"), F.min(F.struct(share.alias("score"), "k", "l", "r")).alias("cut"))
    longer = found.filter("words > 2").select("lang", F.explode(_parts(F.col("phrase"), F.col("words"))).alias("phrase"), "a")
    longer = longer.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    left = best.join(longer, ["lang", "phrase"], "left").filter(100 * F.coalesce("longer", F.lit(0)) < percent * F.col("a"))
    return left.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def mine(docs: DataFrame, most: int = 3, least: int = 10, percent: int = 50, top: int = 2000) -> DataFrame:
    """Each language's ``top`` phrases: lang, rank, phrase, a, l, r, n, score."""
    counts = phrase_counts(docs, most, least)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    first = scored(counts, percent).withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
    words = counts.filter("words = 0").groupBy("lang").agg(F.sum("n").alias("n"))
    return first.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

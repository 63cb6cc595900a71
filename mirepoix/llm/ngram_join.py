"""N-gram Jaccard join by prefixes of grouped documents.

A document is its set of word shingles, as 64-bit hashes; equal sets are one unit, named by a
64-bit digest of the set. Shingles are ordered from rare to common by a counting table over all
documents (its counts only shape the order, so they may be rough), and two sets that are similar
enough must share a shingle of their prefixes. Units with the same prefix and size are one group.

1. Star step: each group's members are paired with one member, each prefix list's groups (of like
   size) with the one that has fewest rarer shingles, the most central. Pairs whose common prefix
   shingles leave room for the similarity are verified; links are contracted.
2. Exact step: what is left to compare are members of different components that share a prefix
   shingle. Groups outside a list's largest component are paired with all of the list, pairs meet
   by the sizes that their places allow, are filtered by their common prefix shingles, expanded to
   their members, and verified. Lists that lie within one component - copies, however many - are never paired out.

No partner is left out: a pair is skipped only if a bound proves it too unlike or both sides are
already connected.

Defined cases: a null or empty text, or one without words, has no shingles and links with nothing;
fewer words than a shingle form one shingle. Rows with a null doc_id are compared like others and
never name a component. Repeated rows give repeated results. Further columns are kept by ``dedup``
and not read by ``link``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mirepoix.llm.common import bounded_broadcast, forget, stored, text_chunks, texts
from mirepoix.llm.components import components
from mirepoix.llm.wordhash import shingle_sets

TABLE_BITS = 21
_PART_BITS = 15
_FAN_IN = 64
# Width of a slot of set sizes, as a logarithm.
_SLOT = float(np.log(1.08))


def digest(values: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(values.tobytes(), digest_size=8).digest(), "little", signed=True)


def _sets(column: pa.Array, size: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    for first, _, data, offsets in text_chunks(column):
        yield first, shingle_sets(data, offsets, size)


def describe(docs: DataFrame, size: int) -> DataFrame:
    """One stored table: rows with doc_id, ``n`` shingles and ``unit``, and rows with a ``part`` of the counting table."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, id_type = np.zeros(1 << TABLE_BITS, np.uint32), None
        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            for first, sets in _sets(batch.column("text"), size):
                every = np.concatenate([np.zeros(0, np.uint64), *sets]) >> np.uint64(64 - TABLE_BITS)
                counts += np.bincount(every.astype(np.int64), minlength=1 << TABLE_BITS).astype(np.uint32)
                n = len(sets)
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(first, n), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([digest(s) for s in sets], pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()),
                ], ["doc_id", "n", "unit", "part", "counts"])
        if id_type is not None:
            parts = counts.reshape(-1, 1 << _PART_BITS)
            held = [i for i in range(len(parts)) if parts[i].any()]
            m = len(held)
            yield pa.RecordBatch.from_arrays([
                pa.nulls(m, id_type), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.array(held, pa.int32()),
                pa.array([parts[i].astype("<u4").tobytes() for i in held], pa.binary()),
            ], ["doc_id", "n", "unit", "part", "counts"])

    return stored(texts(docs).mapInArrow(run, f"doc_id {kind}, n bigint, unit bigint, part int, counts binary"), "units")


def shingle_classes(described: DataFrame) -> np.ndarray:
    """How common the shingles of each cell of the counting table are: the power of two of its count over the mean."""
    parts = described.filter("part IS NOT NULL").select("part", "counts")

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(c, "<u8" if len(c) == 8 << _PART_BITS else "<u4").astype(np.uint64) for c in frame["counts"]], axis=0)
        return pd.DataFrame({"part": frame["part"].iloc[:1], "counts": [total.astype("<u8").tobytes()]})

    most = parts.groupBy("part").count().agg(F.max("count")).first()[0] or 0
    while most > _FAN_IN:
        groups = -(-most // _FAN_IN)
        salt = F.pmod(F.xxhash64("counts"), F.lit(groups)).alias("salt")
        parts = stored(parts.groupBy("part", salt).applyInPandas(add, "part int, counts binary"), "counts")
        most = parts.groupBy("part").count().agg(F.max("count")).first()[0]
    total = np.zeros(1 << TABLE_BITS, np.uint64)
    for row in parts.groupBy("part").applyInPandas(add, "part int, counts binary").collect():
        total[row["part"] << _PART_BITS:(row["part"] + 1) << _PART_BITS] = np.frombuffer(row["counts"], "<u8")
    mean = max(1.0, total.sum() / max(1, np.count_nonzero(total)))
    return np.floor(np.log2(1 + total / mean)).astype(np.uint8)


def prefixes(docs: DataFrame, size: int, percent: int, classes: np.ndarray) -> DataFrame:
    """Stored rows (unit, n, family, prefix): the rarest shingles of a set, in order; equal sets once per task at least."""
    shared = docs.sparkSession.sparkContext.broadcast(classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank, seen = shared.value, set()
        for batch in batches:
            for _, sets in _sets(batch.column("text"), size):
                rows = []
                for s in sets:
                    unit = digest(s)
                    if not len(s) or unit in seen:
                        continue
                    seen.add(unit)
                    p = len(s) - -(-percent * len(s) // 100) + 1
                    order = (rank[s >> np.uint64(64 - TABLE_BITS)].astype(np.uint64) << np.uint64(58)) | (s >> np.uint64(6))
                    least = np.argpartition(order, p - 1)[:p] if p < len(s) else np.arange(len(s))
                    first = s[least[np.argsort(order[least])]].view(np.int64)
                    rows.append((unit, len(s), digest(np.append(first, len(s))), first))
                if len(seen) > 500_000:
                    seen.clear()
                unit, n, family, prefix = zip(*rows, strict=True) if rows else ((), (), (), ())
                yield pa.RecordBatch.from_arrays([
                    pa.array(unit, pa.int64()), pa.array(n, pa.int64()), pa.array(family, pa.int64()), pa.array(prefix, pa.list_(pa.int64())),
                ], ["unit", "n", "family", "prefix"])

    return stored(texts(docs).select("text").mapInArrow(run, "unit bigint, n bigint, family bigint, prefix array<bigint>"), "prefixes")


def _groups(prefixed: DataFrame) -> DataFrame:
    return stored(prefixed.groupBy("family").agg(F.any_value("n").alias("n"), F.any_value("prefix").alias("prefix")), "groups")


def _lists(groups: DataFrame, percent: int) -> DataFrame:
    """Stored rows (shingle, family, n, at) of the prefix shingles that at least two groups share.

    A list of two groups is left out if they cannot be alike with this as their first common shingle.
    """
    places = groups.select("family", "n", F.posexplode("prefix").alias("at", "shingle"))
    held = places.groupBy("shingle").agg(
        F.min("family").alias("lo"), F.max("family").alias("hi"), F.count("*").alias("c"),
        F.min("n").alias("least"), F.max("n").alias("most"), F.min(F.col("n") - F.col("at")).alias("rest"))
    fits = F.col("most") * percent <= F.col("least") * 100
    fits &= F.col("rest") * (100 + percent) >= (F.col("least") + F.col("most")) * percent
    shared = held.filter("lo <> hi").filter((F.col("c") > 2) | fits).select("shingle")
    return stored(places.join(shared, "shingle"), "lists")


def _alike(percent: int, a: str, b: str) -> Column:
    """Whether two sets may be similar enough if this is the first shingle they share.

    ``a`` and ``b`` prefix the columns n (size) and at (place); what two sets share is at most what
    each has from its first shared shingle on. Every pair to be found passes at that shingle.
    """
    n, m, i, j = (F.col(c) for c in (f"{a}n", f"{b}n", f"{a}at", f"{b}at"))
    fits = F.greatest(n, m) * percent <= F.least(n, m) * 100
    return fits & (F.least(n - i, m - j) * (100 + percent) >= (n + m) * percent)


def _slot(n: Column) -> Column:
    return F.floor(F.log(n.cast("double")) / _SLOT)


def _slots(percent: int) -> Column:
    """The slots of the sizes that a partner of a row with size ``x_n`` and place ``x_at`` can have."""
    n, rest = F.col("x_n"), F.col("x_n") - F.col("x_at")
    low = F.ceil(n * percent / 100)
    high = F.least(F.floor(n * 100 / percent), F.floor(rest * (100 + percent) / percent) - n)
    return F.when(low <= high, F.sequence(_slot(low), _slot(high))).otherwise(F.array().cast("array<bigint>"))


def _enough(percent: int, shared: Column) -> Column:
    """Whether ``shared`` common prefix shingles leave room for the similarity of sizes ``n`` and ``m``."""
    # beyond the prefix that ends first, a set has less than the share it needs
    rest = F.floor((F.greatest("n", "m") * percent + 99) / 100) - 1
    return (shared + rest) * (100 + percent) >= (F.col("n") + F.col("m")) * percent


def _viable(pairs: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """The pairs (f, g) of groups whose common prefix shingles leave room for the similarity."""
    pairs = stored(pairs, "group-pairs")
    wanted = stored(pairs.select(F.col("f").alias("family")).union(pairs.select("g")).distinct(), "wanted")
    known = groups.join(bounded_broadcast(wanted), "family", "left_semi")
    rows = pairs.join(known.select(F.col("family").alias("f"), "n", "prefix"), "f")
    rows = rows.join(known.select(F.col("family").alias("g"), F.col("n").alias("m"), F.col("prefix").alias("other")), "g")
    left = stored(rows.filter(_enough(percent, F.size(F.array_intersect("prefix", "other")))).select("f", "g"), "viable")
    forget(pairs)
    forget(wanted)
    return left


def held_sets(docs: DataFrame, units: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(unit, held): the shingle sets of at least the ``wanted`` units, as bytes."""
    ids = stored(units.join(wanted, "unit").groupBy("unit").agg(F.min("doc_id").alias("chosen")).select("chosen").distinct(), "ids")
    # a set that only rows without doc_id have is chosen by null
    chosen = texts(docs).join(bounded_broadcast(ids), F.col("doc_id").eqNullSafe(F.col("chosen")), "left_semi").select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, sets in _sets(batch.column("text"), size):
                yield pa.RecordBatch.from_arrays([
                    pa.array([digest(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], ["unit", "held"])

    return chosen.mapInArrow(run, "unit bigint, held binary").dropDuplicates(["unit"])


def verified(docs: DataFrame, units: DataFrame, pairs: DataFrame, size: int, percent: int) -> DataFrame:
    """The stored pairs (a, b) of units that are similar enough, by their whole sets."""
    pairs = stored(pairs, "pairs")
    wanted = pairs.select(F.col("a").alias("unit")).union(pairs.select("b")).distinct()
    held = held_sets(docs, units, wanted, size)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    joined = pairs.join(held.select(F.col("unit").alias("b"), F.col("held").alias("y")), "b")
    joined = joined.join(held.select(F.col("unit").alias("a"), F.col("held").alias("x")), "a").select("a", "b", "x", "y")
    links = stored(joined.mapInArrow(check, "a bigint, b bigint"), "links")
    forget(pairs)
    return links


def ordered(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _star_pairs(lists: DataFrame, groups: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Pairs of units: each group's members with its first, each list's groups with the first of like size.

    The first is the most central: the group with fewest rarer shingles. A group meets the first of
    each of its lists, so members of a family meet many of its central ones; no more pairs than rows.
    """
    heads = members.groupBy("family").agg(F.min("unit").alias("head"), F.count("*").alias("size"))
    inside = members.join(heads.filter("size > 1"), "family").filter("unit <> head").select(*ordered("unit", "head"))
    banded = lists.withColumn("band", F.floor(F.log(F.col("n").cast("double")) / float(np.log(100 / percent))))
    first = banded.groupBy("shingle", "band").agg(F.min(F.struct("at", "family", "n")).alias("f"), F.count("*").alias("c")).filter("c > 1")
    first = first.select("shingle", "band", F.col("f.family").alias("to"), F.col("f.n").alias("to_n"), F.col("f.at").alias("to_at"))
    near = banded.join(first, ["shingle", "band"]).filter("family <> to").filter(_alike(percent, "", "to_"))
    near = _viable(near.select(F.least("family", "to").alias("f"), F.greatest("family", "to").alias("g")).distinct(), groups, percent)
    by = heads.select("family", "head")
    across = near.join(by.withColumnRenamed("family", "f"), "f").join(by.select(F.col("family").alias("g"), F.col("head").alias("other")), "g")
    return inside.unionByName(across.select(*ordered("head", "other"))).distinct()


def cross_pairs(rows: DataFrame, key: str, what: str, extra: list[str], keep: Column, slots: Column | None = None) -> DataFrame:
    """Pairs of rows of one ``key`` in different ``part``s: those outside its largest part with all of it.

    With ``slots``, a row outside meets only rows whose size ``n`` lies in one of them.
    """
    sizes = rows.groupBy(key, "part").agg(F.count("*").alias("c"))
    mixed = sizes.groupBy(key).agg(F.max_by("part", F.struct("c", "part")).alias("main"), F.count("*").alias("parts")).filter("parts > 1")
    rows = rows.join(mixed.select(key, "main"), key)
    outside = rows.filter("part <> main").select(key, *(F.col(c).alias(f"x_{c}") for c in (what, "part", *extra)))
    every = rows.select(key, "main", *(F.col(c).alias(f"y_{c}") for c in (what, "part", *extra)))
    if slots is not None:
        outside = outside.withColumn("slot", F.explode(slots))
        every = every.withColumn("slot", _slot(F.col("y_n")))
    pairs = outside.join(every, [key] if slots is None else [key, "slot"]).filter("x_part <> y_part")
    # two outsiders meet twice: keep one order
    return pairs.filter((F.col("y_part") == F.col("main")) | (F.col(f"x_{what}") < F.col(f"y_{what}"))).filter(keep)


def _cross_pairs(lists: DataFrame, groups: DataFrame, members: DataFrame, names: DataFrame, percent: int) -> DataFrame:
    """Pairs of units in different components that the filters let through."""
    names = names.select(F.col("node").alias("unit"), F.col("component").alias("part"))
    placed = members.join(names, "unit", "left").select("family", "unit", F.coalesce("part", "unit").alias("part"))
    placed = stored(placed, "placed")
    inside = cross_pairs(placed, "family", "unit", [], F.lit(True)).select(*ordered("x_unit", "y_unit"))
    # a group of several components is compared as one of its own
    parts = placed.groupBy("family").agg(F.min("part").alias("lo"), F.max("part").alias("hi"))
    parts = parts.select("family", F.when(F.col("lo") == F.col("hi"), F.col("lo")).otherwise(F.bitwise_not("family")).alias("part"))
    near = cross_pairs(lists.join(parts, "family"), "shingle", "family", ["n", "at"], _alike(percent, "x_", "y_"), _slots(percent))
    near = near.select(F.least("x_family", "y_family").alias("f"), F.greatest("x_family", "y_family").alias("g")).distinct()
    near = _viable(near, groups, percent)
    left = placed.select(F.col("family").alias("f"), F.col("unit").alias("u"), F.col("part").alias("pu"))
    right = placed.select(F.col("family").alias("g"), F.col("unit").alias("v"), F.col("part").alias("pv"))
    across = near.join(left, "f").join(right, "g").filter("pu <> pv").select(*ordered("u", "v"))
    return inside.unionByName(across).distinct()


def link(docs: DataFrame, size: int = 4, percent: int = 85) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest doc_id reachable by links)."""
    described = describe(docs, size)
    units = described.filter("part IS NULL").select("doc_id", "n", "unit")
    prefixed = prefixes(docs, size, percent, shingle_classes(described))
    members = stored(prefixed.select("unit", "family").distinct(), "members")
    groups = _groups(prefixed)
    forget(prefixed)
    lists = _lists(groups, percent)
    star = verified(docs, units, _star_pairs(lists, groups, members, percent), size, percent)
    names = components(star)
    found = verified(docs, units, _cross_pairs(lists, groups, members, names, percent), size, percent)
    for done in (lists, groups, members):
        forget(done)
    names = components(star.unionByName(found))
    named = units.join(names, F.col("unit") == F.col("node"), "left").withColumn("component", F.coalesce("component", "unit"))
    named = stored(named.select("doc_id", "n", "component"), "named")
    least = named.filter("n > 0").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    out = named.join(least, "component", "left")
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))


def dedup(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of documents that no other with a smaller doc_id is linked to, one per component.

    Rows without shingles, or with a null doc_id, stay; of repeated rows of one doc_id all stay or none does.
    """
    later = stored(link(docs, size, percent).filter("component_id < doc_id").select("doc_id").distinct(), "later")
    return docs.join(bounded_broadcast(later), "doc_id", "left_anti").select(docs.columns)

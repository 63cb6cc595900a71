"""Exact global order without a one-task window.

``row_number() OVER (ORDER BY ...)`` moves a whole table into one task. The
operators here range-partition instead and only ever bring per-partition or
per-bucket totals together.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mirepoix.session import store

_ROW_BITS = 33


_ORDER = "_order_"


def with_order_keys(df: DataFrame, *first: Column | str) -> tuple[DataFrame, list[str]]:
    """Add sort columns that start with ``first`` and tell all rows apart.

    Equal values are ordered by a hash of the row, then by read position. Only
    exact copies get as far as the position, and copies are interchangeable: a
    task that is run again cannot lose or repeat a row, whatever order it reads
    in. A value that fills a third of the table still spreads over many tasks.
    """
    hashable = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    leading = [F.col(c) if isinstance(c, str) else c for c in first]
    keys = [*leading, F.xxhash64(*hashable), F.monotonically_increasing_id()]
    names = [f"{_ORDER}{i}" for i in range(len(keys))]
    return df.withColumns(dict(zip(names, keys))), names


def lay_out(df: DataFrame, *first: Column | str) -> DataFrame:
    """Range-partition and sort by ``first``, equal values spread over tasks."""
    keyed, names = with_order_keys(df, *first)
    return keyed.repartitionByRange(*names).sortWithinPartitions(*names).drop(*names)


def with_row_index(
    df: DataFrame, order_by: Sequence[str], name: str = "index", within: Sequence[str] = ()
) -> DataFrame:
    """Number the rows from 0 in the given order, per ``within`` key if given.

    The rows are range-partitioned and sorted once (see ``with_order_keys`` for
    equal values). The sorted rows are stored, since the partition totals and the
    numbering have to see the same partitions. What is brought together is one
    count per partition (and key).
    """
    numbered = (
        lay_out(df, *within, *order_by)
        .withColumn("_at", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_at", _ROW_BITS))
    )
    placed = store(numbered, "row-index")
    first = placed.groupBy("_part", *within).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_start")
    )
    before = (
        Window.partitionBy(*within).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = first.select(
        F.col("_part").alias("_p"), *[F.col(k).alias(f"_k_{k}") for k in within], "_start",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
    )
    same = F.col("_part") == F.col("_p")
    for k in within:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return placed.join(offsets, same).select(
        *df.columns, (F.col("_at") - F.col("_start") + F.col("_before")).alias(name)
    )


# --- seeded order ------------------------------------------------------------


def seeded_key(seed: int, key: Column | str) -> Column:
    """A repeatable pseudo-random sort key: the digest of seed and row key."""
    col = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}:"), col.cast("string")))


_PREFIX = 4  # hex digits, 65,536 buckets


def cutoff(digests: DataFrame, wanted: Callable[[Column], Column]) -> DataFrame:
    """One row: the k-th smallest ``_digest``, NULL if there are fewer than k.

    ``wanted`` gives k from the row total. No sort of the table: 65,536 digest
    prefixes are counted, then the prefixes twice as long inside the one that holds
    the k-th row, then the digests inside that one. Copies of a key share a digest
    and are counted before the window, so they add no rows to it.
    """
    prefix = F.substring("_digest", 1, _PREFIX)
    # Windows without partitions: at most 65,536 rows, and one long prefix's digests.
    running = Window.orderBy("_prefix").rowsBetween(Window.unboundedPreceding, 0)
    k = wanted(F.col("_total"))
    buckets = digests.groupBy(prefix.alias("_prefix")).agg(F.count(F.lit(1)).alias("_n")).select(
        "_prefix", "_n", F.sum("_n").over(running).alias("_upto"),
        F.sum("_n").over(Window.partitionBy()).alias("_total"),
    )
    holding = (
        buckets.filter(F.col("_upto") >= k)
        .agg(F.min_by(
            F.struct("_prefix", (k - F.col("_upto") + F.col("_n")).alias("_left")), "_upto"
        ).alias("_b"))
        .select("_b.*")
    )
    # the same within the prefix, by its next digits: two bounded rounds
    longer = F.substring("_digest", 1, 2 * _PREFIX)
    within = Window.orderBy("_longer").rowsBetween(Window.unboundedPreceding, 0)
    narrow = (
        digests.join(F.broadcast(holding), prefix == F.col("_prefix"))  # one row
        .groupBy(longer.alias("_longer"), "_left").agg(F.count(F.lit(1)).alias("_n"))
        .select("_longer", "_left", "_n", F.sum("_n").over(within).alias("_upto"))
        .filter(F.col("_upto") >= F.col("_left"))
        .agg(F.min_by(
            F.struct("_longer", (F.col("_left") - F.col("_upto") + F.col("_n")).alias("_rest")), "_upto"
        ).alias("_c"))
        .select("_c.*")
    )
    inside = Window.orderBy("_digest").rowsBetween(Window.unboundedPreceding, 0)
    return (
        digests.join(F.broadcast(narrow), longer == F.col("_longer"))  # one row
        .groupBy("_digest", "_rest").agg(F.count(F.lit(1)).alias("_n"))
        .select("_digest", "_rest", F.sum("_n").over(inside).alias("_upto"))
        .filter(F.col("_upto") >= F.col("_rest"))
        .agg(F.min("_digest").alias("_cut"))
    )


def is_among_smallest(
    df: DataFrame, key: Column, wanted: Callable[[Column], Column]
) -> Column:
    """True for rows whose digest ``key`` is among the k smallest; copies stay together."""
    cut = cutoff(df.select(key.alias("_digest")), wanted).scalar()
    return F.coalesce(key <= cut, F.lit(True))

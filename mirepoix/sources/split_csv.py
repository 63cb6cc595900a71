"""A CSV with line breaks inside quotes, read by many tasks.

Byte ranges of a file are scanned in parallel. Whether a range begins inside quotes follows from the
number of quotes before it: each range counts its own, and a running sum over the ranges of a file - one
small row each - gives the state at its start. A line that begins outside quotes begins a record. Records
that lie within a range are put together where they are; only the ends of ranges, at most two pieces
each, travel to be joined. Then every record is parsed on its own.

The text is scanned three times (quotes, pieces, records) and never shuffled as a whole. A quote inside a
field is written twice, as the writer of this library does. A file whose first line ends with CR LF has
all its line ends, within fields too, read as LF; empty lines between records are skipped. All files must begin with the same header.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mirepoix.session import store

WHOLE, HEAD, THROUGH, TAIL = range(4)
_PIECES = "file string, block bigint, kind int, record string"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, file, block, at): the lines of all files, ``block`` the first byte of the range a line was read in."""
    rows = spark.read.option("lineSep", "\n").text(path)
    return rows.select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"))


def range_states(lines: DataFrame) -> DataFrame:
    """Stored rows (file, block, inside, crlf): whether each range begins within quotes, and the file's first line ends with CR."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    counts = lines.groupBy("file", "block").agg(
        F.sum(quotes).alias("quotes"), F.min_by(F.col("value").endswith("\r"), "at").alias("crlf"))
    ranges = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = F.sum("quotes").over(ranges) - F.col("quotes")
    return store(counts.select("file", "block", (before % 2 == 1).alias("inside"), F.first("crlf").over(ranges).alias("crlf")), "csv-ranges")


class _Range:
    """The records of one range, line by line in order."""

    def __init__(self, inside: bool):
        self.inside, self.started, self.open = inside, False, []

    def records(self, values: pa.Array) -> Iterator[tuple[int, list[str]]]:
        quotes = pc.count_substring(values, '"').to_numpy(zero_copy_only=False).astype(np.int64)
        after = (int(self.inside) + np.cumsum(quotes)) & 1
        begins = np.append(int(self.inside), after[:-1]) == 0
        self.inside = bool(after[-1])
        starts = np.append(np.flatnonzero(begins), len(values))
        if starts[0] > 0:
            self.open += values[:int(starts[0])].to_pylist()
        if len(starts) == 1:
            return
        yield from self.closed()
        ends = starts[1:]
        single = ends - starts[:-1] == 1
        single[-1] = False
        yield WHOLE, values.take(pa.array(starts[:-1][single])).to_pylist()
        for a, b in zip(starts[:-1][~single][:-1], ends[~single][:-1], strict=True):
            yield WHOLE, ["\n".join(values[int(a):int(b)].to_pylist())]
        self.started = True
        self.open = values[int(starts[-2]):].to_pylist()

    def closed(self) -> Iterator[tuple[int, list[str]]]:
        """What was open when a record begins."""
        if self.open:
            yield (WHOLE if self.started else HEAD), ["\n".join(self.open)]
        self.open = []

    def finished(self) -> Iterator[tuple[int, list[str]]]:
        """What is open when the range ends."""
        if self.open and self.started:
            yield (TAIL if self.inside else WHOLE), ["\n".join(self.open)]
        elif self.open:
            yield (THROUGH if self.inside else HEAD), ["\n".join(self.open)]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records and pieces of ranges whose lines come in order."""
    def rows(key: tuple[str, int], found: Iterator[tuple[int, list[str]]]) -> Iterator[pa.RecordBatch]:
        for kind, records in found:
            n = len(records)
            if n:
                yield pa.RecordBatch.from_arrays([
                    pa.array([key[0]] * n), pa.array([key[1]] * n, pa.int64()), pa.array([kind] * n, pa.int32()),
                    pa.array(records, pa.string())], ["file", "block", "kind", "record"])

    key, part = None, None
    for batch in batches:
        files, blocks = batch.column("file").dictionary_encode(), batch.column("block").to_numpy()
        code = files.indices.to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(np.append(True, (code[1:] != code[:-1]) | (blocks[1:] != blocks[:-1]))) if len(code) else []
        for a, b in zip(cuts, [*cuts[1:], len(code)], strict=True):
            here = (files.dictionary[int(code[a])].as_py(), int(blocks[a]))
            if here != key:
                if part is not None:
                    yield from rows(key, part.finished())
                key, part = here, _Range(batch.column("inside")[int(a)].as_py())
            yield from rows(key, part.records(batch.column("value").slice(int(a), int(b - a))))
    if part is not None:
        yield from rows(key, part.finished())


def joined_pieces(pieces: DataFrame) -> DataFrame:
    """(record) of the records that cross a range's end, from their pieces in order."""
    order = Window.partitionBy("file").orderBy("block", "kind")
    numbered = pieces.withColumn("number", F.sum(F.when(F.col("kind") == TAIL, 1).otherwise(0)).over(order))
    whole = numbered.groupBy("file", "number").agg(F.array_sort(F.collect_list(F.struct("block", "kind", "record"))).alias("parts"))
    return whole.select(F.array_join("parts.record", "\n").alias("record"))


def records(spark: SparkSession, path: str) -> DataFrame:
    """(record): every record of the files at ``path``, headers too, without its line end."""
    lines = _lines(spark, path)
    # a join that shuffles would lose the order of the lines; sorting within a partition restores it
    stated = lines.join(range_states(lines), ["file", "block"])
    bare = F.when(F.col("crlf") & F.col("value").endswith("\r"), F.expr("left(value, length(value) - 1)")).otherwise(F.col("value"))
    stated = stated.withColumn("value", bare).sortWithinPartitions("file", "block", "at")
    found = stated.select("value", "file", "block", "inside").mapInArrow(_scan, _PIECES)
    cut = store(found.filter(F.col("kind") != WHOLE), "csv-pieces")
    every = found.filter(F.col("kind") == WHOLE).select("record").unionByName(joined_pieces(cut))
    return every.filter("record <> ''")

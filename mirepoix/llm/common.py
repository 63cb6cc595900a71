"""What the operators of this subpackage share: reading, stored tables, Arrow batches."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Bytes of files of a stored lookup that may be sent to every executor; larger ones are joined by shuffle.
BROADCAST_BYTES = 16 << 20
# Bytes of text that one numpy step works on; a longer document is a step of its own.
CHUNK_BYTES = 1 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a local session without it uses its warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/stored"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back: later passes see fixed rows."""
    path = f"{shared_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _folders(df: DataFrame) -> list:
    """(file system, path) of the folders that a stored table lies in."""
    spark = df.sparkSession
    conf, kind = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    paths = [kind(folder) for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}]
    return [(path.getFileSystem(conf), path) for path in paths]


def forget(df: DataFrame) -> None:
    """Delete a table written by ``stored`` that nothing reads any more."""
    for files, path in _folders(df):
        files.delete(path, True)


def bounded_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """A broadcast hint if the files of the (stored) table take at most ``limit`` bytes, else the table."""
    return F.broadcast(df) if sum(files.getContentSummary(path).getLength() for files, path in _folders(df)) <= limit else df


def texts(docs: DataFrame) -> DataFrame:
    """doc_id and text, a null text as the empty one; further columns are left out."""
    return docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def held_out(doc_id) -> object:
    """The fold the fitted operators never learn from: crc32 of the id's text, modulo 5, is 0."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column, nulls as empty texts, without copying the bytes."""
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data, offsets


def release() -> None:
    """Give freed memory back to the system: a worker lives on after its task, beside the executor's heap."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive rows with about ``limit`` bytes."""
    data, offsets = utf8(column)
    first, rows = 0, len(offsets) - 1
    while first < rows:
        end = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        end = min(max(end, first + 1), rows)
        yield first, end, data[offsets[first]:offsets[end]], offsets[first:end + 1] - offsets[first]
        first = end
    release()

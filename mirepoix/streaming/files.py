"""File-to-file streams.

Cleaning, pair building and scoring are row-local, so they run unchanged on a
stream: no state, no watermark.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def process_available(
    spark: SparkSession,
    source: str,
    schema: StructType | str,
    transform: Callable[[DataFrame], DataFrame],
    target: str,
    progress: str,
    name_filter: str | None = None,
    files_per_batch: int = 1000,
) -> None:
    """Run a row-local transform over all files not processed yet, then stop.

    ``progress`` keeps what was read, so a restarted run neither skips nor repeats
    a file. ``target`` is written as Parquet.
    """
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    query = (
        transform(reader.parquet(source))
        .writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()

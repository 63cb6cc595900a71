"""Sources and sinks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mirepoix.sources import schemas, split_csv

# A file whose header differs from the declared columns is an error, as is a row that does not fit.
_CSV = {"enforceSchema": "false", "mode": "FAILFAST", "header": "true", "multiLine": "true", "escape": '"', "encoding": "UTF-8"}


def read_recipes(spark: SparkSession, path: str) -> DataFrame:
    """A raw recipe CSV with declared types, columns in the order of its header.

    All files of a folder must have the same header; one with another order raises.

    Quoted fields may hold line breaks, so a file is read by one task: keep the
    table in many files, or turn it into Parquet once (``write_table``).
    """
    header = spark.read.options(**_CSV).csv(path).columns
    ddl = ", ".join(f"`{c}` {schemas.RECIPE_COLUMNS.get(c, 'string')}" for c in header)
    return spark.read.schema(ddl).options(**_CSV).csv(path)


def read_recipes_split(spark: SparkSession, path: str) -> DataFrame:
    """``read_recipes`` for files of any size: a file is read by as many tasks as it has byte ranges.

    The text is scanned three times (see ``split_csv``). Rows come in no given order. Files whose
    headers differ raise when rows are read.
    """
    header = spark.read.options(**_CSV).csv(path)
    columns = header.columns
    ddl = ", ".join(f"`{c}` {schemas.RECIPE_COLUMNS.get(c, 'string')}" for c in columns)
    options = {"mode": "FAILFAST", "escape": '"', "multiLine": "true"}
    found = split_csv.records(spark, path)
    names = F.from_csv("record", ", ".join(f"`_{i}` string" for i in range(len(columns))), options)
    is_header = F.array(*[names.getField(f"_{i}") for i in range(len(columns))]) == F.array(*map(F.lit, columns))
    first = F.regexp_replace(F.col("record"), "^\ufeff", "")
    # a row is parsed once: only a record that begins as the header does is looked at as one
    may = first.startswith(columns[0]) | first.startswith(f'"{columns[0]}')
    rows = found.select(first.alias("record")).filter(~F.coalesce(may & is_header, F.lit(False)))
    return rows.select(F.from_csv("record", ddl, options).alias("row")).select("row.*")


def write_recipes_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).options(header="true", escape='"').csv(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def load_or_build(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The table at ``path``; built and written first if no complete one is there.

    The marker that a finished write leaves decides: a folder without it is written anew.
    """
    if not is_complete(spark, path):
        write_table(build(), path, mode="overwrite")
    return read_table(spark, path)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a write to the folder has finished."""
    context = spark.sparkContext
    marker = context._jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + "/_SUCCESS")
    return marker.getFileSystem(context._jsc.hadoopConfiguration()).exists(marker)


def write_pairs_jsonl(df: DataFrame, path: str) -> None:
    """Pairs as JSON lines in UTF-8; a complete output is left as it is, a half-written one replaced."""
    if not is_complete(df.sparkSession, path):
        df.write.mode("overwrite").json(path)


def read_pairs_jsonl(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.PAIRS).json(path)


def write_benchmark_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).options(header="true", escape='"').csv(path)


def read_benchmark_csv(spark: SparkSession, path: str, ddl: str = schemas.BENCHMARK_RESULTS) -> DataFrame:
    return spark.read.schema(ddl).options(**_CSV).csv(path)


def read_training_log(spark: SparkSession, path: str, one_per_line: bool = False) -> DataFrame:
    """One row per entry of training log documents: one document per file, or per line."""
    reader = spark.read.schema(schemas.TRAINING_LOG).option("multiLine", not one_per_line)
    document = reader.json(path)
    return document.select(F.explode("log_history").alias("e")).select("e.*")


def write_text(df: DataFrame, path: str, column: str = "value", mode: str = "overwrite") -> None:
    df.select(F.col(column).alias("value")).write.mode(mode).text(path)

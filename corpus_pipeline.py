"""From raw documents to packed sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read again as the
next one's docs. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mirepoix.llm import line_dedup, ngram_join, packing, pii, quality
from mirepoix.llm.common import read, stored

# No SQL can state the fitted classifier or the tokenizer; tests compare with a brute-force run.
ORACLE_SQL = None


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.keep(docs, read(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier one equals, or is within one edit of, go; documents left without lines go."""
    return line_dedup.dedup(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by five-word shingles at 0.8, the document with the smallest id stays."""
    return ngram_join.dedup(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and secrets are replaced by their kind."""
    return pii.mask(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of neighbouring documents, one row per piece."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", keep_good),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("personal data", mask_personal_data),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage but the last is stored."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)

"""The registered queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from mirepoix.llm import (
    collocations,
    fertility,
    filter_audit,
    line_dedup,
    minhash,
    multi_index,
    ngram_join,
    oracles,
    packing,
    pieces,
    pii,
    quality,
    toxicity,
    url_reputation,
)
from mirepoix.llm.common import read


def op1_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return multi_index.search(vectors, vectors.filter("vec_id % 20 = 0"))


def op2_deobfuscated_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op3_offset_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip(read(spark, sf_dir, "documents"))


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.fingerprints(read(spark, sf_dir, "documents"))


def op5_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_reputation.judge_urls(read(spark, sf_dir, "pages"), read(spark, sf_dir, "labels"))


def op6_grouped_prefix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link(read(spark, sf_dir, "documents"))


def op7_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


def op8_line_neighbourhoods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(read(spark, sf_dir, "documents"))


def op9_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(pii.find(read(spark, sf_dir, "documents")))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(read(spark, sf_dir, "documents"))


def op13_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility.judge(read(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_multi_index": op1_multi_index,
        "op2_deobfuscated_toxicity": op2_deobfuscated_toxicity,
        "op3_offset_pieces": op3_offset_pieces,
        "op4_minhash": op4_minhash,
        "op5_url_reputation": op5_url_reputation,
        "op6_grouped_prefix_join": op6_grouped_prefix_join,
        "op7_curve_packing": op7_curve_packing,
        "op8_line_neighbourhoods": op8_line_neighbourhoods,
        "op9_pii_spans": op9_pii_spans,
        "op10_quality": op10_quality,
        "op11_filter_audit": op11_filter_audit,
        "op12_collocations": op12_collocations,
        "op13_fertility": op13_fertility,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op5_url_reputation": oracles.URL_REPUTATION,
        "op8_line_neighbourhoods": oracles.LINE_DEDUP,
        "op11_filter_audit": oracles.FILTER_AUDIT,
        "op12_collocations": oracles.COLLOCATIONS,
    }

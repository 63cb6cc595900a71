"""Seconds per headline query; prints one JSON line.

``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the local cores. The tables are first copied into
as many files as there are cores. Every query runs
once to warm up and once for the clock, into a sink that discards the rows.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from mirepoix.plans import catalogue  # noqa: E402
from mirepoix.session import build_session, fresh_path  # noqa: E402

HEADLINES = (
    "clean_recipes",
    "instruction_pairs",
    "standardize_units",
    "standardize_documents",
    "correct_term_fuzzy",
    "recipe_metrics",
    "bleu",
    "similarity",
    "calculate_metrics",
    "score_documents",
    "model_metrics",
    "resolve_verdict",
    "train_test_split_documents",
    "row_index",
    "render_chat",
    "clean_title",
    "boxplot_stats_ranged",
    "ratio_by_group",
    "histogram",
)


TABLES = ("documents", "part", "conversations", "lineitem", "labels", "benchmark")


def laid_out(spark, sf_dir: str, files: int) -> str:
    """A copy of the tables in several files each, as a cluster stores them; not timed."""
    folder = fresh_path(spark, "bench-tables")
    for name in TABLES:
        spark.read.parquet(f"{sf_dir}/{name}.parquet").repartition(files).write.parquet(f"{folder}/{name}.parquet")
    return folder


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", spark_sql_shuffle_partitions=cpus, spark_ui_enabled="false",
        spark_driver_memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    known = catalogue.queries()
    sf_dir = laid_out(spark, sf_dir, int(cpus))
    seconds: dict[str, float] = {}
    for name in HEADLINES:
        for _ in range(2):
            start = time.perf_counter()
            known[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "total seconds over headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()

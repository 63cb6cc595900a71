"""The pipeline, stage by stage, against brute force on what each stage kept."""

from brute import deduped_lines, linked
from tokenizers import Tokenizer

import corpus_pipeline
from mirepoix.llm import packing, pii
from mirepoix.llm.common import stored


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, tables = docs.columns, []
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, sf_dir), "stage")
        tables.append(docs)
    good, lined, unique, masked, packed = tables
    assert all(t.columns == columns for t in tables[:-1])
    label = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in good.collect()}
    clean = [i for i, q in label.items() if q == 1]
    assert sum(i in kept for i in clean) >= 0.95 * len(clean)
    # brute force over the shorter documents of the previous stage is quadratic: compare those lines' fate
    rows = {r["doc_id"]: r["text"] for r in unique.collect()}
    before = {r["doc_id"]: r["text"] for r in lined.collect()}
    want = {i: c for i, (n, c) in linked(list(before.items()), 5, 80).items()}
    assert set(rows) == {i for i in before if want[i] == i}
    assert {r["doc_id"]: r["text"] for r in masked.collect()} == {i: None if t is None else pii.masked(t) for i, t in rows.items()}
    library = Tokenizer.from_file(packing.VOCABULARY)
    library.encode_special_tokens = True
    tokens = {r["doc_id"]: len(library.encode(r["text"] or "", add_special_tokens=False).ids) + 1 for r in masked.collect()}
    seen = {}
    for r in packed.collect():
        seen[r["doc_id"]] = seen.get(r["doc_id"], 0) + r["length"]
    assert seen == tokens


def test_line_stage_on_short_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").filter("length(text) < 500").limit(40)
    stage = dict(corpus_pipeline.STAGES)["line dedup"]
    got = {r["doc_id"]: r["text"] for r in stage(spark, docs, sf_dir).collect()}
    assert got == deduped_lines([(r["doc_id"], r["text"]) for r in docs.collect()], 20)

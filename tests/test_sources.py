"""Sources, sinks and the file stream."""

import random
import json

import pytest

from mirepoix.operators import reports
from mirepoix.operators.cleaning import clean_recipes
from mirepoix.operators.curation import instruction_pairs
from mirepoix.operators.evaluation import with_recipe_metrics
from mirepoix.plans.views import recipes
from mirepoix.sources import tables
from mirepoix.streaming.files import process_available


def test_recipe_csv_by_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        'name,id,minutes,extra,steps\n"Pie, ""big""",7,20,x,"[\'mix\',\n \'bake\']"\n,8,,y,"[]"\n', encoding="utf-8")
    df = tables.read_recipes(spark, str(tmp_path))
    assert dict(df.dtypes) == {"name": "string", "id": "bigint", "minutes": "int", "extra": "string", "steps": "string"}
    rows = {r.id: r for r in df.collect()}
    assert rows[7].name == 'Pie, "big"' and rows[7].steps == "['mix',\n 'bake']"
    assert rows[8].name is None and rows[8].minutes is None


def test_load_or_build_builds_once(spark, tmp_path):
    path, built = str(tmp_path / "t"), []

    def build():
        built.append(1)
        return spark.range(3)

    assert tables.load_or_build(spark, path, build).count() == 3
    assert tables.load_or_build(spark, path, build).count() == 3
    assert len(built) == 1
    (tmp_path / "t" / "_SUCCESS").unlink()
    assert tables.load_or_build(spark, path, build).count() == 3
    (tmp_path / "empty").mkdir()
    assert tables.load_or_build(spark, str(tmp_path / "empty"), build).count() == 3
    assert len(built) == 3


def test_files_with_another_column_order_are_refused(spark, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "a.csv").write_text("name,id,minutes\nx,1,10\n")
    (folder / "b.csv").write_text("id,name,minutes\n2,y,20\n")
    with pytest.raises(Exception):
        tables.read_recipes(spark, str(folder)).collect()
    (folder / "b.csv").write_text("name,id,minutes\ny,2,20\n")
    assert {r.name: r.id for r in tables.read_recipes(spark, str(folder)).collect()} == {"x": 1, "y": 2}


def test_jsonl_keeps_letters_and_existing_output(spark, tmp_path):
    path = str(tmp_path / "pairs")
    pair = "id long, instruction string, output string"
    tables.write_pairs_jsonl(spark.createDataFrame([(1, "crème brûlée", "a\nb")], pair), path)
    tables.write_pairs_jsonl(spark.createDataFrame([(2, "other", "x")], pair), path)
    assert [tuple(r) for r in tables.read_pairs_jsonl(spark, path).collect()] == [(1, "crème brûlée", "a\nb")]
    text = "".join(p.read_text(encoding="utf-8") for p in (tmp_path / "pairs").glob("*.json"))
    assert "crème brûlée" in text


def test_benchmark_csv(spark, tmp_path):
    path = str(tmp_path / "b")
    row = ("m (x) - Base", "pie", 6.97, 0, 'Judge Error: Expecting "," here,\nline 3', 1191, None)
    ddl = ("model_name string, dish_name string, generation_time double, score int, reasoning string, "
           "recipe_length int, judge_model string")
    tables.write_benchmark_csv(spark.createDataFrame([row], ddl), path)
    assert tuple(tables.read_benchmark_csv(spark, path).first()) == row


def test_training_log(spark, tmp_path):
    log = {"best_metric": None, "log_history": [
        {"epoch": 0.1, "loss": 2.5, "step": 10}, {"epoch": 0.2, "loss": 2.0, "step": 20},
        {"epoch": 0.2, "eval_loss": 1.9, "eval_runtime": 3.0, "step": 20}, {"epoch": 0.3, "eval_loss": 1.8, "step": 30}]}
    (tmp_path / "trainer_state.json").write_text(json.dumps(log, indent=2))
    series = reports.loss_series(tables.read_training_log(spark, str(tmp_path)))
    assert sorted((r.step, r.train_loss, r.eval_loss) for r in series.collect()) == [
        (10, 2.5, None), (20, 2.0, 1.9), (30, None, 1.8)]


def test_report_text(spark, tmp_path):
    wide = spark.createDataFrame([(1, "make pie", "mix\nbake", None)],
                                 "id long, instruction string, truth string, base string")
    tables.write_text(reports.report_text(wide), str(tmp_path / "r"))
    lines = [r.value for r in spark.read.text(str(tmp_path / "r"), wholetext=True).collect()][0].split("\n")
    assert lines[1] == "#" * 80 and "Sample 1: make pie" in lines[2]
    assert lines[lines.index("bake") + 3] == "N/A"


def test_stream_equals_batch_and_resumes(spark, sf_dir, tmp_path):
    source, target, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    rows = recipes(spark, sf_dir)
    rows.filter("id < 100").write.parquet(source)

    def run():
        process_available(spark, source, rows.schema, clean_recipes, target, progress, files_per_batch=1)

    run()
    run()  # nothing new
    first = spark.read.parquet(target).count()
    rows.filter("id >= 100").write.mode("append").parquet(source)
    run()
    streamed, batch = spark.read.parquet(target), clean_recipes(rows)
    assert 0 < first < streamed.count() == batch.count()
    assert streamed.select(batch.columns).exceptAll(batch).count() == 0


def test_pairs_and_scores_stream(spark, sf_dir, tmp_path):
    source, target, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    rows = recipes(spark, sf_dir)
    rows.write.parquet(source)

    def transform(df):
        pairs = instruction_pairs(clean_recipes(df))
        return with_recipe_metrics(pairs, "output", "output").select(
            "id", "output", "recipe_metrics.composite_score")

    process_available(spark, source, rows.schema, transform, target, progress)
    streamed, batch = spark.read.parquet(target), transform(rows)
    assert streamed.count() == batch.count() > 0
    assert streamed.exceptAll(batch).count() == 0


@pytest.mark.parametrize("end, size", [("\n", "700"), ("\r\n", "3000"), ("\n", "64")])
def test_split_csv_equals_one_task(spark, tmp_path, end, size):
    draw = random.Random(int(size))
    pieces = ["a", "b,", '""', "\n", "\n\n", "é", " ", "name", "x" * 90]
    lines = ["name,id,minutes,description"]
    for i in range(300):
        said = "".join(draw.choice(pieces) for _ in range(draw.randint(0, 12)))
        lines.append(f'"n{i}",{i},{draw.randint(0, 9)},' + ("" if i % 9 == 0 else f'"{said}"'))
        if i % 50 == 0:
            lines.append("")
    lines.append(f'"long",999,1,"{"many lines" + chr(10) * 2000}"')
    (tmp_path / "one").mkdir()
    for k in range(2):
        (tmp_path / "one" / f"{k}.csv").write_bytes(("﻿" * (k == 0) + end.join(x.replace("\n", end) for x in lines) + end * (1 - k)).encode())
    path = str(tmp_path / "one")
    want = sorted(map(tuple, tables.read_recipes(spark, path).collect()), key=str)
    names = {"spark.sql.files.maxPartitionBytes": size, "spark.sql.files.openCostInBytes": "1"}
    kept = {k: spark.conf.get(k) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        df = tables.read_recipes_split(spark, path)
        assert df.columns == ["name", "id", "minutes", "description"]
        assert df.rdd.getNumPartitions() > 8
        got = sorted(map(tuple, df.collect()), key=str)
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert len(got) == 602 and got == want

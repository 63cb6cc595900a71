"""Joins over shingles, signatures and lines against brute force."""

import hashlib
import random

import pytest
from brute import DOCS, deduped_lines, linked, rows_of, shingles

from mirepoix.llm import line_dedup, minhash, ngram_join
from mirepoix.llm.components import components


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(60)] + [(1000, i) for i in range(1001, 1080)] + [(5000, 5000), (7, 3)]
    got = components(spark.createDataFrame(chain, "a long, b long")).collect()
    groups = {}
    for r in got:
        groups.setdefault(r["component"], set()).add(r["node"])
    assert sorted(map(len, groups.values())) == [1, 61, 80]
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("size, percent", [(4, 85), (5, 80), (2, 50)])
def test_links_match_brute_force(spark, families, size, percent):
    got = ngram_join.link(spark.createDataFrame(families, DOCS), size, percent).collect()
    want = linked([(r[0], r[1]) for r in families], size, percent)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert len({c for _, c in want.values()}) < len(want)


def test_link_defined_cases(spark, awkward, no_docs):
    got = [tuple(r) for r in ngram_join.link(awkward).select("doc_id", "n_shingles", "component_id").collect()]
    assert len(got) == awkward.count()
    by_id = {r[0]: r[1:] for r in got}
    assert by_id[0] == (0, 0) and by_id[1] == (0, 1) and by_id[2] == (0, 2) and by_id[3] == (1, 3)
    assert by_id[5] == (4, 5) and by_id[6] == (4, 5) and by_id[8] == (1, 8)
    assert sum(r == (5, 4, 5) for r in got) == 2
    assert ngram_join.link(no_docs).count() == 0
    kept = ngram_join.dedup(awkward)
    assert kept.columns == awkward.columns
    assert sorted(r["doc_id"] for r in kept.filter("doc_id IS NOT NULL").collect()) == [0, 1, 2, 3, 4, 5, 5, 7, 8, 9, 10, 11]


def test_a_row_without_id_links_its_neighbours(spark):
    base = [f"v{i}" for i in range(150)]
    ends = [" ".join("x" if i in other else w for i, w in enumerate(base)) for other in ((10, 40, 70), (20, 100, 130))]
    rows = [(1, ends[0]), (2, ends[1]), (None, " ".join(base)), (3, "another text of its own words")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], DOCS)
    assert linked(rows[:2], 5, 80) == {1: (146, 1), 2: (146, 2)}
    got = ngram_join.link(docs, 5, 80).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {1: 1, 2: 1, None: 1, 3: 3}
    classes = minhash.fingerprints(docs).collect()
    assert {r["doc_id"]: r["class_id"] for r in classes} == {1: 1, 2: 1, None: 1, 3: 3}


def test_one_prefix_list_of_many_near_copies_is_not_paired_out(spark):
    base = [f"v{i}" for i in range(150)]
    draw, texts = random.Random(3), []
    for i in range(300):
        made = list(base)
        made[draw.randrange(150)] = f"x{i}"
        texts.append(" ".join(made))
    got = ngram_join.link(spark.createDataFrame(rows_of(texts), DOCS), 4, 85)
    assert {r["component_id"] for r in got.collect()} == {0}


def test_fingerprints_and_edits(spark, families):
    rows = families[:40]
    got = {r["doc_id"]: r for r in minhash.fingerprints(spark.createDataFrame(rows, DOCS)).collect()}
    texts = [t or "" for _, t, *_ in sorted(rows)]
    ids = sorted(r[0] for r in rows)
    assert sorted(got) == ids
    for k, (i, text) in enumerate(zip(ids, texts)):
        edited = minhash.edited(text, texts[(k + 1) % len(texts)])
        assert len(edited) >= len(text) - len(text) // 2
        assert got[i]["n_chars"] == len(text)
        assert got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert got[i]["edited_fingerprint"] == minhash.signatures([edited.encode()])[0].tobytes().hex()
        assert got[i]["near_next"] == pytest.approx((minhash.signatures([text.encode()])[0] == minhash.signatures([texts[(k + 1) % len(texts)].encode()])[0]).mean())
    same = {}
    for i, text in zip(ids, texts):
        assert same.setdefault(text, got[i]["fingerprint"]) == got[i]["fingerprint"]
    # verified classes never join more than the exact links do
    want = {i: (c if n else i) for i, (n, c) in linked([(r[0], r[1]) for r in rows], 5, 80).items()}
    assert all(want[r["class_id"]] == want[i] for i, r in got.items())


def _families_of_variants(seed, families, variants):
    """Bases of 150 words; each variant is over 0.8 like its base, few are so like each other."""
    draw, texts = random.Random(seed), []
    for k in range(families):
        base = [f"f{k}v{i}" for i in range(150)]
        texts.append(" ".join(base))
        for v in range(variants):
            made = list(base)
            for i in range(3):
                made[draw.randrange(10 + 45 * i, 45 + 45 * i)] = f"x{k}.{v}.{i}"
            texts.append(" ".join(made))
    draw.shuffle(texts)
    return texts


@pytest.mark.parametrize("block", [None, 16])
def test_texts_over_the_limit_that_share_a_band_are_one_class(spark, monkeypatch, block):
    if block:
        monkeypatch.setattr(minhash, "BLOCK_ROWS", block)
    texts = _families_of_variants(11, 3, 80)
    got = {r["doc_id"]: r["class_id"] for r in minhash.fingerprints(spark.createDataFrame(rows_of(texts), DOCS)).collect()}
    sets = [shingles(t, minhash.SHINGLE) for t in texts]
    marks = minhash.signatures([t.encode() for t in texts])[0]
    links = 0
    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            over = 100 * both >= minhash.PERCENT * (len(sets[i]) + len(sets[j]) - both)
            if over and any((marks[i][c:c + minhash.ROWS] == marks[j][c:c + minhash.ROWS]).all() for c in range(0, minhash.BANDS * minhash.ROWS, minhash.ROWS)):
                assert got[i] == got[j]
                links += 1
    assert links > 200


def test_fingerprint_defined_cases(spark, awkward, no_docs):
    got = minhash.fingerprints(awkward).collect()
    assert len(got) == awkward.count()
    assert {r["fingerprint"] for r in got if r["doc_id"] in (0, 1, 2)} == {"ffffffff" * minhash.HASHES}
    assert minhash.fingerprints(no_docs).count() == 0
    single = minhash.fingerprints(awkward.filter("doc_id = 4")).collect()[0]
    assert single["near_next"] == 1.0 and single["n_chars"] == 13


def test_line_dedup_matches_brute_force(spark):
    draw = random.Random(5)
    base = ["".join(draw.choice("abcdé ") for _ in range(draw.randint(1, 40))) for _ in range(14)]
    texts = []
    for _ in range(40):
        lines = []
        for _ in range(draw.randint(1, 6)):
            line = draw.choice(base)
            if draw.random() < 0.6 and line:
                k = draw.randrange(len(line))
                line = draw.choice([line[:k] + line[k + 1:], line[:k] + "z" + line[k:], line[:k] + "z" + line[k + 1:]])
            lines.append(line)
        texts.append("\n".join(lines))
    texts += ["\n \n", "", None]
    rows = rows_of(texts)
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup(spark.createDataFrame(rows, DOCS), near_chars=12).collect()}
    assert got == deduped_lines([(r[0], r[1]) for r in rows], 12)


def test_line_dedup_defined_cases(spark, awkward, no_docs):
    out = line_dedup.dedup(awkward)
    assert out.columns == awkward.columns and line_dedup.dedup(no_docs).count() == 0
    got = {r["doc_id"]: r for r in out.collect()}
    assert got[0]["text"] is None and got[1]["text"] == "" and 6 not in got
    assert got[11]["text"] == "the line that is long enough" and got[11]["n_chars"] == 28
    assert out.filter("doc_id = 5").count() == 2
    assert line_dedup.report(awkward).count() == awkward.count()


def test_line_dedup_runs_no_python(spark, families):
    plan = line_dedup.report(spark.createDataFrame(families[:5], DOCS))._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoop"))

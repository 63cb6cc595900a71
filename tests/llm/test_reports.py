"""Filter audit, phrase mining and fertility rules against brute force and on awkward tables."""

import math
import random
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
import sentencepiece
from brute import DOCS, WORD, lower, rows_of
from tokenizers import Tokenizer

from mirepoix.llm import collocations, fertility, filter_audit, packing, pieces

LABELS = "doc_id long, quality int, toxic int"


def _fails(text, doc_id, least):
    words = WORD.findall(text)
    tests = {
        "A": len(words) < 100,
        "B": 100 * len(set(words)) < 80 * len(words),
        "C": 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text),
        "D": any(c in "#$%&*|" for c in text),
        "E": doc_id is not None and text in least and least[text] < doc_id,
    }
    return {k for k, v in tests.items() if v}


def _audit(rows, labels):
    """(part, order, step) -> counts, one filter after the other."""
    least = {}
    for r in rows:
        if r[0] is not None:
            least[r[1] or ""] = min(r[0], least.get(r[1] or "", r[0]))
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, t in labels if t == 1}
    parts, out, removed = defaultdict(list), {}, Counter()
    for r in rows:
        parts[r[2] or ""].append((r[0], _fails(r[1] or "", r[0], least)))
    for part, docs in parts.items():
        for order in permutations("ABCDE"):
            left = docs
            for step, name in enumerate(order, 1):
                here = [d for d in left if name in d[1]]
                left = [d for d in left if name not in d[1]]
                failing = sum(name in f for _, f in docs)
                removed[part, name] += len(here)
                out[part, "".join(order), step] = [
                    len(left), len(here), failing - len(here), sum(f == {name} for _, f in docs),
                    sum(i in good for i, _ in here), sum(i in toxic for i, _ in here)]
    return {k: (*v, removed[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def _audited(df):
    return {(r["part"], r["filter_order"], r["step"]): tuple(r[3:]) for r in df.select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley").collect()}


def test_audit_matches_running_the_filters(spark):
    draw = random.Random(4)
    texts = []
    for _ in range(60):
        words = [draw.choice(["Abc", "de", "FGH", "i#", "word", f"w{draw.randrange(300)}"]) for _ in range(draw.choice([0, 3, 99, 100, 130]))]
        texts += [" ".join(words)] * draw.choice([1, 1, 2, 5])
    texts += [" ".join(f"w{i}" for i in range(120))] * 600 + [None, "", None]
    draw.shuffle(texts)
    rows = [(i, t, draw.choice(["en", "de", "", None]), "s", 1) for i, t in enumerate(texts)]
    rows += rows[:7] + [(None, rows[3][1], "en", "s", 1)] * 2
    labels = [(i, draw.choice([0, 1, None]), draw.choice([0, 1, None])) for i in range(200)] + [(5, 1, 1), (None, 1, 1)]
    got = filter_audit.audit(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS))
    assert _audited(got) == _audit(rows, labels)


def test_audit_defined_cases(spark, awkward, no_docs):
    none = spark.createDataFrame([], LABELS)
    rows = [tuple(r)[:5] for r in awkward.collect()]
    assert _audited(filter_audit.audit(awkward, none)) == _audit(rows, [])
    assert filter_audit.audit(no_docs, none).count() == 0


def _mined(rows, most, least, percent, top):
    counts = defaultdict(Counter)
    for _, text, lang, *_ in rows:
        found = counts["und" if lang is None else lang]
        piece = []
        for c in [*lower(text or ""), "\n"]:
            piece.append(c if c not in ".,;:!?\n\x0b\x0c\r" else "\0")
        for part in "".join(piece).split("\0"):
            words = [w for w in part.replace("\t", " ").split(" ") if w]
            found[()] += len(words)
            for i in range(len(words)):
                for k in range(1, most + 1):
                    if i + k <= len(words):
                        found[tuple(words[i:i + k])] += 1
    out = []
    for lang, f in counts.items():
        cand = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in cand.items():
            inside = any(len(q) > len(p) and 100 * b >= percent * a and any(q[i:i + len(p)] == p for i in range(len(q))) for q, b in cand.items())
            if not inside:
                score, _, left, right = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                kept.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, f[()], -score))
    return sorted(out)


def _phrase_rows(seed):
    draw = random.Random(seed)
    words = ["a", "b", "C", "é", "dd", "the", "of", "日", "x\xa0y"]
    rows = []
    for i in range(300):
        text = "".join(draw.choice(words) + draw.choice([" ", " ", "  ", "\t", ". ", ",", "\n", "\x1c"]) for _ in range(draw.randint(0, 40)))
        rows.append((i, text if i % 17 else None, draw.choice(["en", "en", "de", None, "und"]), "s", 1))
    return rows + [(None, "the of the of " * 40, "fr", "s", 1)] + [(7, "a b a b a b", "xx", "s", 1)] * 12


@pytest.mark.parametrize("most, least, percent, top", [(3, 10, 50, 2000), (4, 5, 80, 7), (2, 3, 50, 50)])
def test_phrases_match_brute_force(spark, monkeypatch, most, least, percent, top):
    # small blocks: leading pairs larger than a block are combined as they come
    monkeypatch.setattr(collocations, "BLOCK_ROWS", 8)
    monkeypatch.setattr(collocations, "COMBINE_BYTES", 200)
    rows = _phrase_rows(most)
    got = collocations.mine(spark.createDataFrame(rows, DOCS).repartition(5), most, least, percent, top)
    assert sorted(tuple(r) for r in got.collect()) == _mined(rows, most, least, percent, top)


def test_phrase_scores_are_exact_beyond_64_bits(spark):
    big = 3_000_000_019
    rows = [("en", "", 0, 5 * big), ("en", "p", 1, big + 1), ("en", "q", 1, big), ("en", "p q", 2, big)]
    got = collocations.scored(spark.createDataFrame(rows, "lang string, phrase string, words int, n long")).collect()
    assert [tuple(r) for r in got] == [("en", "p q", big, big + 1, big, 10**6 * big * big // ((big + 1) * big))]


def test_equal_partitions_are_counts():
    draw = np.random.default_rng(1)
    columns = draw.integers(-1, 6, (3, 4000))
    columns[1:, columns[0] < 0] = -1
    columns[2, columns[1] < 0] = -1
    weights = draw.integers(1, 4, 4000)
    want = Counter()
    for c, w in zip(columns.T.tolist(), weights.tolist()):
        for d in range(3):
            if c[d] >= 0:
                want[d, tuple(c[:d + 1])] += w
    got = {}
    for depth, pointers, n in collocations.equal_partitions(columns, weights, np.array([0]), 30):
        for p, w in zip(pointers, n.tolist()):
            assert got.setdefault((depth, tuple(columns[:depth + 1, p].tolist())), w) == w
    assert got == {k: v for k, v in want.items() if v >= 30}


def test_phrase_defined_cases(spark, awkward, no_docs):
    rows = [tuple(r)[:5] for r in awkward.collect()]
    assert sorted(tuple(r) for r in collocations.mine(awkward).collect()) == _mined(rows, 3, 10, 50, 2000)
    assert collocations.mine(no_docs).count() == 0


def _measured(text):
    words = WORD.findall(text)
    windows = list(zip(words, words[1:], words[2:]))
    n = Counter(windows)
    covered = {k + j for k, x in enumerate(windows) if n[x] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    dup = sum(x in lines[:k] for k, x in enumerate(lines))
    counts = (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered))
    ids = PIECES.encode(text)
    total = max(len(ids), 1)
    entropy = -sum(v / total * math.log2(v / total) for v in Counter(ids).values())
    byte_ids = BYTES.encode(text, add_special_tokens=False).ids
    measures = (len(text) / total, sum(map(PIECES.is_byte, ids)) / total, entropy, len(text) / max(len(byte_ids), 1))
    return counts, len(words) < 50 or 100 * len(covered) > 50 * len(words), measures


PIECES = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
BYTES = Tokenizer.from_file(packing.VOCABULARY)
BYTES.encode_special_tokens = True


def _bands(measured, span, least):
    """(band, size class) -> {measure: (low, high)}; None for a whole band."""
    groups = defaultdict(set)
    for band, (counts, failed, m) in measured:
        if not failed:
            size = int(math.log2(counts[0]))
            groups[band, size].add((size, *m))
            groups[band, None].add((size, *m))
    out = {}
    for (band, size), rows in groups.items():
        if len(rows) < least:
            continue
        words = 2.0 ** (5 if size is None else size)
        out[band, size] = limits = {}
        for k, (name, (step, noise, below, above)) in enumerate(fertility.MEASURES.items(), 1):
            cells = sorted(math.floor(r[k] / step) for r in rows)
            q1, q3 = cells[-(-len(cells) // 4) - 1], cells[-(-3 * len(cells) // 4) - 1]
            width = span * max((q3 - q1) * step, noise / math.sqrt(words))
            limits[name] = (q1 * step - width if below else -math.inf, (q3 + 1) * step + width if above else math.inf)
    return out


def test_fertility_matches_brute_force(spark):
    draw = random.Random(9)
    words = ["the", "time", "people", "water", "house", "again", "morning", "Zug", "être", "x#", "*", "日本"]
    rows = []
    for i in range(260):
        junk = i % 13 == 0
        made = "".join((draw.choice("ẞ☃żqxzðŋ") * 3 if junk else draw.choice(words)) + draw.choice([" ", " ", " ", "\n", "  "]) for _ in range(draw.choice([0, 4, 49, 50, 70, 140])))
        if i % 11 == 0:
            made += "\nsame line here\n \n" * 30
        rows.append((i, made if i != 40 else None, draw.choice(["en", "en", "fr", None, ""]), "s", 1))
    rows += rows[:9]
    got = fertility.judge(spark.createDataFrame(rows, DOCS).repartition(3), span=1.0, least_texts=10).collect()
    by_id = {r[0]: (r[1] or "", r[2] or fertility.script(r[1] or "")) for r in rows}
    measured = {i: _measured(text) for i, (text, _) in by_id.items()}
    bands = _bands([(by_id[i][1], m) for i, m in measured.items()], 1.0, 10)
    assert len(got) == len(rows) and len(bands) > 3
    kept = Counter()
    for r in got:
        counts, failed, m = measured[r["doc_id"]]
        assert tuple(r[1:6]) == counts and r["base_failed"] == failed and r["band"] == by_id[r["doc_id"]][1]
        assert tuple(r[c] for c in fertility.MEASURES) == pytest.approx(m, abs=1e-9)
        limits = bands.get((r["band"], int(math.log2(max(counts[0], 1))))) or bands.get((r["band"], None), {})
        out = [n for n, x in zip(fertility.MEASURES, m) if n in limits and not limits[n][0] <= x <= limits[n][1]]
        assert r["failed"] == out and r["kept"] == (not failed and not out)
        kept[failed, r["kept"]] += 1
    assert all(kept[k] for k in ((True, False), (False, True), (False, False)))


def test_many_copies_do_not_narrow_the_bands(spark):
    draw = random.Random(2)
    words = ["the", "time", "people", "water", "house", "again", "morning", "under", "could", "river"]
    clean = [" ".join(draw.choice(words) for _ in range(100)) for _ in range(120)]
    near = [clean[0] + f" {draw.choice(words)} {draw.choice(words)}" for _ in range(300)]
    rows = rows_of(clean + near + [clean[1]] * 400)
    kept = [r["kept"] for r in fertility.judge(spark.createDataFrame(rows, DOCS)).collect() if r["doc_id"] < 120]
    assert sum(kept) >= 119


def test_fertility_defined_cases(spark, awkward, no_docs):
    got = fertility.judge(awkward).collect()
    assert len(got) == awkward.count()
    by_id = {r["doc_id"]: r for r in got}
    for i in (0, 1, 2):
        assert tuple(by_id[i][1:6]) == (0, 0, 0, 0, 0) and by_id[i]["base_failed"] and not by_id[i]["kept"]
    assert tuple(by_id[8][1:6]) == (20_000, 80_000, 0, 0, 20_000)
    assert fertility.judge(no_docs).count() == 0
    assert fertility.script("") == "none" and fertility.script("да, ok") == "cyrillic" and fertility.script("日本go") == "cjk"

"""Term correction and batch-wide subsequences against brute force."""

import random

import numpy as np
import pytest

from mirepoix.functions import lcs, near
from mirepoix.operators import terms


def shared(a, b):
    """LCS length, by the table of all beginnings."""
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j], row[j + 1])
    return row[-1]


@pytest.fixture(params=[0, 30, 10**9])
def pairs_a_word(request, monkeypatch):
    monkeypatch.setattr(lcs, "PAIRS_A_WORD", request.param)


def test_subsequences_of_a_batch(pairs_a_word):
    draw = random.Random(3)
    sizes = [0, 1, 2, 62, 63, 64, 65, 66, 127, 128, 129, 140]
    texts = ["".join(draw.choice("abcé日😀") for _ in range(draw.choice(sizes))) for _ in range(400)]
    left, right = texts[:200], texts[200:]
    right[:20] = left[:20]
    right[20:40] = [t[:len(t) // 2] + "xab" + t[len(t) // 2:] for t in left[20:40]]
    assert lcs.lengths(left, right).tolist() == [shared(a, b) for a, b in zip(left, right)]
    assert lcs.lengths([], []).tolist() == []
    assert lcs.similarity([None, "", "a", "", "ab"], ["a", "", None, "b", "b"]) == [None, 100.0, None, 0.0, 200 / 3]


def test_few_cells_at_a_time(monkeypatch):
    monkeypatch.setattr(lcs, "CELLS", 200)
    monkeypatch.setattr(lcs, "PAIRS_A_WORD", 0)
    left, right = ["abcab", "", "x" * 300, "ab"] * 20, ["bca", "a", "x" * 299 + "y", "ba"] * 20
    assert lcs.lengths(left, right).tolist() == [3, 0, 299, 1] * 20


def brute(words, known, percent):
    out = {}
    for w in {w for w in words if w is not None}:
        best = None
        for t in {t for t in known if t}:
            edits = len(w) + len(t) - 2 * shared(w, t)
            if any(c.isalpha() for c in w) and 100 * edits < percent * (len(w) + len(t)):
                best = min(best or (9, "", 0), (edits / (len(w) + len(t)), t, edits))
        out[w] = (best[1], best[2]) if best else (w, None)
    return out


def spoilt(draw, word, edits):
    letters = list(word)
    for _ in range(edits):
        at = draw.randint(0, len(letters))
        if draw.random() < 0.5 and letters:
            del letters[min(at, len(letters) - 1)]
        else:
            letters.insert(at, draw.choice("abcdé日"))
    return "".join(letters)


@pytest.mark.parametrize("percent, together", [(20, terms.TOGETHER), (20, 3), (7, 3), (45, 50), (80, 50)])
def test_terms_match_brute_force(spark, percent, together):
    draw = random.Random(percent)
    known = ["".join(draw.choice("abcdé日") for _ in range(draw.choice([1, 2, 3, 5, 8, 9, 12, 20]))) for _ in range(60)]
    known += ["teaspoon", "tablespoon", "ab" * 50, "straße", "", None, "teaspoon", "12"]
    words = [spoilt(draw, draw.choice([t for t in known if t]), draw.randint(0, 4)) for _ in range(200)]
    words += ["teaspon", "tabelspoon", "ab" * 49 + "cab", "strase", "", None, "12", "--", "teaspon", "日"]
    # a family with one beginning: its pieces meet in few keys
    words += ["commonstart" + c for c in "abcdefghij"]
    known += ["commonstart" + c for c in "klmnopqrst"]
    df = spark.createDataFrame([(w, 1) for w in words], "word string, term int")
    table = spark.createDataFrame([(t, 2) for t in known], "term string, word int")
    rows = terms.correct_terms(df, table, percent=percent, together=together).collect()
    got = {r.word: (r.corrected, r.edits) for r in rows}
    assert len(rows) == len(got) and got == brute(words, known, percent)
    assert any(v[1] for v in got.values())


def test_ties_and_empty_tables(spark):
    df = spark.createDataFrame([("abcdefgx",)], "word string")
    two = spark.createDataFrame([("abcdefgz",), ("abcdefgy",)], "term string")
    assert [tuple(r) for r in terms.correct_terms(df, two).collect()] == [("abcdefgx", "abcdefgy", 2)]
    assert [tuple(r) for r in terms.correct_terms(df, two.limit(0)).collect()] == [("abcdefgx", "abcdefgx", None)]
    assert terms.correct_terms(df.limit(0), two).collect() == []
    with pytest.raises(ValueError):
        terms.correct_terms(df, two, percent=100)


def test_term_join_has_no_cross_join(spark):
    df = spark.createDataFrame([("teaspon",)], "word string")
    table = spark.createDataFrame([("teaspoon",)], "term string")
    text = terms.correct_terms(df, table)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_only_similar_pairs_meet(spark):
    """Words of few syllables share pieces with most terms, but what is left of them only with similar ones."""
    draw = random.Random(5)
    made = sorted({"".join(draw.choices(["an", "he", "ti", "on", "er", "s"], k=draw.randint(3, 6))) for _ in range(400)})
    words = spark.createDataFrame([(w,) for w in made], "_word string")
    known = spark.createDataFrame([(t,) for t in made[::4]], "_term string")
    met = terms._lookups(words, known, 20).join(terms._entries(known, words, 20), "key").select("_word", "_term").distinct()
    alike = {(a, b) for a in made for b in made[::4] if 100 * (len(a) + len(b) - 2 * shared(a, b)) < 20 * (len(a) + len(b))}
    got = [tuple(r) for r in met.collect()]
    assert len(alike) > len(made[::4]) and len(got) == len(set(got)) and set(got) == alike


@pytest.mark.parametrize("ways", [0, 1, 8])
def test_short_and_long_way_find_the_same(spark, monkeypatch, ways):
    monkeypatch.setattr(terms, "WAYS", ways)
    monkeypatch.setattr(terms, "CELLS", 3)
    draw = random.Random(ways)
    known = ["".join(draw.choice("abé日😀") for _ in range(draw.randint(1, 14))) for _ in range(40)]
    words = [spoilt(draw, draw.choice(known), draw.randint(0, 3)) for _ in range(80)]
    df = spark.createDataFrame([(w,) for w in words], "word string")
    rows = terms.correct_terms(df, spark.createDataFrame([(t,) for t in known], "term string"), percent=33).collect()
    assert {r.word: (r.corrected, r.edits) for r in rows} == brute(words, known, 33)


def test_lookups_never_become_rows(spark, monkeypatch):
    """What is stored and dealt out are the words and terms, not the ways to drop letters from each."""
    draw = random.Random(8)
    made = sorted({"".join(draw.choices(["an", "he", "ti", "on", "er", "s"], k=draw.randint(3, 7))) for _ in range(500)})
    words = spark.createDataFrame([(w,) for w in made], "word string")
    known = spark.createDataFrame([(t,) for t in made[::4]], "term string")
    stored = []
    monkeypatch.setattr(terms, "store", lambda df, label, put=terms.store: stored.append(put(df, label)) or stored[-1])
    out = terms.correct_terms(words, known)
    assert out.count() == len(made)
    assert sum(df.count() for df in stored) <= len(made) + len(made[::4])
    seen = spark.sparkContext.accumulator(0)
    compared = terms._compared

    def counted(percent, nearest):
        each = compared(percent, nearest)

        def run(batches):
            def noted():
                for batch in batches:
                    seen.add(batch.num_rows)
                    yield batch
            yield from each(noted())
        return run

    monkeypatch.setattr(terms, "_compared", counted)
    terms.correct_terms(words, known).write.format("noop").mode("overwrite").save()
    lengths = {len(w) for w in made}
    assert 0 < seen.value <= len(lengths) + len(lengths) ** 2


@pytest.mark.parametrize("percent, together", [(20, 100), (45, 7)])
def test_all_similar_pairs(spark, percent, together):
    draw = random.Random(percent)
    known = sorted({"".join(draw.choice("abé日") for _ in range(draw.randint(1, 14))) for _ in range(50)})
    made = sorted({w for w in (spoilt(draw, draw.choice(known), draw.randint(0, 3)) for _ in range(90)) if w})
    found = terms.similar_terms(
        spark.createDataFrame([(w,) for w in made], "_word string"),
        spark.createDataFrame([(t,) for t in known], "_term string"), percent, together).collect()
    edits = {(w, t): len(w) + len(t) - 2 * shared(w, t) for w in made for t in known}
    alike = {(*pair, e) for pair, e in edits.items() if 100 * e < percent * len("".join(pair))}
    assert len(found) == len(alike) and {tuple(r) for r in found} == alike


def by_length(texts):
    out = {}
    for t in sorted(set(texts)):
        out.setdefault(len(t), []).append(t)
    return [near.Texts("".join(v), n) for n, v in out.items()]


@pytest.mark.parametrize("few", [0, 1, 8, 10_000])
@pytest.mark.parametrize("letters, cells", [("ab", 1 << 18), ("abé日𐐷", 3), ("abé日𐐷", 500)])
@pytest.mark.parametrize("equal_hashes", [False, True])
def test_blocks_against_brute_force(monkeypatch, few, letters, cells, equal_hashes):
    if equal_hashes:
        # hashes only propose pairs: unlike texts may have the same
        monkeypatch.setattr(near, "_mixed", lambda c: np.zeros(len(c), dtype=np.uint64))
    draw = random.Random(few)
    known = ["".join(draw.choice(letters) for _ in range(draw.randint(1, 12))) for _ in range(25)] + ["a" * 17, "a" * 18]
    words = [w for w in (spoilt(draw, draw.choice(known), draw.randint(0, 3)) for _ in range(40)) if w] + ["a" * 16, "a" * 20]
    blocks = by_length(known)
    for percent in (20, 60):
        got, all_pairs = {}, []
        for block in by_length(words):
            best = near.Nearest(block, percent, few, cells)
            for some in draw.sample(blocks, len(blocks)):
                best.see(some)
                for w, t, e in near.pairs(block, some, percent, few, cells):
                    all_pairs += zip(block.at(w), some.at(t), e.tolist())
            got |= {w: (t, e) for w, t, e in zip(*best.found())}
        want = {w: v for w, v in brute(words, known, percent).items() if v[1] is not None}
        assert got == want
        edits = {(w, t): len(w) + len(t) - 2 * shared(w, t) for w in set(words) for t in set(known)}
        alike = [(*pair, e) for pair, e in edits.items() if 100 * e < percent * len("".join(pair))]
        assert sorted(all_pairs) == sorted(alike)

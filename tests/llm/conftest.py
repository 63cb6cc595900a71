import random

import pytest
from brute import DOCS, rows_of


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls, empty and long texts, ties and repeats; extra columns with names the operators use."""
    texts = [None, "", "   ", "one", "one two three", "a b c d e f g", "a b c d e f g", "\n\n", "word " * 20_000,
             "mail a.b@c.de now", "é" * 50, "the line that is long enough\nthe line that is long enough"]
    rows = [(*r, 1, "x", 2, "y") for r in rows_of(texts)] + [(None, "no id at all", "en", "s", 12, 1, "x", 2, "y")]
    rows.append(rows[5])
    return spark.createDataFrame(rows, DOCS + ", n int, unit string, place int, line string")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def families(spark):
    """Random texts in families: copies, near copies of many grades, shared passages."""
    draw = random.Random(7)
    words = [f"w{i}" for i in range(400)]
    texts = []
    passage = [draw.choice(words) for _ in range(12)]
    for _ in range(14):
        base = [draw.choice(words) for _ in range(draw.randint(3, 90))]
        for _ in range(draw.randint(1, 9)):
            made = list(base)
            for _ in range(draw.choice([0, 0, 1, 1, 2, 4])):
                made[draw.randrange(len(made))] = draw.choice(words)
            if draw.random() < 0.2:
                made += passage
            texts.append(" ".join(made))
    texts += [texts[0].upper(), "  ".join(texts[1].split()), None, ""]
    draw.shuffle(texts)
    return rows_of(texts)

import random

import pytest

from martloom.llm.queries import importable

LONG = " ".join(f"w{i % 977}" for i in range(40_000))


@pytest.fixture(scope="session", autouse=True)
def package_on_workers(spark):
    importable(spark)


@pytest.fixture(scope="session")
def frame(spark):
    """Documents with two extra columns whose names clash with those that operators use inside."""

    def build(rows):
        rows = [(i, t, "x", 1) for i, t in rows]
        return spark.createDataFrame(rows, "doc_id long, text string, size string, fps int").repartition(3)

    return build


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and long texts, ties, repeated rows."""
    return [
        (1, None),
        (2, ""),
        (3, " \n\t "),
        (4, LONG),
        (5, LONG.upper()),
        (6, "Ärger im Zug. Straße frei \U0001f600"),
        (6, "Ärger im Zug. Straße frei \U0001f600"),
        (None, "no id here"),
        (None, None),
        (7, "no id here"),
        (8, "!!! 123 ???"),
    ]


@pytest.fixture(scope="session")
def copied_rows():
    """Random prose with exact and near copies and passages in common, in random id order."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(300)]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passage, texts = prose(60), [prose(rng.randint(1, 200)) for _ in range(40)]
    for t in texts[:10]:
        words = t.split()
        words[rng.randrange(len(words))] = "changed"
        texts.append(" ".join(words))
    texts += texts[5:12] + [t.upper() for t in texts[12:16]]
    texts += [f"{prose(9)} {passage} {prose(7)}" for _ in range(15)] + [f"{passage} {prose(3)} {passage}", "a " * 90, "a " * 70]
    ids = rng.sample(range(1000), len(texts))
    return list(zip(ids, texts))

"""Documents with everything that can go wrong in a table."""

import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, shard int, copies long, key string, bucket int, tag string, anchors string, held_out boolean"


def _words(rng, n):
    return [f"{rng.choice('bcdfg')}{rng.choice('aeiou')}{rng.randrange(400)}" for _ in range(n)]


@pytest.fixture(scope="session")
def messy_rows():
    rng = random.Random(5)
    base = _words(rng, 160)
    near = list(base)
    near[80] = "changed"
    texts = [
        (1, " ".join(base)),
        (2, " ".join(near)),
        (3, " ".join(base)),
        (3, " ".join(base)),  # a repeated row
        (4, None),
        (5, ""),
        (6, " \t\n\x0b\x0c\r "),
        (7, "Short Text"),
        (None, "short text"),
        (None, None),
        (8, " ".join(_words(rng, 40) + base[:70])),
        (8, " ".join(_words(rng, 90))),  # an id used twice
        (9, " ".join(_words(rng, 20_000))),
        (10, "x" * 200_000),
        (-4, "né à 日本 語 \U0001f600 " * 30),
        (11, 'TOKEN!! =!! "9233A8ECF7C5B09FE5949719B6B82BC439E9329B"!!'),
        (12, " ".join(_words(rng, 60)) + ' token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" end'),
    ]
    sources = ["a", "b", None, "ä", ""]
    return [
        (i, t, None, sources[k % 5], None if t is None else len(t), 7, 99, None, "k", 3, "t", None, None)
        for k, (i, t) in enumerate(texts)
    ]


@pytest.fixture(scope="session")
def messy(spark, messy_rows):
    return spark.createDataFrame(messy_rows, DOCS)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)

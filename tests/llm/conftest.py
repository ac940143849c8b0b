import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, key string, count long, token string"


@pytest.fixture(scope="session")
def words():
    rng = random.Random(5)
    return ["".join(rng.choice("abcdefghijklmnoprstuvwyzé") for _ in range(rng.randint(2, 9))) for _ in range(700)]


@pytest.fixture(scope="session")
def odd(spark, words):
    """Nulls in every column, empty and very long texts, ties, repeated rows, columns with clashing names."""
    rng = random.Random(9)
    prose = [" ".join(rng.choice(words) for _ in range(80)) for _ in range(4)]
    long = "\n".join(" ".join(rng.choice(words) for _ in range(30)) + "." for _ in range(2500))
    rows = [
        (1, prose[0]), (2, prose[0]), (3, prose[1]), (3, prose[1]), (3, prose[2]), (None, prose[3]), (None, None), (4, None), (5, ""), (6, " \n\t"),
        (7, long), (8, "one two"), (9, "ONE  two"), (10, "a b c d"), (11, prose[1].replace(words[0], "zzz") + " tail"), (12, "<|endoftext|> x"),
    ]
    return spark.createDataFrame([(i, t, None, "s" if i == 1 else None, None, 0.5, "k", 7, None) for i, t in rows], SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def some_labels(spark):
    return spark.createDataFrame([(i, i % 2, None if i == 3 else (i + 1) % 2) for i in range(1, 13)] + [(None, 1, 1), (4, None, None), (2, 1, 1)], "doc_id long, quality int, toxic int")

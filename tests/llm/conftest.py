import random

import pytest

EXTRA = "doc long, t string, n int, h long, key string, block int, copies string, score double, found int, path string, row string"


def _words(draw, n, vocabulary=400):
    return " ".join(f"w{draw.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in any column, empty and very long texts, repeated rows and ids, no words, odd white space."""
    draw = random.Random(4)
    long = _words(draw, 30_000)
    base = _words(draw, 80)
    return [
        (1, base, "en", "a"), (1, base, "en", "a"), (2, None, None, None), (3, "", "en", "a"), (4, " \n\t ", "de", "b"),
        (None, base, "en", "a"), (None, None, "en", "b"), (5, long, "en", "a"), (6, base + " tail", None, "a"), (1, _words(draw, 60), "de", "b"),
        (7, "é ß 日本  x\x1cy", "de", None), (8, "one two", "en", "b"), (9, "one two", "en", "b"), (10, "a" * 200_000, "en", "a"), (11, "!!! ...", "en", "a"),
    ]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    """The odd rows with columns whose names clash with what operators use inside."""
    from pyspark.sql import functions as F

    frame = spark.createDataFrame(odd_rows, "doc_id long, text string, lang string, source string")
    extra = [F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in EXTRA.split(", ")]
    return frame.select("*", F.length("text").cast("long").alias("n_chars"), *extra)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)

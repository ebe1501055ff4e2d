import random

import pytest
from pyspark.sql import functions as F

CLASHES = ["row", "k", "n", "a", "b", "t", "g", "key", "score", "kept", "failures", "slot", "place", "position", "part", "rank", "k0", "h", "_t", "src"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n, size=400):
    return " ".join(f"w{rng.randrange(size)}" for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty, blank and very long texts, copies, ties and repeated rows."""
    rng = random.Random(5)
    base = words(rng, 200, 10_000)
    rows = [
        (1, None, "en", "a", 0),
        (2, "", "en", "a", 0),
        (3, " \n\t ", None, "b", 5),
        (None, "the cat is on a mat and so on for ever", "en", None, None),
        (None, None, None, None, None),
        (7, base, "en", "a", 1),
        (8, base, "en", "a", 1),
        (8, base, "en", "a", 1),
        (9, base + " tail", "de", "b", 1),
        (10, words(rng, 60_000), "fr", "b", 1),
        (11, "x" * 300_000, "fr", "b", 1),
        (12, "one", "es", "c", 3),
        (12, "two words", "es", "c", 9),
        (13, "Größe 𝔘nicode éß 一 二 三 vier", "de", "c", 9),
    ]
    return rows + [(100 + i, words(rng, rng.randrange(3, 90)), "en", "abc"[i % 3], 1) for i in range(40)]


@pytest.fixture
def odd(spark, odd_rows):
    df = spark.createDataFrame(odd_rows, SCHEMA).repartition(3, "doc_id")
    return df.withColumns({c: F.lit(f"extra {c}") for c in CLASHES})


@pytest.fixture
def none(spark):
    df = spark.createDataFrame([], SCHEMA)
    return df.withColumns({c: F.lit(f"extra {c}") for c in CLASHES})

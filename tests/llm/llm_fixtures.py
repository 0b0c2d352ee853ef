"""Fixtures of the operator tests; each test module imports them all."""

import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def rng():
    return random.Random(17)


@pytest.fixture
def words(rng):
    """A function that makes ``n`` words of invented prose."""
    stock = ["".join(rng.choice(["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha"])
                     for _ in range(rng.randint(1, 4))) for _ in range(400)]

    def make(n):
        return " ".join(rng.choice(stock) for _ in range(n))
    return make


@pytest.fixture
def odd_docs(spark):
    """Nulls in any column, empty and blank texts, repeated rows and ids, a very
    long text and an extra column whose name clashes with results."""
    long = "lang " * 20000 + "end"
    rows = [(1, "one two three", "en", "s", 13), (1, "one two three", "en", "s", 13),
            (1, "other words", None, None, None), (2, None, "en", "s", None),
            (3, "", None, "s", 0), (4, " \t\n ", "en", None, 4), (None, "no id here", "en", "s", 10),
            (5, long, "en", "s", len(long)), (6, "é" * 300, "fr", "s", 300)]
    return spark.createDataFrame([(*r, 0.5, True) for r in rows], DOCS + ", score double, kept boolean")


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], DOCS)

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, doc string, id long, row long, fingerprint string, lines string, key1 long"


def prose(seed, n):
    rng = random.Random(seed)
    words = [f"w{rng.randrange(4000)}" for _ in range(n)]
    return "".join(w + ("\n" if rng.random() < 0.08 else " ") for w in words)


@pytest.fixture(scope="session")
def text_of():
    return prose


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, repeated rows, columns whose names the operators use inside."""
    texts = [None, "", " \n\t ", "one", prose(1, 40), prose(1, 40), prose(2, 60_000), "é" * 300 + " ü x", "a " * 5000]
    rows = [(i, t, "en", f"s{i}", 0, "d", 1, 2, "f", "l", 3) for i, t in enumerate(texts)]
    rows += [rows[4], rows[4], (None, prose(3, 30), None, None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
